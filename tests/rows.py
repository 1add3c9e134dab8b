"""Literal input rows and small helpers."""

import contextlib
import io

from clicktrail import TaskParams
from clicktrail.operators.actions import normalised_actions
from clicktrail.schemas import USER_INFO, USER_VISIT_ACTION

PARAMS = TaskParams(
    "2019-02-01", "2019-02-28", start_age=20, end_age=50, target_page_flow=(1, 2, 3)
)

LOG = USER_VISIT_ACTION + ", action_seq BIGINT"


def action(session, user, seq, page=1, time="2019-02-01 10:00:00", keyword=None, click=-1, product=-1,
           order=None, pay=None, city=0, date="2019-02-01"):
    return (date, user, session, page, time, keyword, click, product, order, None, pay, None, city, seq)


EDGE = [
    action("A", 1, 1, 1, "2019-02-01 9:59:58", "new hotpot"),
    action("A", 1, 2, 2, "2019-02-01 10:00:01", "hotpot"),
    action("A", 1, 3, 3, "2019-02-01 10:00:01", click=11),
    action("A", 1, 4, 2, "2019-02-01 10:00:05", click=1),
    action("B", 2, 5, 1, "2019-02-01 09:00:00", order="7,7,3,"),
    action("C", 99, 6, 9, "2019-02-01 09:00:00", pay="3"),
]


def log_of(spark, rows):
    return spark.createDataFrame(rows, LOG)


def actions_of(spark, rows):
    return normalised_actions(log_of(spark, rows))


def users_of(spark, *users):
    """Users from ``(user_id, age)`` or ``(user_id, age, professional, city, sex)``."""
    full = [(*user, "it", "rome", "female")[:5] if len(user) == 2 else user for user in users]
    return spark.createDataFrame(
        [(i, f"user{i}", f"name{i}", age, job, city, sex) for i, age, job, city, sex in full], USER_INFO
    )


def edge_users(spark):
    return users_of(spark, (1, 20), (2, 50))


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def run_plan_of(df):
    """The plan as adaptive execution left it, after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
