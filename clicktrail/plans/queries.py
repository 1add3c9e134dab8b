"""Every operator as a query over the test tables, with the test parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktrail.functions import times, values
from clicktrail.operators import actions as log
from clicktrail.operators import categories, funnel, history, packed, products, sampling, sessions
from clicktrail.params import TaskParams
from clicktrail.plans import sql
from clicktrail.schemas import AD_CLICK, AREA_LEVELS
from clicktrail.sources import reports
from clicktrail.sources import sample_tables as tables
from clicktrail.sources.dimensions import city_dimension
from clicktrail.sources.shared import discard, shared_folder, staged
from clicktrail.streaming import ad_clicks

TASK = "t-0001"
PARAMS = TaskParams(
    start_date="2024-01-05",
    end_date="2024-01-25",
    start_age=20,
    end_age=50,
    target_page_flow=(1, 2, 3, 4, 5, 6, 7),
)
BY_ATTRIBUTES = replace(
    PARAMS,
    start_age=10,
    end_age=55,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=tuple(f"NATION_{i}" for i in range(3, 25)),
    sex="female",
)
BY_INTERESTS = replace(
    PARAMS, keywords=("kw1", "kw7", "kw10"), category_ids=tuple(range(0, 100, 3))
)
LARGE_SAMPLE = replace(PARAMS, sample_size=1000)
BINNED_SAMPLE = replace(PARAMS, sample_size=1200)
ONE_MORE_PER_HOUR = replace(PARAMS, extra_per_hour=1)
RETURNING_PATH = (3, 4, 3, 4, 12, 5)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


class Inputs:
    """The test tables and the steps several queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def log(self) -> DataFrame:
        return log.actions_in_range(tables.user_visit_action(self.spark, self.sf_dir), PARAMS)

    @cached_property
    def actions(self) -> DataFrame:
        return log.normalised_actions(self.log)

    @cached_property
    def users(self) -> DataFrame:
        return tables.user_info(self.spark, self.sf_dir)

    @cached_property
    def cities(self) -> DataFrame:
        return tables.city_info(self.spark, self.sf_dir)

    @cached_property
    def products(self) -> DataFrame:
        return tables.product_info(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return tables.read_table(self.spark, self.sf_dir, "events")

    @cached_property
    def sessions(self) -> DataFrame:
        return self.sessions_for(PARAMS)

    def sessions_for(self, params: TaskParams) -> DataFrame:
        return sessions.filtered_sessions(self.actions, self.users, params)

    def sample(self, params: TaskParams = LARGE_SAMPLE) -> DataFrame:
        return sampling.session_sample(self.sessions, params)

    def activity(self, *kinds: str) -> DataFrame:
        events = categories.category_events(self.actions, kinds or tuple(categories.KINDS))
        return categories.session_category_activity(events, self.sessions)

    @cached_property
    def steps(self) -> DataFrame:
        return funnel.session_steps(self.actions)

    @cached_property
    def clicks(self) -> DataFrame:
        return log.clicked_products(tables.user_visit_action(self.spark, self.sf_dir), PARAMS)

    def area_products(self, cities: DataFrame) -> DataFrame:
        per_area = products.area_product_clicks(products.city_product_clicks(self.clicks), cities)
        return products.area_product_full(per_area, self.products)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# Action log


@query
def actions_in_range(t):
    return t.log


@query
def normalised_actions(t):
    lists = ("order_categories", "order_products", "pay_categories", "pay_products")
    return t.actions.select(
        "action_seq",
        "user_id",
        "session_id",
        "page_id",
        "city_id",
        F.expr(times.time_text("action_ts")).alias("action_time"),
        "date_hour",
        "date_key",
        "minute_key",
        "keyword",
        F.col("category_id").cast("string"),
        F.col("product_id").cast("string"),
        *(F.expr(f"{values.comma_text(name)} AS {name}") for name in lists),
    )


@query
def clicked_products(t):
    return t.clicks


# Sessions


def _with_list_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.expr(values.comma_text(name)) for name in ("search_keywords", "click_category_ids")}
    ).drop("keyword_match", "category_match", "start_ts", "end_ts")


@query
def session_summary(t):
    return _with_list_text(sessions.session_summary(t.actions))


@query
def session_enriched(t):
    return _with_list_text(sessions.session_enriched(sessions.session_summary(t.actions), t.users))


@query
def session_filtered(t):
    return _with_list_text(t.sessions)


@query
def session_filtered_by_attributes(t):
    return _with_list_text(t.sessions_for(BY_ATTRIBUTES))


@query
def session_filtered_by_interests(t):
    return _with_list_text(t.sessions_for(BY_INTERESTS))


@query
def session_buckets(t):
    return sessions.session_buckets(t.sessions).select(
        "session_id", "visit_length", "step_length", "visit_bucket", "step_bucket"
    )


@query
def session_aggr_stat(t):
    return sessions.session_aggr_stat(t.sessions, TASK)


@query
def session_aggr_stat_by_interests(t):
    return sessions.session_aggr_stat(t.sessions_for(BY_INTERESTS), TASK)


@query
def session_detail(t):
    summary = sessions.session_summary(t.actions, PARAMS).drop("search_keywords", "click_category_ids")
    summary = staged(summary, "session_summary")  # for the filter and for the list of hot sessions
    kept = sessions.session_filtered(sessions.session_enriched(summary, t.users), PARAMS)
    return sessions.session_detail(t.actions, kept, TASK, sessions.hot_sessions(summary))


@query
def session_aggr_stat_observed(t):
    """The counters fill while the filtered sessions are written; the report reads no session again."""
    kept, counters = sessions.observed_sessions(t.sessions.drop("search_keywords", "click_category_ids"))
    discard(staged(kept, "sessions_filtered"))
    return sessions.observed_aggr_stat(t.spark, counters, TASK)


def _stored_history(t) -> str:
    """The log's partial aggregates, stored in two parts, the second of which begins with a date of the first once more."""
    folder = shared_folder(t.spark, "session_history")
    history.store_dates(t.actions.where("date <= '2024-01-15'"), folder)
    history.store_dates(t.actions.where("date >= '2024-01-15'"), folder)
    return folder


@query
def session_summary_over_time(t):
    folder = _stored_history(t)
    partials, listed = (history.stored(t.spark, folder, name, BY_INTERESTS) for name in (history.SESSIONS, history.VALUES))
    return history.merged_summary(partials, listed, BY_INTERESTS).drop("start_ts", "end_ts")


@query
def session_values_over_time(t):
    return history.merged_values(history.stored(t.spark, _stored_history(t), history.VALUES, PARAMS))


# Sampling


@query
def session_hourly_counts(t):
    return sampling.session_hourly_counts(t.sessions)


@query
def session_sample_quota(t):
    return sampling.session_sample_quota(sampling.session_hourly_counts(t.sessions), LARGE_SAMPLE)


@query
def session_random_extract(t):
    return sampling.session_random_extract(t.sample(), t.actions, LARGE_SAMPLE, TASK)


@query
def session_random_extract_one_more(t):
    sample = t.sample(ONE_MORE_PER_HOUR)
    return sampling.session_random_extract(sample, t.actions, ONE_MORE_PER_HOUR, TASK)


@query
def session_random_extract_by_bins(t):
    return sampling.session_random_extract(t.sample(BINNED_SAMPLE), t.actions, BINNED_SAMPLE, TASK)


@query
def session_random_detail(t):
    return sampling.session_random_detail(t.sample(), t.actions, LARGE_SAMPLE, TASK)


# Categories


@query
def category_universe(t):
    return categories.category_universe(t.activity())


@query
def category_click_counts(t):
    return categories.category_click_counts(t.activity("click"))


@query
def category_order_counts(t):
    return categories.category_order_counts(t.activity("order"))


@query
def category_pay_counts(t):
    return categories.category_pay_counts(t.activity("pay"))


@query
def category_activity(t):
    return categories.category_activity(t.activity())


@query
def top10_category(t):
    return categories.top10_category(category_activity(t), TASK)


@query
def category_session_clicks(t):
    return categories.category_session_clicks(t.activity("click"))


@query
def top10_session(t):
    activity = staged(t.activity(), "category_activity")  # for the ranking and for the sessions
    top = categories.top10_category(categories.category_activity(activity), TASK)
    return categories.top10_session(categories.clicks_in_top_categories(activity, top), TASK)


@query
def top10_session_detail(t):
    return categories.top10_session_detail(top10_session(t), t.actions, TASK)


# Page funnel


@query
def target_page_pairs(t):
    """The pairs of the path, with how many actions are on a pair's first page, 0 where none is."""
    pairs = funnel.target_page_pairs(t.spark, PARAMS.target_page_flow)
    views = t.actions.groupBy("page_id").agg(F.count(F.lit(1)).alias("page_pv"))
    return pairs.join(views, "page_id", "left").withColumn("page_pv", F.coalesce("page_pv", F.lit(0).cast("long")))


@query
def session_page_pairs(t):
    return funnel.session_page_pairs(t.steps)


@query
def page_pair_pv(t):
    return funnel.page_pair_pv(session_page_pairs(t), PARAMS.target_page_flow)


@query
def start_page_pv(t):
    return funnel.start_page_pv(t.actions, PARAMS.target_page_flow)


@query
def page_conversion(t):
    return funnel.page_conversion(t.steps, PARAMS.target_page_flow)


@query
def page_conversion_returning_path(t):
    return funnel.page_conversion(t.steps, RETURNING_PATH)


@query
def page_split_convert_rate(t):
    return funnel.page_split_convert_rate(page_conversion(t), TASK)


@query
def kv_report_decode(t):
    report = funnel.page_split_convert_rate(page_conversion_returning_path(t), TASK)
    report = report.withColumn("convertRate", packed.kv_replaced(F.col("convertRate"), "4_3", "9.9"))
    return packed.kv_report_decode(report, "convertRate")


# Products per area


@query
def click_product_basic(t):
    return products.click_product_basic(t.clicks, t.cities)


@query
def area_product_clicks(t):
    return products.area_product_clicks(products.city_product_clicks(t.clicks), t.cities)


@query
def area_product_full(t):
    return t.area_products(t.cities)


@query
def area_top3_product(t):
    return products.area_top3_product(t.area_products(t.cities), tables.LEVELS, TASK)


@query
def area_top3_product_by_sql(t):
    """The same report asked of the table function."""
    found = sql.views(PARAMS, tables.user_visit_action(t.spark, t.sf_dir), None, t.products, t.cities, tables.LEVELS)
    sql.register(t.spark, found, "clicktrail_")
    return t.spark.sql(f"""
        SELECT '{TASK}' AS taskid, area, area_level AS areaLevel, product_id AS productid, city_infos AS cityInfos,
               click_count AS clickCount, product_name AS productName, product_status AS productStatus
        FROM clicktrail_top_products(3)""")


@query
def area_top3_product_city_dimension(t):
    return products.area_top3_product(t.area_products(city_dimension(t.spark)), AREA_LEVELS, TASK)


# Sinks and stream


@query
def report_append(t):
    """Two tasks' category reports appended to one table, read back."""
    target = shared_folder(t.spark, "top10_category")
    totals = staged(category_activity(t), "category_activity")
    for task in (TASK, "t-0002"):
        reports.report_append(categories.top10_category(totals, task), target)
    return t.spark.read.parquet(target)


@query
def report_append_once(t):
    """Two tasks' category reports, the first of them saved twice, read back."""
    target = shared_folder(t.spark, "top10_category")
    totals = staged(category_activity(t), "category_activity")
    report = categories.top10_category(totals, TASK)
    for task in (TASK, "t-0002", TASK):
        reports.report_append(categories.top10_category(totals, task), target, once_per="taskid")
    return t.spark.read.schema(report.schema).parquet(target)


@query
def table_overwrite_dates(t):
    """A log whose middle dates, stored with other pages, are replaced by its own; the dates around them stay."""
    target = shared_folder(t.spark, "user_visit_action")
    middle = F.col("date").between("2024-01-10", "2024-01-12")
    reports.table_overwrite(t.log.withColumn("page_id", F.when(middle, -1).otherwise(F.col("page_id"))), target, "date")
    reports.table_overwrite(t.log.where(middle), target, "date", keep_others=True)
    stored = t.spark.read.schema(t.log.schema).parquet(target)
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("actions"), F.sum("page_id").alias("pages"))


@query
def table_overwrite(t):
    """The log replaced by its date range, stored by date; actions per date read back."""
    target = shared_folder(t.spark, "user_visit_action")
    source = tables.user_visit_action(t.spark, t.sf_dir)
    reports.table_overwrite(source.where(F.col("date") < PARAMS.start_date), target, "date")
    reports.table_overwrite(log.actions_in_range(source, PARAMS), target, "date")
    stored = t.spark.read.schema(source.schema).parquet(target)
    return (
        log.actions_in_range(stored, PARAMS)
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("actions"), F.count("order_category_ids").alias("orders"))
    )


def _ad_click_text(events: DataFrame) -> DataFrame:
    return events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
        *(F.col(name).cast("string") for name in ("province", "city", "user_id", "ad_id", "_corrupt")),
    )


@query
def ad_click_events(t):
    return _ad_click_text(ad_clicks.ad_click_events(tables.ad_click_lines(t.events)))


@query
def ad_click_stream(t):
    """The same lines through a stream into a table, read back when it is done."""
    events = t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parquet*")
    target = shared_folder(t.spark, "ad_clicks")
    running = ad_clicks.ad_click_stream(
        tables.ad_click_lines(events), target, shared_folder(t.spark, "ad_clicks_state")
    )
    running.awaitTermination()
    return _ad_click_text(t.spark.read.schema(AD_CLICK).parquet(target))


@query
def ad_click_sinks(t):
    """Valid and corrupt lines through a stream into two tables, started twice, read back."""
    events = t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parquet*")
    clicks, corrupt, state = (shared_folder(t.spark, name) for name in ("ad_clicks", "ad_clicks_corrupt", "ad_clicks_state"))
    for _ in range(2):
        ad_clicks.ad_click_sinks(tables.ad_click_lines(events), clicks, corrupt, state).awaitTermination()
    valid = t.spark.read.schema(AD_CLICK).parquet(clicks)
    bad = t.spark.read.parquet(corrupt).select(F.col("value").alias("_corrupt"))
    both = valid.drop("_corrupt").unionByName(bad, allowMissingColumns=True)
    return _ad_click_text(both).withColumn("sink", F.when(F.col("_corrupt").isNull(), "clicks").otherwise("corrupt"))


# Scalar functions


@query
def scalar_functions(t):
    """Per day of the log: its key there and back, the day before as the task of the day sees it, and its views as a packed report's field."""
    days = t.log.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    stamp = "CAST(date AS TIMESTAMP)"
    report = F.concat(F.lit("views="), F.col("n").cast("string"), F.lit("|pages=|none"))
    return days.selectExpr("*", f"{times.date_key(stamp)} AS date_key").select(
        "date",
        "date_key",
        F.expr(times.date_text(times.date_of_key("date_key"))).alias("date_again"),
        F.expr(times.yesterday_text("date")).alias("day_before"),
        packed.kv_value(report, "views").alias("views"),
        packed.kv_value(report, "pages").alias("pages"),
        packed.kv_value(report, "absent").alias("absent"),
        packed.kv_value(packed.kv_replaced(report, "views", "0"), "views").alias("views_replaced"),
    )


@query
def actions_of_yesterday(t):
    """Actions of the day before 2024-01-07, by the task parameters of a daily run."""
    params = TaskParams.of_yesterday(date(2024, 1, 7))
    found = log.actions_in_range(tables.user_visit_action(t.spark, t.sf_dir), params)
    return found.groupBy("date").agg(F.count(F.lit(1)).alias("actions"))
