"""The three report jobs, from input tables to saved reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from clicktrail.operators import actions as log
from clicktrail.operators import categories, funnel, products, sampling, sessions
from clicktrail.operators.skew import ROWS_PER_SPLIT
from clicktrail.params import TaskParams
from clicktrail.sources.shared import discard, staged

Save = Callable[[str, DataFrame], None]


def session_job(
    actions: DataFrame, users: DataFrame, params: TaskParams, task_id: str, save: Save
) -> None:
    """Length report, random sample, hottest categories and their top sessions.

    The filtered sessions, without their lists, are written once and every report
    starts from them, so the log is grouped by session only once; the length report's counters fill while they are
    written. The small results other reports depend on are written once as well. These tables are
    removed when the last report is saved. Each report is saved in one call.
    """
    selected = log.normalised_actions(log.actions_in_range(actions, params))
    kept = sessions.filtered_sessions(selected, users, params)
    kept, counters = sessions.observed_sessions(kept.drop("search_keywords", "click_category_ids"))
    kept = staged(kept, "sessions_filtered")
    save("session_aggr_stat", sessions.observed_aggr_stat(actions.sparkSession, counters, task_id))

    sample = staged(sampling.session_sample(kept, params), "session_sample")
    save("session_random_extract", sampling.session_random_extract(sample, selected, params, task_id))

    activity = categories.session_category_activity(categories.category_events(selected), kept)
    activity = staged(activity, "category_activity")
    top = staged(
        categories.top10_category(categories.category_activity(activity), task_id), "top10_category"
    )
    save("top10_category", top)

    clicks = categories.clicks_in_top_categories(activity, top)
    leaders = staged(categories.top10_session(clicks, task_id), "top10_session")
    save("top10_session", leaders)

    drawn_detail = sampling.session_random_detail(sample, selected, params, task_id)
    save("session_detail", drawn_detail.unionAll(categories.top10_session_detail(leaders, selected, task_id)))
    for made in (kept, sample, activity, top, leaders):
        discard(made)


def page_job(
    actions: DataFrame,
    params: TaskParams,
    task_id: str,
    save: Save,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> None:
    """Conversion rates along the task's page path, over all sessions of the date range.

    A session of more than ``rows_per_split`` actions is ordered in slices of about
    that many: as many as one task sorts well in the cluster's memory.
    """
    selected = log.normalised_actions(log.actions_in_range(actions, params))
    hot = staged(sessions.hot_sessions(sessions.session_summary(selected), rows_per_split), "hot_sessions")
    conversion = funnel.page_conversion(funnel.session_steps(selected, hot), params.target_page_flow)
    save("page_split_convert_rate", funnel.page_split_convert_rate(conversion, task_id))
    discard(hot)


def product_job(
    actions: DataFrame,
    cities: DataFrame,
    product_info: DataFrame,
    levels: Mapping[str, str],
    params: TaskParams,
    task_id: str,
    save: Save,
) -> None:
    """Top products per area, over all clicks of the date range."""
    clicks = products.city_product_clicks(log.clicked_products(actions, params))
    per_area = products.area_product_clicks(clicks, cities)
    full = products.area_product_full(per_area, product_info)
    save("area_top3_product", products.area_top3_product(full, levels, task_id))
