"""Names of all registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import apps, oracles, streams
from tidemark.plans import primitives as p
from tidemark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

APPLICATIONS: dict[str, Query] = {
    "q1_hot_items_top3": apps.hot_items,
    "q2_hot_items_sql_hop": apps.hot_items_sql,
    "q3_hot_items_tumble_rank": apps.hot_items_tumbling,
    "q4_hot_item_documents": apps.hot_item_documents,
    "q5_hot_urls": apps.hot_urls,
    "q6_pv_hourly": apps.page_views_hourly,
    "q7_uv_exact": apps.visitors_exact,
    "q8_uv_two_stage": apps.visitors_two_stage,
    "q9_uv_bitmap_tumble": apps.visitors_bitmap,
    "q9_uv_bitmap_slide": apps.visitors_bitmap_sliding,
    "q10_marketing_by_channel": apps.marketing_by_channel,
    "q10_marketing_total": apps.marketing_total,
    "q11_login_fail_pattern": apps.login_failures_pattern,
    "q11_login_fail_state": apps.login_failures_state,
    "q12_order_matched": apps.orders_paid,
    "q12_order_timeout": apps.orders_timed_out,
    "q12_order_timeout_state": apps.orders_timed_out_state,
    "q13_recon_matched": apps.reconciled,
    "q13_recon_unmatched": apps.unreconciled,
    "q14_sensor_min": apps.sensor_min,
    "q14_sensor_minmax": apps.sensor_min_max,
    "q14_sensor_avg": apps.sensor_average,
    "q14_sensor_count": apps.sensor_count,
    "q14_sensor_tumble_sql": apps.sensor_count_sql,
    "q15_jump_alert_default0": partial(apps.temperature_jumps, first_is_zero=True),
    "q15_jump_alert_skip_first": partial(apps.temperature_jumps, first_is_zero=False),
    "q15_rising_run": apps.rising_temperatures,
    "q15_freezing": apps.freezing,
    "q15_gate": apps.gated_readings,
    "q16_word_count": apps.word_count,
    "q16_word_count_windowed": apps.word_count_windowed,
}

PRIMITIVES: dict[str, Query] = {
    "s1_behavior_file": p.behavior_file,
    "s1_behavior_rejects": p.behavior_rejects,
    "s2_access_log": p.access_log,
    "s2_access_log_rejects": p.access_log_rejects,
    "s3_keyed_times": p.keyed_times,
    "s4_kafka_decode": p.kafka_decode,
    "s6_table_subset": p.table_subset,
    "s7_sql_view": p.sql_view,
    "k5_latest_per_key": p.latest_per_key,
    "k5_keyed_store": p.keyed_store,
    "k6_document_index": p.document_index,
    "k8_visitor_store": p.visitor_store,
    "k8_visitor_store_written": p.visitor_store_written,
    "t1_map": p.map_rows,
    "t2_filter": p.filter_rows,
    "t3_filter_greater": p.filter_greater,
    "t4_not_equal": p.filter_not_equal,
    "t5_flatmap": p.flat_map,
    "t6_tokenise": p.tokenise,
    "t7_table_select": p.table_select,
    "t8_rich_map": p.rich_map,
    "t9_split": p.split_branches,
    "t11_connect": p.connect,
    "t12_repartition": p.repartition,
    "u1_union": p.union,
    "j3_split_lateral": p.split_in_sql,
    "j4_orders_without_payment": apps.orders_without_payment,
    "a1_rolling_sum": partial(p.rolling_value, kind="sum"),
    "a2_rolling_min": partial(p.rolling_value, kind="min"),
    "a3_rolling_reduce": p.rolling_reduce,
    "a4_windowed_sum": p.windowed_sum,
    "a5_sliding_min": p.sliding_min,
    "a14_min_max_row": p.min_max_row,
    "a12_uv_sketch_slide": p.visitors_sketched,
    "a15_top2": p.top_two,
    "a15_top2_changelog": p.top_two_changes,
    "a19_channel_counts": p.channel_counts,
    "w4_busiest_users": p.rank_over_windows,
    "w5_hot_items_report": apps.hot_items_report,
    "f2_time_functions": p.time_functions,
    "f5_scalar_functions": p.scalar_functions,
    "f7_java_hash": p.string_hashes,
    "x1_hash_in_sql": p.hash_in_sql,
    "x2_split_words": p.split_native,
    "st4_timers": p.timer_callbacks,
    "st5_tumbling_close": p.tumbling_close,
    "st11_early_fire": p.early_fire,
    "st11b_fire_each_element": apps.visitors_running,
    "st12_changelog": p.change_log,
    "st12_ranked_changelog": apps.hot_items_changes,
    "st13_late": p.late_rows,
    "st14_behind_watermark": p.behind_watermark,
    "st15_allowed_lateness": p.allowed_lateness,
}

STREAMS: dict[str, Query] = {
    "w3_hot_items_stream": streams.hot_items,
    "a11_uv_two_stage_stream": streams.visitors,
    "p4_order_attempts_stream": streams.order_attempts,
    "st2_jumps_stream": streams.jumps,
    "st3_rising_run_stream": streams.rising_runs,
    "st4_timers_stream": streams.timers,
    "st5_tumbling_stream": streams.tumbling,
    "st7_order_timeout_stream": streams.order_timeouts,
    "st8_recon_stream": streams.reconciled,
    "st9_gate_stream": streams.gate,
    "st10_login_fail_stream": streams.login_failures,
    "st11_early_fire_stream": streams.early_fire,
    "st11b_uv_bitmap_stream": streams.visitors_bitmap,
    "a15_top2_changelog_stream": streams.top_two_changes,
    "st12_changelog_stream": streams.change_log,
    "st13_late_rows_stream": streams.late_rows,
    "k7_two_sinks_stream": streams.two_sinks,
    "k6_committed_stream": streams.committed_documents,
    "u1_union_stream": streams.union,
    "j2_gate_join_stream": streams.gate_by_join,
    "j4_unpaid_join_stream": streams.unpaid_by_join,
    "st1_bounded_stream": streams.bounded,
    "st1_custom_stream": streams.custom,
    "st17_resumed_stream": streams.resumed,
}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {n: _prepared(q) for n, q in {**APPLICATIONS, **PRIMITIVES, **STREAMS}.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
