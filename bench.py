"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Every
query runs once to warm up and once timed, and all its rows are produced.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterlake.plans.catalog import load_all  # noqa: E402
from meterlake.plans.session import build_session  # noqa: E402

HEADLINE = [
    # The four published queries, then one or more per family of operators.
    "A1_cost_by_day", "A2_cost_by_model", "A3_token_stats", "A4_top_users_by_cost",
    "A5_offline_features", "A6_cost_summary", "A13_cost_metric_rollup", "A15_latency_percentiles",
    "Q1_sql_passthrough",
    "V1_validate_interactions", "S4_split_valid_invalid", "S5_insert_interactions", "S7_archive_write",
    "S8_archive_read",
    "O1_online_features_ttl", "O2_online_features_lifetime", "O4_get_online_features", "O7_latest_feature_values",
    "O9_rolling_features",
    "E1_cache_lookup", "E4_embed_requests", "E8_vector_top_k", "P6_cache_key",
    "D1_psi", "D6_check_drift", "D8_drift_sweep",
    "T1_interactions_per_second", "T4_latency_p95_p99_5m", "T5_cost_24h", "T11_sessionized_online_features",
    "T12_ingest",
    "R1_alert_error_rate", "R6_alert_budget",
]
# Queries over the interactions, for the rate in rows per second.
PUBLISHED = HEADLINE[:4]


# Queries whose time is compared with that on a tenth of the data.
GROWTH = [*PUBLISHED, "S5_insert_interactions"]


def growth(spark, catalog, folder, times):
    """Time here over time on the folder with a tenth of the rows, where there is one."""
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    try:
        smaller = os.path.join(os.path.dirname(folder.rstrip("/")), f"sf{float(name) / 10:g}")
    except ValueError:
        return {}
    ratios = {}
    for query in GROWTH if os.path.isdir(smaller) else []:
        if query in times:
            consume(catalog[query].run(spark, smaller))
            start = time.perf_counter()
            consume(catalog[query].run(spark, smaller))
            ratios[query] = round(times[query] / (time.perf_counter() - start), 2)
    return ratios


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("meterlake-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("OFF")
    catalog = load_all()
    calls = spark.read.parquet(f"{folder}/events.parquet").count()
    times, failed = {}, {}
    for name in HEADLINE:
        try:
            consume(catalog[name].run(spark, folder))
            start = time.perf_counter()
            consume(catalog[name].run(spark, folder))
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # one broken query must not hide the others
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
    ratios = growth(spark, catalog, folder, times)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "interactions": calls,
        "rows_per_sec": {n: round(calls / times[n]) for n in PUBLISHED if n in times},
    }
    if ratios:
        result["time_ratio_to_a_tenth"] = ratios
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
