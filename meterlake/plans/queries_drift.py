"""Distribution drift."""

from pyspark.sql import functions as F

from meterlake.operators import drift as D
from meterlake.plans.catalog import AS_OF, CALLS, calls, query, rounded, text
from meterlake.plans.session import work_folder
from meterlake.sources.interactions import read_table

COLUMNS = ["latency_ms", "total_tokens"]


def _statistics(samples: str) -> str:
    """CTEs samples -> sized, ks, scores (psi) for rows (feature_name, entity_id, hist, value)."""
    edges = ", ".join(f"q[{i}]" for i in range(1, 10))
    grid = ", ".join(str(i / 10) for i in range(1, 10))
    bin_no = f"len(list_filter([{edges}], lambda x: x <= value))"
    return f"""samples AS ({samples}),
sized AS (SELECT feature_name, entity_id, count(*) FILTER (hist) AS n_hist, count(*) FILTER (NOT hist) AS n_cur,
  quantile_cont(value, [{grid}]) FILTER (hist) AS q FROM samples GROUP BY 1, 2
  HAVING count(*) FILTER (hist) > 0 AND count(*) FILTER (NOT hist) > 0),
binned AS (SELECT feature_name, entity_id, {bin_no} AS bin, count(*) FILTER (hist) AS h, count(*) FILTER (NOT hist) AS c
  FROM samples JOIN sized USING (feature_name, entity_id) GROUP BY 1, 2, 3),
shares AS (SELECT s.feature_name, s.entity_id,
  CASE WHEN coalesce(h, 0) = 0 THEN 0.0001::DOUBLE ELSE h / n_hist END AS e,
  CASE WHEN coalesce(c, 0) = 0 THEN 0.0001::DOUBLE ELSE c / n_cur END AS a
  FROM sized s CROSS JOIN range(10) b(bin) LEFT JOIN binned USING (feature_name, entity_id, bin)),
scores AS (SELECT feature_name, entity_id, sum((a - e) * ln(a / e)) AS psi FROM shares GROUP BY 1, 2),
cdf AS (SELECT feature_name, entity_id, value,
  sum(sum(hist::INT)) OVER w AS ch, sum(sum((NOT hist)::INT)) OVER w AS cc FROM samples GROUP BY 1, 2, 3
  WINDOW w AS (PARTITION BY feature_name, entity_id ORDER BY value)),
ks AS (SELECT feature_name, entity_id, max(n_hist) AS n_hist, max(n_cur) AS n_cur,
  max(abs(ch / n_hist - cc / n_cur)) AS ks_statistic FROM cdf JOIN sized USING (feature_name, entity_id) GROUP BY 1, 2)"""


def _column_samples(entity: str, source: str = "calls", hist: str = "date < DATE '2024-01-24'") -> str:
    return f"""SELECT 'latency_ms' AS feature_name, {entity} AS entity_id, {hist} AS hist, latency_ms AS value FROM {source}
UNION ALL SELECT 'total_tokens', {entity}, {hist}, total_tokens::DOUBLE FROM {source}"""


DRIFT_BY_TYPE = f"{CALLS}, {_statistics(_column_samples('operation'))}"
DRIFT_BY_USER = f"{CALLS}, {_statistics(_column_samples('user_id'))}"

# Larger samples, with a real shift: line prices by return flag, early against late years.
LINES = _statistics("""SELECT 'price' AS feature_name, l_returnflag AS entity_id,
  l_shipdate < TIMESTAMP '1996-01-01' AS hist, l_extendedprice * (CASE WHEN l_shipdate < TIMESTAMP '1996-01-01'
  THEN 1 ELSE 1.25 END)::DOUBLE AS value FROM lineitem
UNION ALL SELECT 'quantity', l_returnflag, l_shipdate < TIMESTAMP '1996-01-01', l_quantity FROM lineitem""")


def line_samples(spark, folder):
    early = F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    raised = F.col("l_extendedprice") * F.when(early, 1.0).otherwise(1.25)
    pairs = F.array(
        F.struct(F.lit("price").alias("feature_name"), raised.alias("value")),
        F.struct(F.lit("quantity").alias("feature_name"), F.col("l_quantity").alias("value")))
    return read_table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("entity_id"),
        F.when(early, D.HISTORICAL).otherwise(D.CURRENT).alias("side"), F.inline(pairs))


def by_type(spark, folder):
    return D.samples_from_columns(calls(spark, folder), COLUMNS, AS_OF, entity="operation")


@query("D1_psi", f"{DRIFT_BY_TYPE} SELECT feature_name, entity_id, round(psi, 9) AS psi FROM scores")
def d1(spark, folder):
    return rounded(D.psi(by_type(spark, folder)), "psi", digits=9)


@query("D1_psi_lineitem", f"WITH {LINES} SELECT feature_name, entity_id, round(psi, 9) AS psi FROM scores")
def d1_lines(spark, folder):
    return rounded(D.psi(line_samples(spark, folder)), "psi", digits=9)


_KS = "SELECT feature_name, entity_id, round(ks_statistic, 9) AS ks_statistic, n_hist, n_cur FROM ks"


@query("D2_ks_statistic", f"{DRIFT_BY_TYPE} {_KS}")
def d2(spark, folder):
    return rounded(D.ks_statistic(by_type(spark, folder)), "ks_statistic", digits=9)


@query("D2_ks_statistic_lineitem", f"WITH {LINES} {_KS}")
def d2_lines(spark, folder):
    return rounded(D.ks_statistic(line_samples(spark, folder)), "ks_statistic", digits=9)


_TAIL = """CASE WHEN x2 < 0.03 THEN 1 ELSE greatest(0, least(1, 2 * list_sum(list_transform(range(1, 101),
  lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * j * j * x2))))) END"""


@query("D3_ks_pvalue", f"""{DRIFT_BY_USER}, x AS (
SELECT *, n_hist::DOUBLE * n_cur / (n_hist + n_cur) * ks_statistic * ks_statistic AS x2 FROM ks)
SELECT feature_name, entity_id, round({_TAIL}, 7) AS ks_pvalue, 'asymptotic' AS ks_method FROM x""")
def d3(spark, folder):
    samples = D.samples_from_columns(calls(spark, folder), COLUMNS, AS_OF, entity="user_id")
    result = D.with_pvalue(D.ks_statistic(samples), exact=False)
    return rounded(result.select(*D.KEY, "ks_pvalue", "ks_method"), "ks_pvalue")


# The lattice row by row: p[j + 1] is the share of paths to (i, j) that were outside.
_OUTSIDE = "abs(i * n_cur - j * n_hist) >= round(ks_statistic * n_hist * n_cur) - 0.5"


@query("D3_ks_pvalue_exact", f"""{DRIFT_BY_USER.replace("WITH ", "WITH RECURSIVE ", 1)},
paths AS (
  SELECT feature_name, entity_id, n_hist, n_cur, ks_statistic, 0::BIGINT AS i, list_reduce(
    list_prepend([CASE WHEN {_OUTSIDE.replace("i *", "0 *").replace("j *", "0 *")} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END],
      list_transform(range(1, n_cur + 1), lambda j: [j::DOUBLE])),
    lambda p, x: list_append(p, CASE WHEN {_OUTSIDE.replace("i *", "0 *").replace("j *", "x[1] *")} THEN 1.0::DOUBLE ELSE p[-1] END)) AS p
  FROM ks
  UNION ALL
  SELECT feature_name, entity_id, n_hist, n_cur, ks_statistic, i + 1, list_reduce(
    list_prepend([CASE WHEN {_OUTSIDE.replace("i *", "(i + 1) *").replace("j *", "0 *")} THEN 1.0::DOUBLE ELSE p[1] END],
      list_transform(range(1, n_cur + 1), lambda j: [j::DOUBLE, p[j + 1]])),
    lambda a, x: list_append(a, CASE WHEN {_OUTSIDE.replace("i *", "(i + 1) *").replace("j *", "x[1] *")} THEN 1.0::DOUBLE
      ELSE (x[2] * (i + 1) + a[-1] * x[1]) / (i + 1 + x[1]) END))
  FROM paths WHERE i < n_hist)
SELECT feature_name, entity_id, n_hist, n_cur, round(least(1.0, p[-1]), 7) AS ks_pvalue, 'exact' AS ks_method FROM paths WHERE i = n_hist""")
def d3_exact(spark, folder):
    samples = D.samples_from_columns(calls(spark, folder), COLUMNS, AS_OF, entity="user_id")
    result = D.with_pvalue(D.ks_statistic(samples), exact=True)
    return rounded(result.select(*D.KEY, "n_hist", "n_cur", "ks_pvalue", "ks_method"), "ks_pvalue")


_RAW_MOMENTS = """avg(value) FILTER (hist) AS historical_mean, avg(value) FILTER (NOT hist) AS current_mean,
  stddev_pop(value) FILTER (hist) AS historical_std, stddev_pop(value) FILTER (NOT hist) AS current_std"""
_MOMENTS = ", ".join(f"round({c}, 7) AS {c}" for c in ("historical_mean", "current_mean", "historical_std", "current_std"))
_MOMENT_NAMES = ["historical_mean", "current_mean", "historical_std", "current_std"]


@query("D4_sample_stats", f"""{DRIFT_BY_TYPE}, m AS (
SELECT feature_name, entity_id, {_RAW_MOMENTS} FROM samples GROUP BY 1, 2) SELECT feature_name, entity_id, {_MOMENTS} FROM m""")
def d4(spark, folder):
    return rounded(D.sample_stats(by_type(spark, folder)), *_MOMENT_NAMES)


_STATUS = "CASE WHEN psi > {t} * 2 THEN 'critical' WHEN psi > {t} THEN 'warning' ELSE 'no_drift' END"


@query("D5_drift_status", f"""{DRIFT_BY_USER}
SELECT feature_name, entity_id, {_STATUS.format(t="0.1")} AS drift_status FROM scores""")
def d5(spark, folder):
    samples = D.samples_from_columns(calls(spark, folder), COLUMNS, AS_OF, entity="user_id")
    return D.psi(samples).select(*D.KEY, D.drift_status().alias("drift_status"))


def _check(prefix: str) -> str:
    """All keys; those with only one of the samples have score 0 and no figures."""
    moments = ", ".join(f"CASE WHEN psi IS NOT NULL THEN round({c}, 7) END AS {c}" for c in _MOMENT_NAMES)
    return f"""{prefix}, m AS (SELECT feature_name, entity_id, {_RAW_MOMENTS} FROM samples GROUP BY 1, 2),
x AS (SELECT *, n_hist::DOUBLE * n_cur / (n_hist + n_cur) * ks_statistic * ks_statistic AS x2 FROM ks)
SELECT feature_name, entity_id, {_STATUS.format(t="0.1")} AS drift_status, round(coalesce(psi, 0), 7) AS drift_score,
  0.1::DOUBLE AS threshold, {moments},
  '2024-01-24 00:00:00' AS window_start, '2024-01-31 00:00:00' AS window_end, round(ks_statistic, 7) AS ks_statistic,
  CASE WHEN psi IS NOT NULL THEN round({_TAIL}, 7) END AS ks_pvalue,
  CASE WHEN psi IS NOT NULL THEN 'asymptotic' END AS ks_method,
  CASE WHEN psi IS NOT NULL THEN 'PSI + KS Test' ELSE 'insufficient data' END AS method,
  coalesce(psi, 0) > 0.1 AS drift_detected,
  round(CASE WHEN psi IS NOT NULL AND historical_mean <> 0 AND current_mean <> 0
    THEN (current_mean - historical_mean) / historical_mean * 100 END, 4) AS mean_change_percent
FROM m LEFT JOIN scores USING (feature_name, entity_id) LEFT JOIN x USING (feature_name, entity_id)"""


def _checked(result):
    result = result.withColumns({"method": F.col("details")["method"], "ks_method": F.col("details")["ks_method"]})
    result = rounded(result.drop("details"), "drift_score", "ks_statistic", "ks_pvalue", *_MOMENT_NAMES)
    result = rounded(result, "mean_change_percent", digits=4)
    return result.withColumns({c: text(c) for c in ("window_start", "window_end")})


@query("D6_check_drift", _check(f"WITH {LINES}"))
def d6(spark, folder):
    return _checked(D.check_drift(line_samples(spark, folder), AS_OF))


@query("D7_drift_from_history", _check(f"{CALLS}, " + _statistics(
    """SELECT operation AS feature_name, user_id AS entity_id, date < DATE '2024-01-24' AS hist, latency_ms AS value
FROM calls""")))
def d7(spark, folder):
    rows = calls(spark, folder).select(
        F.col("operation").alias("feature_name"), F.col("user_id").alias("entity_id"), "date",
        F.col("latency_ms").cast("string").alias("value"))
    return _checked(D.drift_from_history(rows, AS_OF))


@query("D7_unparsed_values", f"""{CALLS}
SELECT operation AS feature_name, count(*) FILTER (event_id % 9 = 0) AS unparsed FROM calls GROUP BY 1""")
def d7_unparsed(spark, folder):
    bad = F.substring("interaction_id", 5, 20).cast("long") % 9 == 0
    rows = calls(spark, folder).select(
        F.col("operation").alias("feature_name"),
        F.when(bad, "n/a").otherwise(F.col("latency_ms").cast("string")).alias("value"))
    return D.unparsed_values(rows)


@query("D8_drift_sweep", _check(DRIFT_BY_TYPE))
def d8(spark, folder):
    return _checked(D.drift_sweep(calls(spark, folder), COLUMNS, AS_OF, entity="operation"))


@query("D8_drift_sweep_from_counts", _check(DRIFT_BY_TYPE))
def d8_counts(spark, folder):
    root, rows = work_folder(spark, "drift-counts"), calls(spark, folder)
    last = F.col("date") >= F.lit("2024-01-30").cast("date")
    # The days before, one of them incomplete; then the new days, and the late one whole.
    D.refresh_daily_counts(rows.where(~last & ((F.col("date") != F.lit("2024-01-20").cast("date")) | F.col("is_error"))), root, COLUMNS, "operation")
    D.refresh_daily_counts(rows.where(last), root, COLUMNS, "operation")
    D.refresh_daily_counts(rows.where("date = DATE '2024-01-20'"), root, COLUMNS, "operation")
    return _checked(D.drift_from_counts(spark, root, AS_OF))


_LIMITS = """limits AS (SELECT feature_name, entity_id, avg(value) AS center, stddev_pop(value) AS sigma
FROM samples WHERE hist GROUP BY 1, 2)"""


@query("D9_spc_limits", f"""{DRIFT_BY_TYPE}, {_LIMITS}
SELECT feature_name, entity_id, round(center, 7) AS center, round(sigma, 7) AS sigma,
  round(center - 3 * sigma, 7) AS lower_limit, round(center + 3 * sigma, 7) AS upper_limit FROM limits""")
def d9(spark, folder):
    return rounded(D.spc_limits(by_type(spark, folder)), "center", "sigma", "lower_limit", "upper_limit")


@query("D9_spc_violations", f"""{DRIFT_BY_TYPE}, {_LIMITS}
SELECT feature_name, entity_id, value, round(center, 7) AS center FROM samples JOIN limits USING (feature_name, entity_id)
WHERE NOT hist AND (value < center - 3 * sigma OR value > center + 3 * sigma)""")
def d9_points(spark, folder):
    points = D.spc_violations(by_type(spark, folder)).select(*D.KEY, "value", "center")
    return rounded(points, "center")


@query("D10_drift_alerts", f"""WITH {LINES}
SELECT feature_name, entity_id, {_STATUS.format(t="0.1")} AS drift_status, round(psi, 7) AS drift_score
FROM scores WHERE psi > 0.1""")
def d10(spark, folder):
    alerts = D.drift_alerts(D.check_drift(line_samples(spark, folder), AS_OF))
    return rounded(alerts.select(*D.KEY, "drift_status", "drift_score"), "drift_score")
