"""Metric model, anomaly and text search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.registry import query
from riskloom.plans import anomaly, search, semantic
from riskloom.plans.lake import Lake


def model(lake: Lake, *tables: str) -> semantic.SemanticModel:
    build = {"daily_summary": lambda: lake.daily, "fraud_signals": lambda: lake.signals,
             "members": lambda: lake.activity(), "institutions": lambda: lake.institutions()}
    return semantic.FRAUD_MODEL.over({t: build[t]() for t in tables})


@query("sem_signals_by_severity_region", """
SELECT s.severity, i.region, count(s.signal_id) AS total_fraud_signals,
  count(*) FILTER (WHERE s.severity = 'CRITICAL') AS critical_signals
FROM g_signals s LEFT JOIN g_inst i ON s.institution_id = i.institution_id GROUP BY 1, 2""")
def sem_signals_by_severity_region(lake: Lake):
    return model(lake, "fraud_signals", "institutions").query(["total_fraud_signals", "critical_signals"],
                                                              ["severity", "region"])


@query("sem_volume_by_institution", """
SELECT i.institution_name, CAST(sum(d.total_amount) AS DECIMAL(24,2)) AS total_volume
FROM g_daily d LEFT JOIN g_inst i ON d.institution_id = i.institution_id
WHERE d.txn_date >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1 ORDER BY total_volume DESC NULLS LAST, 1 LIMIT 10""")
def sem_volume_by_institution(lake: Lake):
    return semantic.top_institutions_by_volume(model(lake, "daily_summary", "institutions"), lake.as_of)


@query("sem_members_by_tier", "SELECT risk_tier, count(DISTINCT member_id) AS total_members FROM g_activity GROUP BY 1")
def sem_members_by_tier(lake: Lake):
    return model(lake, "members").query(["total_members"], ["risk_tier"])


@query("sem_institutions_by_region", """
SELECT region, institution_type, count(DISTINCT institution_id) AS total_institutions FROM g_inst GROUP BY 1, 2""")
def sem_institutions_by_region(lake: Lake):
    return model(lake, "institutions").query(["total_institutions"], ["region", "institution_type"])


@query("sem_volume_and_signals_by_tier", """
WITH a AS (SELECT m.risk_tier, CAST(sum(d.txn_count) AS BIGINT) AS total_transactions,
    CAST(sum(d.total_amount) AS DECIMAL(24,2)) AS total_volume
  FROM g_daily d LEFT JOIN g_activity m ON d.member_id = m.member_id GROUP BY 1),
b AS (SELECT m.risk_tier, count(s.signal_id) AS total_fraud_signals
  FROM g_signals s LEFT JOIN g_activity m ON s.member_id = m.member_id GROUP BY 1)
SELECT coalesce(a.risk_tier, b.risk_tier) AS risk_tier, total_transactions, total_volume,
  coalesce(total_fraud_signals, 0) AS total_fraud_signals
FROM a FULL OUTER JOIN b ON a.risk_tier IS NOT DISTINCT FROM b.risk_tier""")
def sem_volume_and_signals_by_tier(lake: Lake):
    """Metrics of two fact tables over a shared dimension."""
    return model(lake, "daily_summary", "fraud_signals", "members").query(
        ["total_transactions", "total_volume", "total_fraud_signals"], ["risk_tier"])


@query("sem_daily_trend", """
SELECT txn_date AS transaction_date, CAST(sum(txn_count) AS BIGINT) AS total_transactions,
  CAST(sum(total_amount) AS DECIMAL(24,2)) AS total_volume
FROM g_daily WHERE txn_date >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1""")
def sem_daily_trend(lake: Lake):
    return semantic.volume_trend(model(lake, "daily_summary"), lake.as_of)


@query("sem_signals_this_week", """
SELECT signal_source, count(*) AS total_fraud_signals FROM g_signals
WHERE signal_time >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1""")
def sem_signals_this_week(lake: Lake):
    return semantic.signals_this_week(model(lake, "fraud_signals"), lake.as_of)


@query("sem_signals_by_severity", "SELECT severity, count(*) AS total_fraud_signals FROM g_signals GROUP BY 1")
def sem_signals_by_severity(lake: Lake):
    return semantic.signals_by_severity(model(lake, "fraud_signals"))


CRITICAL = """
SELECT i.institution_name, count(*) FILTER (WHERE s.severity = 'CRITICAL') AS critical_signals
FROM g_signals s LEFT JOIN g_inst i ON s.institution_id = i.institution_id WHERE i.institution_type = 'BANK' {extra}
GROUP BY 1 ORDER BY critical_signals DESC, 1 LIMIT 10"""


@query("sem_critical_banks", CRITICAL.format(extra=""))
def sem_critical_banks(lake: Lake):
    return semantic.critical_banks(model(lake, "fraud_signals", "institutions"))


@query("sem_critical_banks_30d", CRITICAL.format(extra="AND s.signal_time >= TIMESTAMP '2024-01-01 00:00:00'"))
def sem_critical_banks_30d(lake: Lake):
    return semantic.critical_banks_recent(model(lake, "fraud_signals", "institutions"), lake.as_of)


@query("sem_signal_overview", """
SELECT signal_source, severity, count(*) AS signals, count(DISTINCT member_id) AS members,
  count(DISTINCT institution_id) AS institutions FROM g_signals GROUP BY 1, 2""")
def sem_signal_overview(lake: Lake):
    return semantic.signal_overview(lake.signals)


# --- anomalies ----------------------------------------------------------------------------------

@query("anomaly_split", """
SELECT CASE WHEN txn_date < DATE '2024-01-24' THEN 'train' ELSE 'test' END AS part, txn_date,
  CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_daily_spend FROM g_daily GROUP BY 1, 2""")
def anomaly_split(lake: Lake):
    train, test = anomaly.split_series(lake.daily, lake.as_of)
    return train.select(F.lit("train").alias("part"), "*").unionByName(test.select(F.lit("test").alias("part"), "*"))


def _flags(key: str) -> str:
    part = f"PARTITION BY {key}" if key else ""
    k = f"{key}, " if key else ""
    t = "(1.0::DOUBLE / (1.0::DOUBLE + 0.2316419::DOUBLE * abs(z)))"
    poly = (f"{t} * (0.319381530::DOUBLE + {t} * (-0.356563782::DOUBLE + {t} * (1.781477937::DOUBLE + {t} * "
            f"(-1.821255978::DOUBLE + {t} * 1.330274429::DOUBLE))))")
    tail = f"0.3989422804014327::DOUBLE * exp(-z * z / 2.0::DOUBLE) * {poly}"
    return f"""
WITH d AS (SELECT {k}txn_date AS ts, CAST(CAST(sum(total_amount) AS DECIMAL(20,2)) AS DOUBLE) AS y FROM g_daily GROUP BY {k}txn_date),
l AS (SELECT *, lag(y) OVER ({part} ORDER BY ts) AS prev FROM d),
p AS (SELECT *, CASE WHEN ts < DATE '2024-01-24' THEN y - prev END AS step FROM l),
q AS (SELECT *, avg(step) OVER ({part}) AS mu, stddev_samp(step) OVER ({part}) AS sd FROM p),
r AS (SELECT *, prev + mu AS fc, (y - (prev + mu)) / nullif(sd, 0) AS z FROM q WHERE ts >= DATE '2024-01-24')
SELECT {k}ts, round(y, 2) AS y, round(fc, 2) AS forecast, round(fc - 1.959963984540054::DOUBLE * sd, 2) AS lower_bound,
  round(fc + 1.959963984540054::DOUBLE * sd, 2) AS upper_bound, abs(y - fc) > 1.959963984540054::DOUBLE * sd AS is_anomaly,
  round(CASE WHEN z >= 0 THEN 1.0::DOUBLE - {tail} ELSE {tail} END, 5) AS percentile, round(z, 5) AS distance
FROM r"""


@query("anomaly_flags", _flags(""))
def anomaly_flags(lake: Lake):
    return anomaly.detect(lake.daily, lake.as_of)


@query("anomaly_flags_by_institution", _flags("institution_id"))
def anomaly_flags_by_institution(lake: Lake):
    return anomaly.detect(lake.daily, lake.as_of, by=["institution_id"])


@query("anomaly_days", f"""
SELECT ts AS anomaly_date, y AS actual_spend, forecast, lower_bound, upper_bound, percentile, distance
FROM ({_flags('institution_id')}) f WHERE is_anomaly""")
def anomaly_days(lake: Lake):
    return anomaly.anomalous_days(anomaly.detect(lake.daily, lake.as_of, by=["institution_id"]))


@query("anomaly_gbt", """
WITH d AS (SELECT institution_id, txn_date AS ts, CAST(sum(total_amount) AS DECIMAL(20,2)) AS y FROM g_daily GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY institution_id ORDER BY ts) AS day_number FROM d)
SELECT institution_id, ts, round(CAST(y AS DOUBLE), 2) AS y, TRUE AS bounds_in_order, TRUE AS flag_fits_bounds, TRUE AS is_probability
FROM n WHERE ts >= DATE '2024-01-24' AND day_number > 6""")
def anomaly_gbt(lake: Lake):
    """Every test day that has five changes before it, and what must hold for a forecast whatever the trees say."""
    found = anomaly.detect_boosted(lake.daily, lake.as_of)
    outside = (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound"))
    return found.select("institution_id", "ts", F.round("y", 2).alias("y"), (F.col("lower_bound") <= F.col("upper_bound")).alias("bounds_in_order"),
                        (F.col("is_anomaly") == outside).alias("flag_fits_bounds"), F.col("percentile").between(0, 1).alias("is_probability"))


HISTOGRAM_INPUTS = ["lag1", "lag2", "lag3", "lag4", "lag5", "weekday"]


def histogram_sql(trees: int = 4, depth: int = 2, bins: int = 32, least: int = 5) -> str:
    """Every tree and level as steps of one statement: rows carry node and answer instead of a model."""
    lags = ", ".join(f"lag(step, {i}) OVER w AS lag{i}" for i in range(1, 6))
    steps = ", ".join(f"CAST(floor((least(greatest({c}, lo_{c}), hi_{c}) - lo_{c}) * {bins}::DOUBLE / (hi_{c} - lo_{c} + 1)) AS INT) AS {c}"
                      for c in HISTOGRAM_INPUTS)
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in HISTOGRAM_INPUTS)
    parts = [f"""WITH d AS (SELECT institution_id, txn_date AS ts, CAST(CAST(sum(total_amount) AS DECIMAL(20,2)) * 100 AS BIGINT) AS y
  FROM g_daily GROUP BY 1, 2),
c AS (SELECT *, lag(y) OVER w AS prev, y - lag(y) OVER w AS step FROM d WINDOW w AS (PARTITION BY institution_id ORDER BY ts)),
p AS (SELECT * FROM (SELECT *, {lags}, dayofweek(ts) + 1 AS weekday, ts < DATE '2024-01-24' AS known FROM c
  WINDOW w AS (PARTITION BY institution_id ORDER BY ts)) x WHERE lag5 IS NOT NULL),
ends AS (SELECT {ends} FROM p WHERE known),
t0 AS MATERIALIZED (SELECT institution_id, ts, y, prev, step, known, {steps}, 0::BIGINT AS said FROM p CROSS JOIN ends)"""]
    cells = " UNION ALL ".join(f"SELECT node, '{c}' AS input, {c} AS place, step - said AS rest FROM {{0}} WHERE known" for c in HISTOGRAM_INPUTS)
    value = "CASE b.input " + " ".join(f"WHEN '{c}' THEN r.{c}" for c in HISTOGRAM_INPUTS) + " END"
    for tree in range(trees):
        here = f"n{tree}_0"
        parts.append(f"{here} AS MATERIALIZED (SELECT *, 1 AS node FROM t{tree})")
        for level in range(depth):
            split, after = f"b{tree}_{level}", f"n{tree}_{level + 1}"
            parts.append(f"""{split} AS MATERIALIZED (SELECT node, input, place FROM (
  SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM (
    SELECT node, input, place, sum(n) OVER u AS nl, CAST(sum(s) OVER u AS DOUBLE) AS sl, sum(n) OVER a AS nt, CAST(sum(s) OVER a AS DOUBLE) AS st
    FROM (SELECT node, input, place, count(*) AS n, sum(rest) AS s FROM ({cells.format(here)}) x GROUP BY ALL) y
    WINDOW a AS (PARTITION BY node, input), u AS (PARTITION BY node, input ORDER BY place)) z
  WHERE nl >= {least} AND nt - nl >= {least}) g
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, input, place) = 1)""")
            parts.append(f"""{after} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN b.input IS NULL THEN r.node
  ELSE 2 * r.node + CASE WHEN {value} > b.place THEN 1 ELSE 0 END END AS node) FROM {here} r LEFT JOIN {split} b ON r.node = b.node)""")
            here = after
        parts.append(f"""v{tree} AS (SELECT node, CAST(floor(CAST(sum(step - said) AS DOUBLE) / (2 * count(*))) AS BIGINT) AS half
  FROM {here} WHERE known GROUP BY node)""")
        parts.append(f"""t{tree + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node) REPLACE (r.said + coalesce(v.half, 0) AS said)
  FROM {here} r LEFT JOIN v{tree} v ON r.node = v.node)""")
    last = f"t{trees}"
    parts.append(f"e AS (SELECT CAST(sum(abs(step - said)) AS DOUBLE) / count(*) * 1.959963984540054::DOUBLE / 0.7978845608028654::DOUBLE AS width FROM {last} WHERE known)")
    return ",\n".join(parts) + f"""
SELECT institution_id, ts, y, prev + said AS forecast, round(width, 2) AS half_width, abs(y - prev - said) > width AS is_anomaly
FROM {last} CROSS JOIN e WHERE NOT known"""


@query("anomaly_histogram", histogram_sql())
def anomaly_histogram(lake: Lake):
    """Forecasts, bounds and flags of the boosted histogram trees for every test day, tree by tree in SQL as well."""
    return anomaly.detect_histogram(lake.daily, lake.as_of)


# --- text search --------------------------------------------------------------------------------

@query("alerts_for_search", """
SELECT alert_id, member_id, institution_id, alert_type, severity, description,
  strftime(alert_timestamp, '%Y-%m-%d %H:%M:%S') AS alert_time FROM alert_notes""")
def alerts_for_search(lake: Lake):
    return search.alerts_for_search(lake.raw("alert_notes"))


@query("text_topk", r"""
WITH words AS (SELECT alert_id, list_filter(regexp_split_to_array(lower(description), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM alert_notes),
sized AS (SELECT alert_id, len(w) AS n, w FROM words),
tot AS (SELECT count(*) AS docs, CAST(sum(n) AS DOUBLE) / count(*) AS avg_len FROM sized),
asked AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS term FROM benchmark),
post AS (SELECT alert_id, term, n, count(*) AS tf FROM (SELECT alert_id, n, unnest(w) AS term FROM sized) x
  WHERE term IN (SELECT term FROM asked) GROUP BY alert_id, term, n),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
scored AS (SELECT a.query_id, p.alert_id,
    CAST(sum(CAST(round(ln(1.0::DOUBLE + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / avg_len)) * 1e9::DOUBLE) AS BIGINT)) AS BIGINT) AS s
  FROM post p JOIN df USING (term) JOIN asked a USING (term) CROSS JOIN tot GROUP BY a.query_id, p.alert_id)
SELECT query_id, alert_id, round(CAST(s AS DOUBLE) / 1e9::DOUBLE, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, alert_id) AS rank
FROM scored QUALIFY rank <= 5""")
def text_topk(lake: Lake):
    """The five best alert notes for every benchmark passage."""
    docs = search.alerts_for_search(lake.raw("alert_notes"))
    asked = lake.given("benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.text_topk(docs, asked, "alert_id", "description", "query_id", "text")
