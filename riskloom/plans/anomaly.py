"""Unusual days in daily spend: a differenced-series form in plain columns and a boosted-tree form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import day_of, total
from riskloom.session import cut

# Normal quantile of a two-sided 95 % interval.
Z_95 = 1.959963984540054

# Rational approximation of the normal distribution function (error below 7.5e-8).
_NORMAL_P = 0.2316419
_NORMAL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
_NORMAL_PDF = 0.3989422804014327

RESULT = ("ts", "y", "forecast", "lower_bound", "upper_bound", "is_anomaly", "percentile", "distance")


def daily_series(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total spend per day, optionally per series key."""
    return daily.groupBy(*by, "txn_date").agg(total("total_amount", 20).alias("total_daily_spend"))


def split_series(daily: DataFrame, as_of: str, days: int = 7, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Training days before ``as_of - days``, and the days to test."""
    series = daily_series(daily, by)
    border = F.date_sub(day_of(as_of), days)
    return series.where(F.col("txn_date") < border), series.where(F.col("txn_date") >= border)


def normal_cdf(z: Column) -> Column:
    t = 1.0 / (1.0 + F.lit(_NORMAL_P) * F.abs(z))
    b1, b2, b3, b4, b5 = (F.lit(b) for b in _NORMAL_B)
    tail = F.lit(_NORMAL_PDF) * F.exp(-z * z / 2.0) * t * (b1 + t * (b2 + t * (b3 + t * (b4 + t * b5))))
    return F.when(z >= 0, 1.0 - tail).otherwise(tail)


def detect(daily: DataFrame, as_of: str, days: int = 7, by: Sequence[str] = (), z: float = Z_95) -> DataFrame:
    """Test days against the day before plus the usual daily change.

    The mean and spread of day-to-day changes come from the training days. Daily totals are aggregated first, so a
    series holds one row per day and the window over it stays small.
    """
    keys = list(by)
    part = keys if keys else [F.lit(1)]
    border = F.date_sub(day_of(as_of), days)
    y = F.col("total_daily_spend").cast("double")
    s = daily_series(daily, by).select(*keys, F.col("txn_date").alias("ts"), y.alias("y"))
    s = s.withColumn("prev", F.lag("y").over(Window.partitionBy(*part).orderBy("ts")))
    s = s.withColumn("step", F.when(F.col("ts") < border, F.col("y") - F.col("prev")))
    whole = Window.partitionBy(*part)
    s = s.withColumns({"mu": F.avg("step").over(whole), "sd": F.stddev_samp("step").over(whole)})
    forecast = F.col("prev") + F.col("mu")
    dist = (F.col("y") - forecast) / F.nullif(F.col("sd"), F.lit(0.0))
    half = F.lit(z) * F.col("sd")
    return s.where(F.col("ts") >= border).select(
        *keys, "ts", F.round("y", 2).alias("y"), F.round(forecast, 2).alias("forecast"),
        F.round(forecast - half, 2).alias("lower_bound"), F.round(forecast + half, 2).alias("upper_bound"),
        (F.abs(F.col("y") - forecast) > half).alias("is_anomaly"),
        F.round(normal_cdf(dist), 5).alias("percentile"), F.round(dist, 5).alias("distance"))


def anomalous_days(detected: DataFrame) -> DataFrame:
    return detected.where("is_anomaly").select(
        F.col("ts").alias("anomaly_date"), F.col("y").alias("actual_spend"), "forecast", "lower_bound", "upper_bound",
        "percentile", "distance").orderBy("anomaly_date")


def detect_boosted(daily: DataFrame, as_of: str, days: int = 7, key: str = "institution_id", lags: int = 5,
                   alpha: float = 0.05, trees: int = 8, depth: int = 3) -> DataFrame:
    """Boosted trees over lagged daily changes, one model for the whole panel of series; residual quantiles of the
    training days give the bounds."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    w = Window.partitionBy(key).orderBy("ts")
    s = daily_series(daily, [key]).select(key, F.col("txn_date").alias("ts"),
                                          F.col("total_daily_spend").cast("double").alias("y"))
    s = s.withColumn("prev", F.lag("y").over(w)).withColumn("step", F.col("y") - F.col("prev"))
    s = s.withColumns({f"lag{i}": F.lag("step", i).over(w) for i in range(1, lags + 1)})
    s = s.withColumn("weekday", F.dayofweek("ts").cast("double")).dropna()
    inputs = [f"lag{i}" for i in range(1, lags + 1)] + ["weekday"]
    # One row per series and day: written once, as every tree reads it again.
    panel = VectorAssembler(inputCols=inputs, outputCol="x").transform(cut(s))
    border = F.date_sub(day_of(as_of), days)
    train = panel.where(F.col("ts") < border)
    model = GBTRegressor(featuresCol="x", labelCol="step", maxIter=trees, maxDepth=depth, seed=7).fit(train)
    spread = model.transform(train).select((F.col("step") - F.col("prediction")).alias("r")).agg(
        F.percentile_approx("r", [alpha / 2, 1 - alpha / 2], 10_000).alias("q"), F.stddev_samp("r").alias("sd")).head()
    (lo, hi), sd = spread["q"], spread["sd"]
    forecast = F.col("prev") + F.col("prediction")
    dist = (F.col("y") - forecast) / F.lit(sd)
    return model.transform(panel.where(F.col("ts") >= border)).select(
        key, "ts", "y", forecast.alias("forecast"), (forecast + lo).alias("lower_bound"),
        (forecast + hi).alias("upper_bound"), (~F.col("y").between(forecast + lo, forecast + hi)).alias("is_anomaly"),
        normal_cdf(dist).alias("percentile"), dist.alias("distance"))


# Mean absolute deviation of a normal variable, as a share of its standard deviation: the square root of 2 / pi.
ABS_SHARE = 0.7978845608028654


def change_panel(daily: DataFrame, key: str, lags: int) -> tuple[DataFrame, list[str]]:
    """Per series and day with ``lags`` changes before it: total, the total before, the change and its inputs, in whole
    cents; and the names of the inputs."""
    w = Window.partitionBy(key).orderBy("ts")
    s = daily_series(daily, [key]).select(key, F.col("txn_date").alias("ts"), (F.col("total_daily_spend") * 100).cast("long").alias("y"))
    s = s.withColumn("prev", F.lag("y").over(w)).withColumn("step", F.col("y") - F.col("prev"))
    inputs = [f"lag{i}" for i in range(1, lags + 1)]
    s = s.withColumns({name: F.lag("step", i).over(w) for i, name in enumerate(inputs, 1)})
    return s.withColumn("weekday", F.dayofweek("ts").cast("long")).dropna(subset=inputs), [*inputs, "weekday"]


def binned(panel: DataFrame, inputs: Sequence[str], train: Column, bins: int) -> DataFrame:
    """``panel`` with each input as one of ``bins`` equal steps between its extremes in the training days."""
    ends = panel.where(train).agg(*[f(c).alias(f"{n}_{c}") for c in inputs for n, f in (("lo", F.min), ("hi", F.max))])
    clipped = {c: F.least(F.greatest(F.col(c), F.col(f"lo_{c}")), F.col(f"hi_{c}")) for c in inputs}
    share = {c: F.floor((clipped[c] - F.col(f"lo_{c}")) * bins / (F.col(f"hi_{c}") - F.col(f"lo_{c}") + 1)).cast("int") for c in inputs}
    return panel.join(F.broadcast(ends)).withColumns(share).select(*panel.columns)  # one row of extremes


def best_splits(rows: DataFrame, inputs: Sequence[str], node: Column, rest: Column, least: int) -> dict[int, tuple[str, int]]:
    """Per node the input and step behind which the squared error falls most; at most one row per node is collected."""
    pairs = F.array(*[F.struct(F.lit(c).alias("input"), F.col(c).alias("step")) for c in inputs])
    cells = (rows.select(node.alias("node"), rest.alias("rest"), F.inline(pairs)).groupBy("node", "input", "step")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("rest").alias("s")))
    upto, whole = Window.partitionBy("node", "input").orderBy("step"), Window.partitionBy("node", "input")
    cells = cells.select("node", "input", "step", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).cast("double").alias("sl"),
                         F.sum("n").over(whole).alias("nt"), F.sum("s").over(whole).cast("double").alias("st"))
    sl, st, nl, nt = (F.col(c) for c in ("sl", "st", "nl", "nt"))
    gain = sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt
    cells = cells.where((nl >= least) & (nt - nl >= least)).withColumn("gain", gain).where("gain > 0")
    order = Window.partitionBy("node").orderBy(F.desc("gain"), "input", "step")
    best = cells.withColumn("place", F.row_number().over(order)).where("place = 1")
    return {r["node"]: (r["input"], r["step"]) for r in best.collect()}


def detect_histogram(daily: DataFrame, as_of: str, days: int = 7, key: str = "institution_id", lags: int = 5, bins: int = 32,
                     trees: int = 4, depth: int = 2, least: int = 5, z: float = Z_95) -> DataFrame:
    """Boosted histogram trees over the panel of daily changes, in whole cents, so that every run and engine gets the
    same trees. A level of a tree is one grouped aggregate of at most ``2 ** depth * inputs * bins`` rows; the model
    itself is a column expression. The bounds come from the mean absolute error of the training days."""
    train = F.col("ts") < F.date_sub(day_of(as_of), days)
    panel, inputs = change_panel(daily, key, lags)
    rows = cut(binned(cut(panel), inputs, train, bins))
    known = rows.where(train)
    said = F.lit(0).cast("long")
    for _ in range(trees):
        rest, node = F.col("step") - said, F.lit(1)
        for _ in range(depth):
            splits = best_splits(known, inputs, node, rest, least)
            below = [F.when(node == k, 2 * k + (F.col(c) > step).cast("int")) for k, (c, step) in sorted(splits.items())]
            node = F.coalesce(*below, node)
        half = F.floor(F.sum("rest").cast("double") / (2 * F.count(F.lit(1)))).cast("long")  # learning rate of a half
        leaves = known.select(node.alias("node"), rest.alias("rest")).groupBy("node").agg(half.alias("half")).collect()
        said = said + F.coalesce(*[F.when(node == k, F.lit(v).cast("long")) for k, v in sorted(leaves)], F.lit(0).cast("long"))
    error = known.agg((F.sum(F.abs(F.col("step") - said)).cast("double") / F.count(F.lit(1))).alias("error"))
    out = rows.where(~train).withColumn("forecast", F.col("prev") + said).join(F.broadcast(error))  # one row
    width = F.col("error") * z / ABS_SHARE
    return out.select(key, "ts", "y", "forecast", F.round(width, 2).alias("half_width"),
                      (F.abs(F.col("y") - F.col("forecast")) > width).alias("is_anomaly"))
