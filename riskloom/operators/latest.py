"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(cols: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in cols]


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = (),
                method: str = "window") -> DataFrame:
    """One row per key: highest ``order``, then highest ``tiebreak``.

    ``window`` ranks rows and keeps the first. Catalyst limits every map task to one row per key before the
    shuffle, so a key that holds much of the table sends at most one row per input partition.
    ``max_by`` gives the same rows through a partial aggregate.
    """
    by = [*order, *tiebreak]
    if method == "max_by":
        packed = df.groupBy(*keys).agg(
            F.max_by(F.struct(*df.columns), F.struct(*[F.col(c) for c in by])).alias("_row"))
        return packed.select("_row.*")
    w = Window.partitionBy(*keys).orderBy(*newest_first(by))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def top_k(df: DataFrame, order: Sequence[Column], k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps ``k`` rows before the final merge."""
    return df.orderBy(*order, *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(k)
