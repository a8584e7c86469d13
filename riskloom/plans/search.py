"""Ranked text search over alert notes as a batch job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import as_text
from riskloom.session import cut

# Saturation and length weight of the ranking function.
K1 = 1.2
B = 0.75

MAX_SHARED_ROWS = 500_000

# Scored (query, word, document) rows of one task, on average.
TASK_ROWS = 2_000_000


def alerts_for_search(alerts: DataFrame) -> DataFrame:
    return alerts.select("alert_id", "member_id", "institution_id", "alert_type", "severity", "description",
                         as_text("alert_timestamp").alias("alert_time"))


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits of any script, of the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def shared_if_few(df: DataFrame) -> DataFrame:
    """A broadcast hint for a table whose rows were counted and are few."""
    return F.broadcast(df) if df.count() <= MAX_SHARED_ROWS else df


def text_topk(docs: DataFrame, queries: DataFrame, doc_id: str, text: str, query_id: str, query_text: str,
              k: int = 5) -> DataFrame:
    """Best ``k`` documents per query by term frequency, rarity and length.

    Each text is turned into one row per distinct word with its count and the text's length; only words of some query
    stay. Counted words are then placed by document, so scores add up inside a task and only ``k`` rows per query and
    task meet for the final ranking; query and document pairs are never shuffled. The number of tasks follows from the number
    of rows that the words of all queries will give, so a task holds as many however many documents there are. Query words are sent to all tasks
    only while they are few; beyond that both joins are by word, where adaptive execution splits frequent words.
    """
    asked = cut(queries.select(query_id, F.explode(F.array_distinct(terms(F.col(query_text)))).alias("term")))
    lists = docs.select(doc_id, terms(F.col(text)).alias("_terms")).withColumn("_len", F.size("_terms"))
    sizes = lists.agg(F.count(F.lit(1)).alias("docs"), (F.sum("_len").cast("double") / F.count(F.lit(1))).alias("avg_len")).head()
    if not sizes["docs"]:
        sizes = {"docs": 0, "avg_len": 1.0}
    words = lists.select(doc_id, "_len", F.explode("_terms").alias("term"))
    kept = words.join(shared_if_few(asked.select("term").distinct()), "term", "left_semi")
    postings = cut(kept.groupBy(doc_id, "term", "_len").agg(F.count(F.lit(1)).alias("_tf")))

    n, avg_len = F.lit(sizes["docs"]), F.lit(sizes["avg_len"])
    spread = postings.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    rarity = F.ln(1.0 + (n - F.col("_df") + 0.5) / (F.col("_df") + 0.5))
    weighted = cut(asked.join(spread, "term").select(query_id, "term", rarity.alias("_w"), "_df"))
    tasks = -(-(weighted.agg(F.sum("_df")).head()[0] or 1) // TASK_ROWS)

    damp = F.col("_tf") + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * F.col("_len") / avg_len)
    # Whole billionths add up to the same sum in any order.
    part = F.round(F.col("_w") * F.col("_tf") * F.lit(K1 + 1.0) / damp * F.lit(1e9)).cast("bigint")
    spark = docs.sparkSession
    by_doc = postings.repartition(max(tasks, spark.sparkContext.defaultParallelism), F.col(doc_id))
    scored = by_doc.join(shared_if_few(weighted.drop("_df")), "term").groupBy(query_id, doc_id).agg(F.sum(part).alias("_s"))
    w = Window.partitionBy(query_id).orderBy(F.desc("_s"), F.asc(doc_id))
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(query_id, doc_id, F.round(F.col("_s").cast("double") / F.lit(1e9), 6).alias("score"),
                    F.col("rank").cast("bigint").alias("rank")))
