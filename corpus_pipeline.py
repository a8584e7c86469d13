"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``:

1. toxicity: documents that the ordinal model, fitted on ``labels``, finds toxic go.
2. minhash_near_dedup: of each group of near-duplicates (sets of five-word shingles with a similarity of 0.80 or more) the
   document with the smallest id stays. Rows without an id are compared like others and come after all that have one.
3. substring_dedup: passages of 50 words that an earlier document has are cut out; ``n_chars`` follows the new text, and a
   document of which nothing is left goes. Texts that lose nothing stay as they are.
4. decontamination: documents that hold a window of a ``benchmark`` item go.
5. bpe: whole texts as packed token ids, and digests of the ids and of the text decoded from them.

The first stage fits a model, which SQL cannot express, so ORACLE_SQL is None; tests hold every stage and the whole
against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, decontaminate, minhash_forest, substring_dedup, toxicity
from riskloom.llm.common import read_table, ship_package
from riskloom.session import new_path

BPE_FILE = "byte_bpe_50k.json"
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat id and text of the document that stays go as well. Of two texts under one id each is judged for
    itself."""
    ship_package(spark)
    # rows without an id stand under a number made of their text
    late = F.lit(2**62) + F.pmod(F.xxhash64("text"), F.lit(2**61))
    key = F.coalesce(F.col("doc_id").cast("long"), late)
    keyed = docs.select(key.alias("key"), "text", F.xxhash64(F.col("text").cast("string")).alias("mark"), F.struct(*docs.columns).alias("row"))
    judged = minhash_forest.near_duplicates(keyed, NEAR_PERCENT, id_col="key", marked=True)
    kept = judged.where("kept").select("key", "mark").distinct()
    return keyed.join(kept, ["key", "mark"], "left_semi").dropDuplicates(["key", "mark", "text"]).select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).dropFields("text").alias("row"))
    out = substring_dedup.remove_repeats(rows, carry=["row"], as_is=True).where("n_removed = 0 OR n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row")["n_chars"]).cast("long") if "n_chars" in docs.columns else None
    new = {"text": F.col("kept"), "n_chars": n_chars}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    back = bpe.round_trip(docs, public_tokenizers.path(BPE_FILE))
    return back.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("bpe", to_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
