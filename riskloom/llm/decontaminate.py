"""Benchmark decontamination as a prefix-filtered join of exact windows.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole of a shorter item. Windows and documents are
seen as sequences of shingles (``SHINGLE`` words). The shingles are ordered by rarity, counted over all documents. For
full containment the necessary prefix of a window is its single rarest shingle: a document without it cannot hold the
window. So only places of that shingle are candidates; its offset in the window fixes where the window would start, and
windows that would begin before the document or end behind it are dropped. What is left is verified shingle by shingle,
by the words themselves, at every position of the window.

The documents are exploded once and only shingles of the benchmark stay, so no text is shuffled. All steps are DataFrame
functions.

Defined cases: a null text has no words; an item without words has no window; documents without a hit have
``n_hit`` 0, ``n_items`` 0 and the digest of an empty text; repeated rows each give a row; an empty table on either side
gives no hits; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, cut, text_or_empty

WINDOW = 10
SHINGLE = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A side with more rows than this is not broadcast; the join then shuffles.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (``item``, ``window``, ``length``): the window's words joined by one space."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_or_empty(text_col)).alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - WINDOW, F.lit(0))
    at = w.select("item", "_w", F.explode(F.sequence(F.lit(0), last)).alias("_at"))
    part = F.slice("_w", F.col("_at") + 1, F.lit(WINDOW))
    return at.select("item", F.array_join(part, " ").alias("window"), F.size(part).alias("length")).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """Shingles of distinct windows: ``window``, ``length``, ``offset``, ``width`` and the words ``w0`` .. ``w2``."""
    distinct = windows.select("window", "length").distinct().withColumn("_w", F.split("window", " "))
    width = F.least(F.col("length"), F.lit(SHINGLE))
    out = distinct.withColumn("width", width).withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("width"))))
    word = [F.when(F.col("width") > i, F.try_element_at("_w", F.col("offset") + 1 + i)).alias(f"w{i}") for i in range(SHINGLE)]
    return out.select("window", "length", "offset", "width", *word)


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint for a side whose rows were counted and are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def benchmark_places(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Places of benchmark shingles in the documents: ``doc``, ``version``, ``n_words``, ``pos``, ``shingle``.

    ``docs`` has ``doc``, ``version`` (a hash of the text, so that rows that share an id stay apart) and ``_w``.
    ``shingles`` has ``shingle`` (a number), ``width`` and the words.
    """
    out = None
    for width in sorted(r[0] for r in shingles.select("width").distinct().collect()):
        sides = [F.col("_w"), *[F.slice("_w", i + 1, F.size("_w")) for i in range(1, width)]]
        rows = (docs.select("doc", "version", F.size("_w").alias("n_words"),
                            F.posexplode(F.arrays_zip(*[s.alias(f"w{i}") for i, s in enumerate(sides)])).alias("pos", "_s"))
                .select("doc", "version", "n_words", "pos", *[F.col("_s")[f"w{i}"].alias(f"w{i}") for i in range(width)])
                .where(F.col(f"w{width - 1}").isNotNull()))
        known = small(shingles.where(F.col("width") == width).select("shingle", *[f"w{i}" for i in range(width)]))
        hits = rows.join(known, [f"w{i}" for i in range(width)]).select("doc", "version", "n_words", "pos", "shingle")
        out = hits if out is None else out.unionByName(hits)
    return out


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Where windows occur: ``doc``, ``version``, ``start``, ``length``, ``window``."""
    parts = window_shingles(windows)
    key = [f"w{i}" for i in range(SHINGLE)]
    shingles = cut(parts.select("width", *key).distinct().withColumn("shingle", F.monotonically_increasing_id()))
    same = [parts[c].eqNullSafe(shingles[c]) for c in ("width", *key)]
    parts = cut(parts.join(shingles, same).select("window", "length", "offset", "shingle"))
    if not shingles.head(1):
        return docs.select("doc", "version", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("window")).limit(0)
    places = cut(benchmark_places(docs, shingles))
    rarity = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    ranked = parts.join(rarity, "shingle", "left")
    # a window with a shingle that no document has cannot occur
    prefix = ranked.groupBy("window", "length").agg(
        F.min_by(F.struct("shingle", "offset"), F.struct(F.coalesce("n", F.lit(0)), "shingle", "offset")).alias("p"),
        F.min(F.coalesce("n", F.lit(0))).alias("least"), F.count(F.lit(1)).alias("parts"))
    prefix = cut(prefix.where("least > 0").select("window", "length", "parts", "p.shingle", "p.offset"))
    start = F.col("pos") - F.col("offset")
    candidates = (places.join(small(prefix), "shingle").withColumn("start", start)
                  .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
                  .select("doc", "version", "start", "length", "window", "parts").distinct())
    wanted = (candidates.join(small(parts.join(prefix.select("window"), "window", "left_semi").drop("length")), "window")
              .withColumn("pos", F.col("start") + F.col("offset")))
    here = places.select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), F.col("pos").alias("_pos"),
                         F.col("shingle").alias("_shingle")).distinct()
    match = (F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version"))
             & (F.col("pos") == F.col("_pos")) & (F.col("shingle") == F.col("_shingle")))
    found = wanted.join(here, match, "left_semi")
    return (found.groupBy("doc", "version", "start", "length", "window", "parts").agg(F.count(F.lit(1)).alias("_n"))
            .where("_n = parts").select("doc", "version", "start", "length", "window"))


def covered(spans: str) -> Column:
    """How many positions an array of (start, length) covers."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    def add(acc, x):
        end = x["start"] + x["length"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))
    return F.aggregate(F.sort_array(spans), zero, add, lambda acc: acc["n"])


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of some item; all columns stay, whatever their names."""
    text = text_or_empty(text_col)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("_own_id"), F.xxhash64(text).alias("_own_version"))
    windows = cut(item_windows(items))
    base = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), words_of(text).alias("_w"))
    bad = occurrences(base, windows).select(F.col("doc").alias("_bad_id"), F.col("version").alias("_bad_version")).distinct()
    same = F.col("_own_id").eqNullSafe(F.col("_bad_id")) & (F.col("_own_version") == F.col("_bad_version"))
    return rows.join(bad, same, "left_anti").select("row.*")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, and ``spans``, the windows' places."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), text.alias("_text"))
    windows = cut(item_windows(items))
    places = cut(occurrences(base.select("doc", "version", words_of(F.col("_text")).alias("_w")), windows))
    spans = places.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    names = (places.select("doc", "version", "window").distinct().join(small(windows.select("item", "window")), "window")
             .groupBy("doc", "version").agg(F.sort_array(F.collect_set("item")).alias("items")))
    found = spans.join(names, spans["doc"].eqNullSafe(names["doc"]) & (spans["version"] == names["version"])).select(
        spans["doc"].alias("_doc"), spans["version"].alias("_version"), "spans", "items")
    counted = base.select("doc", "version", F.regexp_count(ascii_lower(F.col("_text")), F.lit(WORD)).cast("long").alias("n_words"))
    j = counted.join(found, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")), "left")
    n_hit = F.coalesce(covered("spans"), F.lit(0)).cast("long")
    return j.select(
        F.col("doc").alias(id_col), "n_words", n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.col("spans"))
