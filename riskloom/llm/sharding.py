"""Shards of nearly equal bytes by longest processing time first.

Documents with equal texts form a group that stays together. Every group is scheduled: groups are counted by size, and
the sizes go through a heap on the driver, largest first, each group of a size to the least loaded shard. Only sizes and
counts travel, and there are never many: ``d`` different sizes need ``d * d / 2`` bytes of text, so 30 GB have at most
245,000. A size that many groups share is dealt in one step to the shards that as many turns of the heap would choose.
The schedule comes back as one row per size with the ranks each shard gets, and groups find their shard by their rank
among those of equal size, counted in chunks. Slots are counted per shard and chunk, so no task sees a whole shard.

Defined cases: a null text counts as empty (size 16, checksum 0) and is grouped with empty texts; repeated rows are
rows of their own with slots of their own; an empty table gives no rows; further columns are ignored, whatever their
names. Ties in size are placed in an order made of the group's digest, so the result is the same in every run.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import cut, stored, text_or_empty

OVERHEAD = 16
SLOT_CHUNK = 65_536
TURNS = 4  # sizes with more groups than this many per shard are dealt in one step
FREQUENT = 10_000  # fewer than this many texts can each have more than one in FREQUENT of all rows


def level(loads: list[int], size: int, n: int) -> list[int]:
    """How many of ``n`` items of one size each shard gets when each goes to the least loaded one, the first of equals.
    Shard i takes its items at loads ``loads[i] + k * size``; the ``n`` lowest of these are taken."""
    low, high = min(loads), min(loads) + n * size
    while low < high:
        middle = (low + high) // 2
        if sum((middle - x) // size + 1 for x in loads if x <= middle) >= n:
            high = middle
        else:
            low = middle + 1
    takes = [max(0, (low - 1 - x) // size + 1) for x in loads]
    rest = n - sum(takes)
    for shard in [i for i, x in enumerate(loads) if x <= low and (low - x) % size == 0][:rest]:
        takes[shard] += 1
    return takes


def schedule(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """Longest processing time first. Input: sizes with their number of groups, largest first. Output per size: the size,
    its number of groups, the shards that get some, and the rank at which each of them ends."""
    heap = [(0, s) for s in range(shards)]
    for size, n in sizes:
        takes: Counter[int] = Counter()
        if n > TURNS * shards:
            loads = [load for load, _ in sorted(heap, key=lambda x: x[1])]
            takes.update(dict(enumerate(level(loads, size, n))))
            heap = [(load + takes[s] * size, s) for s, load in enumerate(loads)]
            heapq.heapify(heap)
        else:
            for _ in range(n):
                load, shard = heap[0]
                heapq.heapreplace(heap, (load + size, shard))
                takes[shard] += 1
        to, ends, end = [], [], 0
        for shard in sorted(s for s in takes if takes[s]):
            end += takes[shard]
            to.append(shard)
            ends.append(end)
        yield size, n, to, ends


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, checksum, and the digest that stands for its text."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("group_key"))


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (group_key, bytes, ...) with ``shard``."""
    spark = groups.sparkSession
    counted = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("bytes", "descending")])
    sizes = zip(counted["bytes"].to_pylist(), counted["n"].to_pylist(), strict=True)
    shape = pa.schema([("bytes", pa.int64()), ("_n", pa.int64()), ("_to", pa.list_(pa.int32())), ("_ends", pa.list_(pa.int64()))])
    columns = list(zip(*schedule(sizes, shards), strict=True)) or [()] * 4
    plan = spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape))
    chunks = F.ceil(F.col("_n") / SLOT_CHUNK).cast("long")
    ranked = groups.join(plan, "bytes").withColumn("_chunk", F.pmod(F.xxhash64("group_key"), chunks))
    before = Window.partitionBy("bytes").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (ranked.groupBy("bytes", "_chunk").agg(F.count(F.lit(1)).alias("_held"))
              .select("bytes", "_chunk", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_first")))
    within = F.row_number().over(Window.partitionBy("bytes", "_chunk").orderBy("group_key")) - 1
    ranked = ranked.withColumn("_at", within).join(firsts, ["bytes", "_chunk"])
    full = F.size(F.filter("_ends", lambda end: end <= F.col("_first") + F.col("_at")))
    return ranked.select(*groups.columns, F.element_at("_to", full + 1).alias("shard"))


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, shard. Texts with many rows find their shard by a broadcast of fewer than
    ``FREQUENT`` of them, all others by a join."""
    rows = stored(sized(docs, id_col, text_col), "shard-rows")
    groups = stored(rows.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies")), "shard-groups")
    placed = stored(group_shards(groups, shards).select("group_key", "copies", "shard"), "shard-plan")
    often = F.broadcast(placed.where(F.col("copies") * FREQUENT > rows.count()).select("group_key", "shard"))
    others = rows.join(often, "group_key", "left_anti").join(placed.select("group_key", "shard"), "group_key")
    return rows.join(often, "group_key").unionByName(others).select("doc_id", "size", "text_crc32", "shard")


def add_slots(placed: DataFrame) -> DataFrame:
    """Gapless positions from 0 in every shard. Rows fall into chunks of about ``SLOT_CHUNK`` rows by their id; counts
    per chunk give each chunk's first position."""
    n = placed.count()
    chunks = max(1, -(-n // SLOT_CHUNK))
    chunked = placed.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(chunks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (chunked.groupBy("shard", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    within = F.row_number().over(Window.partitionBy("shard", "_chunk").orderBy("doc_id", "size", "text_crc32"))
    return (chunked.withColumn("_at", within - 1).join(firsts, ["shard", "_chunk"])
            .withColumn("slot", (F.col("_first") + F.col("_at")).cast("long")).drop("_first", "_at", "_chunk"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard. The law is ``bytes``; a grown shard count has no
    meaning under it."""
    placed = cut(assign_shards(docs, shards, id_col, text_col))
    return add_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
