"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Documents with the same word sequence form a class; its smallest id stands for it.
2. A representative has ``TREES * TREE_HASHES`` MinHash values. Each tree orders all signatures from another value on,
   and a prefix of that order is a node of the tree. Documents that share a node are neighbours by longest common
   prefix.
3. The depth adapts to the region: nodes of depth 6 with at most ``REGION`` documents give all their pairs. Fuller ones
   are split at depth 10 and then 16. In every fuller node each document is paired with the node's hub (the document
   that shares most nodes, usually the source that others were copied from), and below the last depth with its
   neighbour in the order. So the candidates grow with the documents, not with the square of a region.
4. Candidates are estimated from one byte of each MinHash value; ``EST_SLACK`` keeps those up to six standard
   deviations below the threshold. The others are compared on their full shingle sets. Only exact links count.
5. Connected components of the links give the groups so far. A full node of depth 6 that still holds more than one
   group is compared as a whole: its documents are dealt into tiles, and each pair of tiles is one unit of work that
   counts the common shingles of all its pairs and returns a spanning forest of their links. Documents of one group are
   not compared again. This work is quadratic in a node's documents that do not link, as the exact answer needs; what a
   task holds and returns is bounded by the tile.
6. Connected components of all links give the groups.

A pair at the threshold of 0.85 shares a node of depth 6 in at least one of 28 trees with probability 0.999998. For lower
thresholds the first depth is smaller (4 at 0.80), so that no more than ``MISS`` of the pairs there are lost.

Defined cases: a null text or one without words has an empty set and is linked with nothing; with fewer than five words
the whole sequence is the one shingle; repeated rows each give a row and are one class; an empty table gives no rows;
further columns are ignored, whatever their names; texts are never cut. A row without an id belongs to its text's class
and is never kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import cut, stored
from riskloom.llm.components import components
from riskloom.llm.embedding_dedup import spanning
from riskloom.llm.pretokens import mix, powers
from riskloom.llm.words import Words, sequence_hashes, word_batches

SHINGLE = 5
TREES, TREE_HASHES = 28, 8
DEPTHS = (6, 10, 16)
MISS = 2e-6
REGION = 16
EST_SLACK = 0.15
BLOCK = 2048
SLICES = 32
TILE, TILE_SHINGLES = 128, 1 << 20
COLUMNS = 4096

_RANDOM = mix(np.arange(1, 2 * TREES * TREE_HASHES + 1, dtype=np.uint64))
_FACTOR = (_RANDOM[:TREES * TREE_HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_OFFSET = (_RANDOM[TREES * TREE_HASHES:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(w: Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    hashes = sequence_hashes(w.hash, SHINGLE)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(hashes[a:b - SHINGLE + 1]))
        else:
            out.append(sequence_hashes(w.hash[a:b], SHINGLE)[:1])
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a set; all ones for an empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_FACTOR), 2**32 - 1, np.uint32)
    for at in range(0, len(x), BLOCK):
        np.minimum(out, (x[None, at:at + BLOCK] * _FACTOR[:, None] + _OFFSET[:, None]).min(1), out=out)
    return out


def depths_for(percent: int) -> tuple[int, ...]:
    """``DEPTHS``, the first of them so small that a pair at the threshold shares a node there."""
    fit = [d for d in range(1, DEPTHS[0] + 1) if (1 - (percent / 100) ** d) ** TREES <= MISS]
    return (max(fit, default=1), *DEPTHS[1:])


def node_keys(signatures: np.ndarray, depths: tuple[int, ...] = DEPTHS) -> list[np.ndarray]:
    """Keys of each document's nodes, (documents, trees) per depth. Tree ``t`` reads the signature from value
    ``t * TREE_HASHES`` on, around its end."""
    width = TREES * TREE_HASHES
    at = (np.arange(TREES)[:, None] * TREE_HASHES + np.arange(max(DEPTHS))[None]) % width
    place = np.arange(max(DEPTHS), dtype=np.uint64) << np.uint64(40)
    parts = np.cumsum(mix(signatures[:, at].astype(np.uint64) + place), axis=2, dtype=np.uint64)
    tree = np.arange(TREES, dtype=np.uint64)
    return [mix(parts[:, :, d - 1] + tree) for d in depths]


def class_keys(w: Words) -> list[bytes]:
    """128 bits that stand for each row's word sequence."""
    count = w.count()
    place = np.arange(len(w.hash)) - w.first[w.row]
    up = powers(int(count.max(initial=0)) + 1)[place]
    sums = []
    for salt in (0, 0x5851F42D4C957F2D):
        total = np.append(np.uint64(0), np.cumsum(mix(w.hash + np.uint64(salt)) * up, dtype=np.uint64))
        sums.append(mix(total[w.first[1:]] - total[w.first[:-1]] + count.astype(np.uint64)))
    return [a.tobytes() + b.tobytes() for a, b in zip(*sums, strict=True)]


def _describer(depths: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, w in word_batches(batch.column(1), True):
                mark = batch.column(2).slice(a, b - a)
                sets = shingle_sets(w)
                sig = np.array([signature(s) for s in sets], np.uint32)
                keys = node_keys(sig, depths)
                bounds = pa.array(np.arange(b - a + 1) * TREES, pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(k.reshape(-1).view(np.int64))) for k in keys[:1]]
                lists += [pa.ListArray.from_arrays(bounds, pa.array((k.reshape(-1) >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                          for k in keys[1:]]
                sketch = (sig & np.uint32(255)).astype(np.uint8)
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(class_keys(w), pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), *lists, pa.array([r.tobytes() for r in sketch], pa.binary()), mark],
                    names=["doc_id", "class", "n_shingles", "k0", "k1", "k2", "sketch", "mark"])
    return run


def describe(docs: DataFrame, id_col: str, text_col: str, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """Per row: class, set size, nodes, sketch and ``mark``, a hash of the text."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    return rows.mapInArrow(_describer(depths), "doc_id long, class binary, n_shingles long, k0 array<long>, k1 array<int>, "
                                      "k2 array<int>, sketch binary, mark long")


def _all_pairs(members: DataFrame, key: list[str]) -> DataFrame:
    """All pairs of nodes that are known to hold at most ``REGION`` documents."""
    ids = members.groupBy(*key).agg(F.sort_array(F.collect_set("id")).alias("_ids"))
    rest = F.transform("_ids", lambda x, i: F.transform(F.slice("_ids", i + 2, F.size("_ids")),
                                                        lambda y: F.struct(x.alias("a"), y.alias("b"))))
    return ids.select(F.inline(F.flatten(rest)))


def _counted(members: DataFrame, key: list[str], name: str) -> DataFrame:
    """``members`` of nodes that more than one of them share, with the number of documents there."""
    n = members.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    return members.join(n, key)


def _hub_pairs(members: DataFrame, key: list[str]) -> DataFrame:
    hub = members.groupBy(*key).agg(F.max_by("id", F.struct("shared", -F.col("id"))).alias("_hub"))
    j = members.join(hub, key).where("id <> _hub")
    return j.select(F.least("id", "_hub").alias("a"), F.greatest("id", "_hub").alias("b"))


def candidate_pairs(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (``a`` < ``b``) of class representatives that are neighbours in some tree, and the members (``k0``,
    ``id``, ``n_shingles``) of the full nodes, not all of whose pairs are among them."""
    members = (described.where("n_shingles > 0")
               .select(F.col("doc_id").alias("id"), "n_shingles", F.inline(F.arrays_zip("k0", "k1", "k2"))))
    level = cut(_counted(members, ["k0"], "n"))
    hubs = level.groupBy("id").agg(F.sum("n").alias("shared"))
    out = _all_pairs(level.where(F.col("n") <= REGION), ["k0"])
    members = level.where(F.col("n") > REGION).select("k0", "id", "n_shingles")
    full = level.where(F.col("n") > REGION).drop("n", "n_shingles").join(hubs, "id")
    for key in (["k0"], ["k0", "k1"], ["k0", "k1", "k2"]):
        full = cut(full)
        out = out.unionByName(_hub_pairs(full, key))
        if len(key) == len(DEPTHS):
            # equal over the whole depth, so any order serves; slices keep a huge node from meeting in one task
            order = Window.partitionBy(*key, F.pmod(F.xxhash64("id"), F.lit(SLICES))).orderBy("id")
            near = full.withColumn("_next", F.lead("id").over(order)).where("_next > id")
            out = out.unionByName(near.select(F.col("id").alias("a"), F.col("_next").alias("b")))
            break
        deeper = ["k0", "k1", "k2"][:len(key) + 1]
        level = cut(_counted(full, deeper, "n"))
        out = out.unionByName(_all_pairs(level.where(F.col("n") <= REGION), deeper))
        full = level.where(F.col("n") > REGION).drop("n")
    return out.distinct(), members


def _estimator(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_bytes_matrix(batch.column(i)) for i in (2, 3))
            same = (left == right).mean(1) if batch.num_rows else np.zeros(0)
            keep = pa.array((same - 1 / 256) / (1 - 1 / 256) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def _bytes_matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x.as_buffer(), np.uint8) for x in column]).reshape(len(column), -1)


def likely_pairs(pairs: DataFrame, described: DataFrame, threshold: float) -> DataFrame:
    sketch = described.select(F.col("doc_id").alias("_id"), "sketch")
    j = pairs.join(sketch.select(F.col("_id").alias("a"), F.col("sketch").alias("left")), "a")
    j = j.join(sketch.select(F.col("_id").alias("b"), F.col("sketch").alias("right")), "b")
    return j.select("a", "b", "left", "right").mapInArrow(_estimator(threshold - EST_SLACK), "a long, b long").distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for a, b, w in word_batches(batch.column(1), True):
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array([s.tobytes() for s in shingle_sets(w)], pa.binary())],
                                  names=["id", "shingles"])


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def sets_of(ids: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingle sets of the documents in ``ids``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(texts.join(ids, "id", "left_semi").mapInArrow(_sets, "id long, shingles binary"), "shingle-sets")


def exact_links(pairs: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Pairs whose full sets reach the threshold. Only texts that occur in a pair are turned into sets."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = sets_of(ids, docs, id_col, text_col)
    j = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
    j = j.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    return j.select("a", "b", "left", "right").mapInArrow(_verifier(percent), "a long, b long")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common values of each set on the left with each on the right."""
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    out = np.zeros((len(left), len(right)))
    placed = []
    for values, row in sides:
        held = np.isin(values, shared)
        at, row = np.searchsorted(shared, values[held]), row[held]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], row[order]))
    for start in range(0, len(shared), COLUMNS):
        both = []
        for (at, row), sets in zip(placed, (left, right), strict=True):
            a, b = np.searchsorted(at, (start, start + COLUMNS))
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[row[a:b], at[a:b] - start] = 1
            both.append(part)
        out += both[0] @ both[1].T
    return out


def _pack(table: pa.Table) -> pa.Table:
    """One row for a tile: its documents' ids, groups, set sizes and sets, each in one piece."""
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    ids, groups = (table[c].to_numpy().astype(np.int64) for c in ("id", "component"))
    return pa.table({
        "k0": table["k0"][:1], "tile": table["tile"][:1], "own": table["own"][:1], "ids": pa.array([ids.tobytes()], pa.binary()),
        "groups": pa.array([groups.tobytes()], pa.binary()), "sizes": pa.array([sizes.tobytes()], pa.binary()),
        "shingles": pa.array([np.concatenate(sets).tobytes()], pa.binary())})


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        blocks = []
        for row in table.sort_by("tile").to_pylist():
            ids, groups, sizes = (np.frombuffer(row[c], np.int64) for c in ("ids", "groups", "sizes"))
            sets = np.split(np.frombuffer(row["shingles"], np.uint64), np.cumsum(sizes)[:-1])
            blocks.append((ids, groups, sizes, sets))
        (ids_a, groups_a, sizes_a, a), (ids_b, groups_b, sizes_b, b) = blocks[0], blocks[-1]
        both = common_counts(a, b)
        links = 100 * both >= percent * (sizes_a[:, None] + sizes_b[None] - both)
        nodes, lows = spanning(links & (groups_a[:, None] != groups_b[None]), ids_a, ids_b)
        return pa.table({"a": pa.array(nodes, pa.int64()), "b": pa.array(lows, pa.int64())})
    return run


def full_node_links(members: DataFrame, groups: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Spanning forests of the links between different groups within full nodes. A group that fills a tile has tiles of
    its own, which are not compared with each other; smaller ones share tiles."""
    named = members.join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    parts = cut(named.groupBy("k0", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total")))
    tiles = F.ceil(F.greatest(F.sum("n") / TILE, F.sum("total") / TILE_SHINGLES)).alias("tiles")
    own = ((F.col("n") >= TILE) | (F.col("total") >= TILE_SHINGLES)).alias("large")
    mixed = parts.groupBy("k0").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("k0")
    parts = parts.join(mixed, "k0", "left_semi").select("*", own)
    counts = parts.groupBy("k0", F.when(F.col("large"), F.col("component")).alias("own")).agg(tiles)
    parts = parts.select("k0", "component", F.when(F.col("large"), F.col("component")).alias("own"))
    parts = cut(parts.alias("p").join(counts.alias("c"), (F.col("p.k0") == F.col("c.k0")) & F.col("p.own").eqNullSafe(F.col("c.own")))
                .select("p.k0", "p.component", "p.own", "c.tiles"))
    dealt = named.select("k0", "id", "component").join(parts, ["k0", "component"])
    salt = F.pmod(F.xxhash64(F.when(F.col("own").isNull(), F.col("component")).otherwise(F.col("id"))), F.col("tiles"))
    dealt = cut(dealt.select("k0", "id", "component", "own", F.concat_ws(":", "own", salt).alias("tile")))
    sets = sets_of(dealt.select("id").distinct(), docs, id_col, text_col)
    blocks = stored(dealt.join(sets, "id").groupBy("k0", "tile").applyInArrow(
        _pack, "k0 long, tile string, own long, ids binary, groups binary, sizes binary, shingles binary"), "tiles")
    other = blocks.select("k0", F.col("tile").alias("_tile"), F.col("own").alias("_own"))
    met = blocks.join(other, "k0").where("own is null or _own is null or own <> _own")
    met = met.withColumns({"lo": F.least("tile", "_tile"), "hi": F.greatest("tile", "_tile")}).drop("_tile", "_own", "own")
    return met.groupBy("k0", "lo", "hi").applyInArrow(_compare(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", marked: bool = False) -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links) and kept; ``marked`` adds ``mark``, the
    64-bit hash of the text, which tells rows of one id apart."""
    rows = stored(describe(docs, id_col, text_col, depths_for(percent)), "described")
    classes = cut(rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first")))
    standing = stored(rows.join(classes.where("first is not null"), "class").where("doc_id = first").drop("first", "class", "mark"), "standing")
    pairs, members = candidate_pairs(standing)
    pairs = cut(pairs)
    likely = cut(likely_pairs(pairs, standing, percent / 100))
    links = cut(exact_links(likely, docs, percent, id_col, text_col))
    groups = components(links)
    more = cut(full_node_links(members, groups, docs, percent, id_col, text_col))
    if not more.isEmpty():
        groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    groups = groups.select(F.col("node").alias("first"), "component")
    named = classes.join(groups, "first", "left").select("class", F.coalesce("component", "first").alias("component_id"))
    j = rows.select("doc_id", "class", "n_shingles", "mark").join(named, "class", "left")
    component = F.coalesce("component_id", "doc_id")
    return j.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), *(["mark"] if marked else []))
