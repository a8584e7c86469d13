"""Near-duplicate vectors of equal labels by quantised tile products with error bounds.

Equal vectors of one label are first counted as one class. The classes of a label are dealt into tiles of about
``TILE`` vectors, and each pair of tiles is one unit of work, so a label with a third of all rows is spread over many
tasks. Each tile is rounded once, to int8 with one scale per vector, and only the rounded tiles are sent to the units.
With ``e`` the exact length of a vector's rounding error, the true cosine lies within ``e_a + (1 + e_a) * e_b`` of the
rounded product. A unit names the pairs that this bound lets reach the threshold, as bits over the vectors concerned;
those vectors alone are then fetched as doubles, and those pairs alone are computed in double precision. A unit
returns link counts per vector and a spanning forest of its links, never the pairs themselves.

The work of the tile products is quadratic in the size of a label, as the exact answer needs; memory and what is
shuffled per unit are fixed by the tile.

Defined cases: vectors that are null, of length zero, or hold nulls or non-finite numbers, and rows without a label,
link with nothing and are their own component; vectors of different lengths never link; lengths that double precision
cannot hold do not matter, as vectors are first brought near length one by a power of two; repeated rows count as
vectors of their own; rows that share an id but not the vector have their links counted together; an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut, stored
from riskloom.llm.components import components

TILE = 1024
PAIR_CHUNK = 1 << 16
SLACK = 1e-9


def usable(vec: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values, their scale per vector, and the length of each vector's rounding error."""
    scale = np.abs(unit).max(1) / 127
    values = np.rint(unit / scale[:, None]).astype(np.int8)
    return values, scale, np.linalg.norm(unit - values * scale[:, None], axis=1) + SLACK


def possible_pairs(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], threshold: float) -> np.ndarray:
    """Which pairs of two rounded tiles may reach the threshold."""
    (qa, sa, ea), (qb, sb, eb) = left, right
    # products of int8 values, whose sums below 2**24 float32 holds exactly
    block = np.float32 if qa.shape[1] * 127 * 127 < 2**24 else np.float64
    near = (qa.astype(block) @ qb.astype(block).T).astype(np.float64) * sa[:, None] * sb[None]
    near += ea[:, None] + (1 + ea[:, None]) * eb[None]
    return near >= threshold - SLACK


def exact_links(left: np.ndarray, right: np.ndarray, possible: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the possible pairs link, in double precision."""
    norms = [np.linalg.norm(x, axis=1) for x in (left, right)]
    rows, cols = np.nonzero(possible)
    links = np.zeros(possible.shape, bool)
    for at in range(0, len(rows), PAIR_CHUNK):
        i, j = rows[at:at + PAIR_CHUNK], cols[at:at + PAIR_CHUNK]
        exact = (left[i] * right[j]).sum(1) / (norms[0][i] * norms[1][j])
        links[i, j] = exact >= threshold
    return links


def balanced(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest entry between a half and one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """Which pairs of two tiles link, and how many were computed in double precision."""
    sides = [balanced(x) for x in (left, right)]
    possible = possible_pairs(*(quantise(x / np.linalg.norm(x, axis=1)[:, None]) for x in sides), threshold)
    return exact_links(*sides, possible, threshold), int(possible.sum())


def spanning(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every linked id to the smallest id it reaches within the tiles."""
    rows, cols = links.any(1), links.any(0)
    part = links[rows][:, cols]
    a, b = left[rows], right[cols]
    if not len(a):
        return a, a
    far = np.iinfo(np.int64).max
    low_a, low_b = a.copy(), b.copy()
    while True:
        new_a = np.minimum(low_a, np.where(part, low_b[None], far).min(1))
        new_b = np.minimum(low_b, np.where(part, new_a[:, None], far).min(0))
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    ids, low = np.append(a, b), np.append(low_a, low_b)
    return ids[ids != low], low[ids != low]


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["first", "mark"])
    vectors = balanced(np.array(pdf["vec"].tolist(), np.float64))
    values, scale, error = quantise(vectors / np.linalg.norm(vectors, axis=1)[:, None])
    row = pdf.iloc[0]
    return pd.DataFrame([{"label": row["label"], "dim": row["dim"], "tile": row["tile"], "tiles": row["tiles"],
                          "ids": pdf["first"].to_numpy(np.int64).tobytes(), "marks": pdf["mark"].to_numpy(np.int64).tobytes(), "rounded": values.tobytes(),
                          "scale": scale.tobytes(), "error": error.tobytes()}])


SIDES = ["left", "left_marks", "right", "right_marks"]
POSSIBLE = "label string, dim int, lo int, hi int, " + ", ".join(f"{c} array<long>" for c in SIDES) + ", possible binary"


def _possible(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        shape = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()),
                           *[(c, pa.list_(pa.int64())) for c in SIDES], ("possible", pa.binary())])
        tiles = []
        for row in table.sort_by("tile").to_pylist():
            scale, error = (np.frombuffer(row[c], np.float64) for c in ("scale", "error"))
            names = [np.frombuffer(row[c], np.int64) for c in ("ids", "marks")]
            tiles.append((names, (np.frombuffer(row["rounded"], np.int8).reshape(len(scale), -1), scale, error)))
        (left, a), (right, b) = tiles[0], tiles[-1]
        near = possible_pairs(a, b, threshold)
        if len(tiles) == 1:
            near |= near.T
            np.fill_diagonal(near, False)
        rows, cols = near.any(1), near.any(0)
        if not rows.any():
            return shape.empty_table()
        near = np.packbits(near[rows][:, cols])
        sides = [x[rows] for x in left] + [x[cols] for x in right]
        return pa.Table.from_pylist([{**{c: row[c] for c in ("label", "dim", "lo", "hi")}, **dict(zip(SIDES, sides, strict=True)),
                                      "possible": near.tobytes()}], schema=shape)
    return run


def _link(threshold: float):
    def run(units: pa.Table, vectors: pa.Table) -> pa.Table:
        shape = pa.schema([("is_link", pa.bool_()), ("a", pa.int64()), ("b", pa.int64())])
        out = [shape.empty_table()]
        place = {key: i for i, key in enumerate(zip(vectors["first"].to_pylist(), vectors["mark"].to_pylist(), strict=True))}
        copies = vectors["copies"].to_numpy()
        for unit in units.to_pylist():
            doubles = vectors["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            doubles = balanced(doubles.reshape(len(copies), -1))
            left, right = np.array(unit["left"], np.int64), np.array(unit["right"], np.int64)
            at_left, at_right = (np.array([place[key] for key in zip(unit[c], unit[c + "_marks"], strict=True)]) for c in ("left", "right"))
            possible = np.unpackbits(np.frombuffer(unit["possible"], np.uint8), count=len(left) * len(right))
            links = exact_links(doubles[at_left], doubles[at_right], possible.reshape(len(left), len(right)).astype(bool), threshold)
            counts = [(left, links @ copies[at_right])]
            if unit["lo"] != unit["hi"]:
                counts.append((right, copies[at_left] @ links))
            nodes, lows = spanning(links, left, right)
            a_side = np.concatenate([side[n > 0] for side, n in counts] + [nodes])
            b_side = np.concatenate([n[n > 0] for _, n in counts] + [lows])
            kind = np.arange(len(a_side)) >= len(a_side) - len(nodes)
            out.append(pa.table([pa.array(kind), pa.array(a_side.astype(np.int64)), pa.array(b_side.astype(np.int64))], schema=shape))
        return pa.concat_tables(out)
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """Per row: id, n_links, component_id and kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.col(label_col).cast("string").alias("label"))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec")))
    classes = cut(good.groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    dim = F.size("vec").alias("dim")
    sizes = classes.groupBy("label", dim).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = classes.select("label", "first", F.xxhash64("vec").alias("mark"), "vec", dim).join(sizes, ["label", "dim"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("first"), F.col("tiles")).cast("int"))
    shape = "label string, dim int, tile int, tiles int, ids binary, marks binary, rounded binary, scale binary, error binary"
    tiles = stored(dealt.groupBy("label", "dim", "tile").applyInPandas(_round, shape), "rounded-tiles")
    met = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")})
    unit = ["label", "dim", "lo", "hi"]
    units = stored(met.groupBy(*unit).applyInArrow(_possible(threshold), POSSIBLE), "possible-pairs")
    names = F.array_union(F.arrays_zip(F.col("left").alias("first"), F.col("left_marks").alias("mark")),
                          F.arrays_zip(F.col("right").alias("first"), F.col("right_marks").alias("mark")))
    wanted = units.select(*[F.col(c).alias(c) for c in unit], F.inline(names))
    fetched = wanted.join(classes.select("label", "first", F.xxhash64("vec").alias("mark"), "copies", "vec"), ["label", "first", "mark"])
    found = cut(units.groupBy(*unit).cogroup(fetched.groupBy(*unit)).applyInArrow(_link(threshold), "is_link boolean, a long, b long"))
    counts = found.where("not is_link").groupBy(F.col("a").alias("first")).agg(F.sum("b").alias("others"))
    groups = components(found.where("is_link").select("a", "b")).select(F.col("node").alias("first"), "component")
    named = (classes.join(counts, "first", "left").join(groups, "first", "left")
             .select("label", "vec", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "first").alias("component_id")))
    joined = good.join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec"))))
    out = joined.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
