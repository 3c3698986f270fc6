"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated to their principal axes, so the leading dimensions carry most of a
product. A pair of tiles multiplies the leading dimensions first; the rest of a product is at
most the product of the two suffix norms, and a pair whose sum can't reach the threshold is
dropped before its other dimensions are read. Tiles are boxes on the leading axes, cut at
medians of a sample; a small table holds each tile's ranges, and tiles that are further apart
than any linked pair can be are never sent to each other.

Equal vectors of a label are one class with a count, so a group of copies of any size costs one
row; links are counted with the classes' sizes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components
from ._spark import cut, first_by_hash, integer_id
from ._vectors import finite, matrix, unpack

THRESHOLD = 0.93
#: Vectors of a tile, of the sample that axes and cuts are taken from; the most cuts in a row, and the axes that are cut.
TILE, SAMPLE, DEPTH, AXES = 2048, 4096, 9, 8
STEPS = (8, 24)
_NEAR = 1e-9


def axes(sample: np.ndarray) -> np.ndarray:
    """Principal axes, widest first, of unit vectors (not centred, as products are wanted)."""
    _, v = np.linalg.eigh(sample.T @ sample)
    return v[:, ::-1]


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, upper: bool, steps: tuple = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine) of the pairs of unit vectors in PCA order with cosine >= threshold - 1e-9.

    upper: a and b are the same tile and only i < j is wanted.
    """
    d = a.shape[1]
    cuts = [k for k in steps if k < d]
    first = cuts[0] if cuts else d
    part = a[:, :first] @ b[:, :first].T
    bound = np.linalg.norm(a[:, first:], axis=1)[:, None] * np.linalg.norm(b[:, first:], axis=1)[None, :]
    alive = part + bound >= threshold - _NEAR
    if upper:
        alive &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    i, j = np.nonzero(alive)
    if len(i) > 0.1 * alive.size and d > first:
        # most pairs go on: the other dimensions in one product
        part += a[:, first:] @ b[:, first:].T
        got = part[i, j]
        ok = got >= threshold - _NEAR
        return i[ok], j[ok], got[ok]
    got, at = part[i, j], first
    for to in [*cuts[1:], d] if d > first else []:
        for lo in range(0, len(i), 1 << 18):
            s = slice(lo, lo + (1 << 18))
            got[s] += np.einsum("ij,ij->i", a[i[s], at:to], b[j[s], at:to])
        at = to
        rest = np.linalg.norm(a[:, at:], axis=1)[i] * np.linalg.norm(b[:, at:], axis=1)[j] if at < d else 0.0
        ok = got + rest >= threshold - _NEAR
        i, j, got = i[ok], j[ok], got[ok]
    return i, j, got


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that the links (i, j) reach."""
    low = np.arange(n)
    while True:
        new = low.copy()
        m = np.minimum(low[i], low[j])
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, low, new)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def cuts(turned: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(axis, value) of the nodes of a binary tree, children of k at 2 k and 2 k + 1: the widest leading axis at its median."""
    axis, value = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
    inside = {1: turned[:, :AXES]}
    for k in range(1, 1 << depth):
        rows = inside.pop(k)
        if len(rows):
            axis[k] = int(np.argmax(np.var(rows, axis=0)))
            value[k] = np.median(rows[:, axis[k]])
        right = rows[:, axis[k]] > value[k]
        inside[2 * k], inside[2 * k + 1] = rows[~right], rows[right]
    return axis, value


def leaves(turned: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int = DEPTH) -> np.ndarray:
    """The leaf of each vector, as the path of its cuts."""
    axis, value = tree
    node = np.ones(len(turned), np.int64)
    for _ in range(depth):
        node = 2 * node + (turned[np.arange(len(turned)), axis[node]] > value[node])
    return node - (1 << depth)


def _turned(raw: np.ndarray, basis: dict) -> np.ndarray:
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    return unit @ basis[raw.shape[1]] if raw.shape[1] in basis else unit


def _placed(batches, basis: dict, trees: dict):
    """Classes with the length of their vector and its leaf."""
    for batch in batches:
        vectors = batch.column(3)
        size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        leaf = np.zeros(len(size), np.int64)
        for d, tree in trees.items():
            at = np.flatnonzero(size == d)
            if len(at):
                leaf[at] = leaves(_turned(matrix(vectors.take(pa.array(at))), basis), tree)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int32()), pa.array(leaf, pa.int32())], names=["rep", "n", "label", "vec", "dim", "leaf"])


def _pack(table: pa.Table, basis: dict) -> pa.Table:
    """One row for a tile: ids, class sizes and the vectors as they are stored, and its ranges on the leading axes."""
    raw = matrix(table["vec"])
    turned = _turned(raw, basis)[:, :AXES]
    kind = "f4" if pa.types.is_float32(table["vec"].type.value_type) else "f8"
    one = lambda a: pa.array([a.tobytes()], pa.binary())
    first = {c: table[c].slice(0, 1) for c in ("tile", "label", "dim")}
    return pa.table({**first, "ids": one(table["rep"].to_numpy()), "sizes": one(table["n"].to_numpy()), "raw": one(raw.astype(kind)), "kind": pa.array([kind]), "lo": pa.array([turned.min(0).tolist()]), "hi": pa.array([turned.max(0).tolist()])})


def _compare(batches, basis: dict, threshold: float):
    """Rows (a, b, links): a number of vectors linked to class a (b null), or an edge a - b."""
    for batch in batches:
        for r in batch.to_pylist():
            d = r["dim"]
            ids, sizes = [unpack(r[f"{s}ids"], np.int64) for s in "lr"], [unpack(r[f"{s}sizes"], np.int64) for s in "lr"]
            same = r["ltile"] == r["rtile"]
            raw = [unpack(r[f"{s}raw"], r[f"{s}kind"], d).astype(np.float64) for s in "lr"]
            turned = [_turned(x, basis) for x in raw]
            i, j, got = linked_pairs(turned[0], turned[1], threshold, same)
            close = np.flatnonzero(np.abs(got - threshold) <= _NEAR)
            ok = np.ones(len(got), bool)
            for at in range(0, len(close), 1 << 18):
                c = close[at : at + (1 << 18)]
                x, y = raw[0][i[c]], raw[1][j[c]]
                ok[c] = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))) >= threshold
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            n = len(ids[0])
            j = j if same else j + n
            all_ids, all_sizes = (ids[0], sizes[0]) if same else (np.concatenate(ids), np.concatenate(sizes))
            links = np.bincount(i, all_sizes[j], len(all_ids)) + np.bincount(j, all_sizes[i], len(all_ids))
            some = np.flatnonzero(links)
            root = _forest(i, j, len(all_ids))
            hung = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([all_ids[some], all_ids[hung]])), pa.array([None] * len(some) + all_ids[root[hung]].tolist(), pa.int64()), pa.array(links[some].astype(np.int64).tolist() + [None] * len(hung), pa.int64())],
                names=["a", "b", "links"],
            )


def near_duplicate_vectors(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row of df.

    Ids must be integers. Vectors of one label (and one length) are linked when their cosine in double precision is at
    least threshold. n_links: other rows linked directly; component_id: the smallest id reachable
    by links; kept: the id is its component's smallest. Vectors that are null, zero, or hold null
    or non-finite components, and vectors without a label or id, link with nothing. Rows that
    repeat an id are compared row by row. Other columns play no part; an empty table gives an
    empty one. The axes come from at most SAMPLE vectors; they steer the order, not the result.
    """
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    rows = rows.withColumn("ok", F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite("vec") & (F.size("vec") > 0) & (norm > 0), F.lit(False)))
    usable = rows.where("ok").select("id", "label", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    by = ["label", "h1", "h2"]
    classes = cut(usable.groupBy(*by, "vec").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    sample = first_by_hash(classes.select("rep", "vec", F.xxhash64("rep").alias("h")), "h", SAMPLE, "rep")
    basis, trees = {}, {}
    for d in {len(r.vec) for r in sample}:
        m = np.array([r.vec for r in sample if len(r.vec) == d], np.float64)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        basis[d] = axes(m)
        trees[d] = cuts(m @ basis[d])
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("label", "vec")}
    tiles = cut(classes.select("rep", "n", "label", "vec").mapInArrow(lambda it: _placed(it, basis, trees), f"rep long, n long, label {kinds['label']}, vec {kinds['vec']}, dim int, leaf int"))
    # as many cuts as a label has tiles' worth of vectors; a leaf larger than a tile is split by a hash
    deep = F.least(F.lit(DEPTH), F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / tile)))).cast("int")
    wide = tiles.groupBy("label", "dim").agg(deep.alias("deep"))
    tiles = tiles.join(wide, ["label", "dim"]).withColumn("box", F.floor(F.col("leaf") / F.pow(F.lit(2), F.lit(DEPTH) - F.col("deep"))).cast("int"))
    parts = tiles.groupBy("label", "dim", "box").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    name = F.concat_ws("/", F.col("label").cast("string"), "dim", "box", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("parts")))
    placed = tiles.join(parts, ["label", "dim", "box"]).withColumn("tile", name).select("tile", "label", "dim", "rep", "n", "vec")
    packed = placed.groupBy("tile").applyInArrow(lambda t: _pack(t, basis), f"tile string, label {kinds['label']}, dim int, ids binary, sizes binary, raw binary, kind string, lo array<double>, hi array<double>")
    packed = cut(packed)
    left, right = (packed.select("label", "dim", *(F.col(c).alias(f"{s}{c}") for c in ("tile", "lo", "hi"))) for s in "lr")
    # the distance of two boxes, against the largest one of a linked pair
    apart = F.zip_with(F.zip_with("llo", "rhi", lambda x, y: x - y), F.zip_with("rlo", "lhi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)
    reach = float(max(0.0, 2 - 2 * threshold)) + 1e-6
    pairs = left.join(right, ["label", "dim"]).where((F.col("ltile") <= F.col("rtile")) & (apart <= reach)).select("ltile", "rtile")
    lp, rp = (packed.select("dim", *(F.col(c).alias(f"{s}{c}") for c in ("tile", "ids", "sizes", "raw", "kind"))) for s in "lr")
    both = pairs.join(lp, "ltile").join(rp.drop("dim"), "rtile")
    found = cut(both.mapInArrow(lambda it: _compare(it, basis, threshold), "a long, b long, links long"))
    links = found.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comp = components(found.where("b is not null").select("a", "b"))
    class_of = classes.select(*by, "rep", "n").join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    class_of = class_of.select(*by, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = usable.select("id", *by).join(class_of, by).select("id", "n_links", "component_id")
    rest = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.union(rest)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
