"""Exact top-k search by pivot-table elimination.

The Euclidean distances of all vectors to a set of pivots are computed once. By the triangle
inequality |d(q, p) - d(x, p)| is at most d(q, x) for every pivot p; the largest of these bounds
limits the inner product from above: 2 q.x = |q|^2 + |x|^2 - d(q, x)^2. A query's candidates are
evaluated in the order of that limit, and the search stops when the limit of the next candidate
is below the k-th best score, so the result is exact.

Candidates and queries are dealt to blocks of neighbours. A small table holds each block's
ranges of pivot distances; from it a block of queries first takes the few most promising blocks,
whose scores bound the k-th from below, and then only blocks whose ranges allow a better score
for any of its queries. All others are never sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import cut, first_by_hash, integer_id
from ._vectors import finite, matrix, unpack

PIVOTS, SAMPLE = 32, 2048
#: Candidates and queries of a block; blocks that one task searches one after the other; blocks searched first; blocks of one row of the table of ranges.
BLOCK, QUERIES, RUN, FIRST, RANGES = 2048, 1024, 16, 2, 1024
#: 32-bit distances are off by less than this part of their size.
_OFF = 4e-7


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Pivots far from each other: each next one is the vector furthest from those chosen."""
    if not len(sample):
        return sample
    far = np.linalg.norm(sample - sample[0], axis=1)
    chosen = [int(np.argmax(far))]
    near = np.linalg.norm(sample - sample[chosen[0]], axis=1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of a vector and rows; beyond 64 bits, the nearest 64-bit value."""
    if len(q) == 0 or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * len(q) < 2**53:
        return (x @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(q, r, strict=True)) for r in x]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in exact], np.int64)


class Best:
    """The k best (score, id) of one query: larger scores first, then smaller ids."""

    def __init__(self, k: int, floor: float = -np.inf) -> None:
        """floor: a score that k candidates are known to reach."""
        self.k, self.floor, self.score, self.id = k, floor, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        if len(score) > 4 * self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[score >= least], ids[score >= least]
        order = np.lexsort((ids, ~score))[: self.k]
        self.score, self.id = score[order], ids[order]

    @property
    def least(self) -> float:
        return max(self.floor, float(self.score[-1])) if len(self.score) == self.k else self.floor


def limits(qq: np.ndarray, dq: np.ndarray, top: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries x blocks): no candidate of the block has a larger product with the query.

    top: the largest squared length of each block; lo, hi: its smallest and largest distance to
    each pivot.
    """
    gap = np.zeros((len(qq), len(top)))
    for p in range(dq.shape[1]):
        d = dq[:, p].astype(np.float64)[:, None]
        np.maximum(gap, np.maximum(lo[:, p].astype(np.float64)[None, :] - d, d - hi[:, p].astype(np.float64)[None, :]), out=gap)
    gap = np.maximum(0, gap - _OFF * (dq.max(1, initial=0)[:, None] + hi.max(1, initial=0)[None, :]))
    return (qq[:, None] + top[None, :] - gap * gap) / 2 + 1e-6 * (1 + qq[:, None] + top[None, :])


def search_block(best: list[Best], qid: np.ndarray, q: np.ndarray, dq: np.ndarray, ids: np.ndarray, x: np.ndarray, dx: np.ndarray) -> int:
    """Search one block of candidates for all queries; returns how many products were computed."""
    done = 0
    if not len(x):
        return done
    qq, xx = (q * q).sum(1), (x * x).sum(1)
    whole = limits(qq, dq, xx.max(keepdims=True), dx.min(0)[None, :], dx.max(0)[None, :])[:, 0]
    slack = 1e-6 * (1 + qq + xx.max(initial=0))
    open_q = [i for i in range(len(q)) if whole[i] >= best[i].least]
    step = max(1, (1 << 22) // max(1, len(x)))
    for at in range(0, len(open_q), step):
        rows = np.array(open_q[at : at + step])
        low = np.zeros((len(rows), len(x)), np.float32)
        for p in range(dx.shape[1]):
            np.maximum(low, np.abs(dq[rows, p].astype(np.float32)[:, None] - dx[:, p].astype(np.float32)[None, :]), out=low)
        low = np.maximum(0, low - _OFF * (dq[rows].max(1, initial=0)[:, None] + dx.max(1, initial=0)[None, :]).astype(np.float32))
        limit = (qq[rows][:, None] + xx[None, :] - low.astype(np.float64) ** 2) / 2 + slack[rows][:, None]
        for r, i in enumerate(rows):
            b, most, mine = best[i], limit[r], ids != qid[i]
            left = np.flatnonzero((most >= b.least) & mine)
            size = max(64, 2 * b.k)
            while len(left):
                if len(left) > size:
                    top = np.argpartition(-most[left], size)[:size]
                    now, left = left[top], np.delete(left, top)
                else:
                    now, left = left, left[:0]
                b.add(products(q[i], x[now]), ids[now])
                done += len(now)
                left = left[most[left] >= b.least]
                size *= 4
    return done


def _placed(batches, seeds: dict, queries: dict):
    """Rows with their length and the nearest of the seeds, of all and of those for queries."""
    for batch in batches:
        vectors = batch.column(1)
        size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        cell, asked = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for d in seeds:
            at = np.flatnonzero(size == d)
            x = np.floor(64.0 * matrix(vectors.take(pa.array(at)))) if len(at) else np.zeros((0, d))
            near = distances(x, seeds[d])
            cell[at] = near.argmin(1) if len(at) else 0
            asked[at] = near[:, : queries[d]].argmin(1) if len(at) else 0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int32()), pa.array(cell, pa.int32()), pa.array(asked, pa.int32())], names=["id", "vec", "dim", "cell", "asked"])


def _pack(table: pa.Table, pivots: dict) -> pa.Table:
    raw = np.floor(64.0 * matrix(table["vec"]))
    p = pivots.get(raw.shape[1])
    d = distances(raw, p).astype(np.float32) if p is not None and len(p) else np.zeros((len(raw), 0), np.float32)
    ids = table["id"].to_numpy()
    most = np.abs(raw).max(initial=0)
    kind = next((k for k, top in (("i1", 127), ("i2", 32767), ("i4", 2**31 - 1)) if most <= top), "f8")
    one = lambda a: pa.array([a.tobytes()], pa.binary())
    return pa.table({"block": table["block"].slice(0, 1), "ids": one(ids), "raw": one(raw.astype(kind)), "kind": pa.array([kind]), "dist": one(d), "dim": pa.array([raw.shape[1]], pa.int32()), "top": pa.array([float((raw * raw).sum(1).max(initial=0))]), "lo": one(d.min(0)), "hi": one(d.max(0))})


def _open(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = unpack(r["ids"], np.int64)
    return ids, unpack(r["raw"], r["kind"]).reshape(len(ids), r["dim"]).astype(np.float64), unpack(r["dist"], np.float32).reshape(len(ids), -1)


def _ranges(table: pa.Table) -> pa.Table:
    """The ranges of many blocks as one row."""
    join = lambda c: pa.array([b"".join(table[c].to_pylist())], pa.binary())
    return pa.table({"dim": table["dim"].slice(0, 1), "blocks": pa.array([table["block"].to_pylist()]), "tops": pa.array([table["top"].to_numpy().tobytes()], pa.binary()), "los": join("lo"), "his": join("hi")})


def _chosen(batches, first: int):
    """Rows (qblock, block, worth): for a block of queries, the blocks of a row of ranges to search.

    Without floors the first most promising ones, else those that may beat any query's floor.
    """
    for batch in batches:
        for r in batch.to_pylist():
            ids, q, dq = _open(r)
            n = len(r["blocks"])
            limit = limits((q * q).sum(1), dq, unpack(r["tops"]), unpack(r["los"], np.float32).reshape(n, -1), unpack(r["his"], np.float32).reshape(n, -1))
            worth = limit.mean(0)
            if r["floors"] is None:
                at = np.argsort(-worth, kind="stable")[:first]
            else:
                at = np.flatnonzero((limit >= unpack(r["floors"])[:, None]).any(0))
            yield pa.RecordBatch.from_arrays([pa.array([r["qblock"]] * len(at), pa.string()), pa.array([r["blocks"][i] for i in at], pa.string()), pa.array(worth[at])], names=["qblock", "block", "worth"])


def _run(queries: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """One block of queries against a run of candidate blocks, most promising first."""
    r = queries.to_pylist()[0]
    qids, q, dq = _open(r)
    floors = np.full(len(qids), -np.inf) if r["floors"] is None else unpack(r["floors"])
    best = [Best(k, f) for f in floors]
    opened = sorted(blocks.select(["worth", "ids", "raw", "kind", "dist", "dim"]).to_pylist(), key=lambda b: -b["worth"])
    for b in opened:
        search_block(best, qids, q, dq, *_open(b))
    n = np.array([len(b.id) for b in best])
    floors = np.array([b.least for b in best])
    one = lambda a: pa.array([a.tobytes()], pa.binary())
    return pa.table({"qblock": pa.array([r["qb"]]), "query": one(qids), "n": one(n), "ids": one(np.concatenate([b.id for b in best])), "scores": one(np.concatenate([b.score for b in best])), "floors": one(floors)})


def _merged(table: pa.Table, k: int) -> pa.Table:
    """The results of one block of queries over all runs."""
    best, queries = None, None
    for r in table.to_pylist():
        queries = unpack(r["query"], np.int64)
        best = best or [Best(k) for _ in queries]
        n, ids, score = (unpack(r[c], np.int64) for c in ("n", "ids", "scores"))
        end = np.cumsum(n)
        for i, b in enumerate(best):
            b.add(score[end[i] - n[i] : end[i]], ids[end[i] - n[i] : end[i]])
    count = np.array([len(b.id) for b in best])
    rank = np.concatenate([np.arange(1, c + 1) for c in count]).astype(np.int32)
    return pa.table({"query_id": pa.array(np.repeat(queries, count)), "rank": pa.array(rank), "vec_id": pa.array(np.concatenate([b.id for b in best])), "score": pa.array(np.concatenate([b.score for b in best]))})


def search(df: DataFrame, *, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by every, the k other
    rows with the largest inner product of the vectors' components floor(64 * x).

    Ties go to the smaller id; with fewer than k candidates all are returned. A query's own id is
    no candidate. Vectors that are null or hold null or non-finite components, and null ids, take
    no part; vectors of different lengths are not compared. Rows that repeat an id are candidates
    each, and a repeated query has its result once for each distinct vector. An empty table gives
    an empty result. Pivots come from at most SAMPLE vectors; they steer the order, not the result.
    """
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(vec_col).alias("vec"))
    rows = cut(rows.where(F.col("id").isNotNull() & finite("vec")))
    n = rows.count()
    sample = first_by_hash(rows.select("id", "vec", F.xxhash64("id").alias("h")), "h", SAMPLE, "id")
    pivots, seeds, for_queries = {}, {}, {}
    for d in {len(r.vec) for r in sample if len(r.vec)}:
        own = np.unique(np.floor(64.0 * np.array([r.vec for r in sample if len(r.vec) == d], np.float64)), axis=0)
        own = own[np.random.default_rng(d).permutation(len(own))]
        pivots[d], seeds[d], for_queries[d] = choose_pivots(own), own[: max(1, -(-n // block))], max(1, -(-n // (every * QUERIES)))
    schema = rows.schema.simpleString()[7:-1].replace(":", " ", 1).replace(",vec:", ", vec ")
    placed = cut(rows.mapInArrow(lambda it: _placed(it, seeds, for_queries), f"{schema}, dim int, cell int, asked int"))
    packed = "block string, ids binary, raw binary, kind string, dist binary, dim int, top double, lo binary, hi binary"

    def blocks(some: DataFrame, cell: str, size: int) -> DataFrame:
        # a cell with more rows than a block is split by a hash; there are at most SAMPLE cells of a length
        parts = some.groupBy("dim", cell).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
        name = F.concat_ws("/", "dim", cell, F.pmod(F.xxhash64("id", F.hash("vec")), F.col("parts")))
        return some.join(parts, ["dim", cell]).withColumn("block", name).groupBy("block").applyInArrow(lambda t: _pack(t, pivots), packed)

    cand = cut(blocks(placed, "cell", block))
    asked = cut(blocks(placed.where(F.col("id") % every == 0).select("id", "vec", "dim", "asked").distinct(), "asked", QUERIES)).withColumnRenamed("block", "qblock")
    n_ranges = max(1, -(-cand.count() // RANGES))
    group = F.pmod(F.xxhash64("block"), F.lit(n_ranges))
    ranges = cand.select("block", "dim", "top", "lo", "hi", group.alias("group")).groupBy("dim", "group").applyInArrow(_ranges, "dim int, blocks array<string>, tops binary, los binary, his binary")
    ranges = cut(ranges)

    def chosen(queries: DataFrame) -> DataFrame:
        return queries.join(ranges, "dim").mapInArrow(lambda it: _chosen(it, FIRST), "qblock string, block string, worth double")

    def searched(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        runs = pairs.select(F.col("qblock").alias("qb"), F.col("run").alias("qrun")).distinct()
        left, right = queries.withColumnRenamed("qblock", "qb").join(runs, "qb"), pairs.join(cand, "block")
        return left.groupBy("qb", "qrun").cogroup(right.groupBy("qblock", "run")).applyInArrow(lambda a, b: _run(a, b, k), "qblock string, query binary, n binary, ids binary, scores binary, floors binary")

    rank = F.row_number().over(Window.partitionBy("qblock").orderBy(F.desc("worth"), "block"))
    unknown = asked.withColumn("floors", F.lit(None).cast("binary"))
    first = cut(chosen(unknown).withColumn("rank", rank).where(F.col("rank") <= FIRST).select("qblock", "block", "worth", F.lit(0).alias("run")))
    found = cut(searched(unknown, first))
    known = asked.join(found.select("qblock", "floors"), "qblock")
    more = chosen(known).join(first.select("qblock", "block"), ["qblock", "block"], "left_anti")
    # the blocks still open, in runs of a bounded number of blocks
    place = F.row_number().over(Window.partitionBy("qblock").orderBy(F.desc("worth"), "block"))
    more = cut(more.withColumn("run", F.floor(place / RUN).cast("int")))
    part = found.union(searched(known, more)).drop("floors")
    return part.groupBy("qblock").applyInArrow(lambda t: _merged(t, k), "query_id long, rank int, vec_id long, score long")
