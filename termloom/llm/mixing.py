"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of source, language and topic, weighted by tokens of a public
tokenizer. Raking scales the cells' rates by one factor for each source, language and topic in
turn, none beyond 1, until the expected tokens have the target shares of all three marginals and
add up to the token budget. A document's probability is its cell's rate, and documents are drawn
by a hash of their id. Topics are clusters of the words of all documents (spherical k-means),
found within each language and numbered by size, so that a topic's share doesn't fix a language's.
"""

from __future__ import annotations

import itertools
import pickle
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut, give_back, integer_id
from ._text import U64, Words, mix, release, runs
from .token_counts import _vocabulary, encoded

#: The most cells that are raked on the driver; more are raked, by the same rule, as a distributed table.
DRIVER_CELLS = 200_000
#: Rounds of raking and the relative miss of a marginal at which it stops.
ROUNDS, TOLERANCE = 200, 1e-9
#: Target shares are proportional to tokens ** alpha, for classes without a share of their own.
ALPHA = {"source": 0.7, "lang": 0.8, "topic": 0.8}
#: Expected tokens of the sample, as a share of all, where no budget is given.
SHARE = 0.5
#: Topics; buckets of words, as a power of 2; rounds of k-means at most.
TOPICS, BITS, STEPS = 6, 13, 25
#: Documents, and share of all documents, that a language needs for topics of its own; others share the topics of all.
OWN, OWN_SHARE = 50, 0.025
#: Vectors hold whole multiples of 2 ** -SCALE: their sums are exact, so rows may come in any order and parts.
SCALE = 24
#: The power of a document's distance to the first centres before it by which it is drawn as the next one.
AWAY = 4
#: Entries of vectors in one row of their table; bytes of sums that the tasks of one round make, which one task adds up.
ENTRIES, SUM_BYTES = 1 << 18, 128 << 20


# Topics and tokens -----------------------------------------------------------------------------
@dataclass
class Topics:
    """tables: for each language, and None for all others, what a token of each bucket of words adds to each topic's score."""

    tables: dict


def _bucket(words: Words) -> np.ndarray:
    return (words.hash & U64((1 << BITS) - 1)).astype(np.int64)


def vectors(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, bucket, count): how many buckets of words each whole text has, and those buckets and their counts, text by text."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, _hi, part, words in runs(texts):
        key, n = np.unique((words.doc + lo) << BITS | _bucket(words), return_counts=True)
        if part:
            # a long text goes on
            key, at = np.unique(np.concatenate([keys[-1], key]), return_inverse=True)
            n = np.bincount(at, np.concatenate([counts[-1], n])).astype(np.int64)
            keys.pop(), counts.pop()
        keys.append(key)
        counts.append(n)
    key = np.concatenate(keys)
    return np.bincount(key >> BITS, minlength=len(texts)), (key & ((1 << BITS) - 1)).astype("<u2"), np.concatenate(counts).astype("<u4")


def _sums(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sums of runs of n values, none of them empty."""
    return np.add.reduceat(value, np.cumsum(n) - n) if len(n) else np.zeros(0)


def _weighted(n: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The tf-idf vectors of length 1 of documents of n buckets each, in units of 2 ** -SCALE."""
    x = count * idf[bucket]
    return np.rint(x * np.repeat(2.0**SCALE / np.sqrt(_sums(x * x, n)), n)).astype("<i4")


def _products(n: np.ndarray, bucket: np.ndarray, value: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The product of each vector with each centre; in blocks of vectors that fit a cache."""
    out, start = np.zeros((len(centres), len(n))), np.cumsum(n) - n
    for lo, hi in itertools.pairwise(np.flatnonzero(np.diff(start >> 14, prepend=-1, append=-1))):
        span = slice(int(start[lo]), int(start[hi - 1] + n[hi - 1]))
        x, at, first = value[span].astype(np.float64), bucket[span].astype(np.intp), start[lo:hi] - start[lo]
        one = np.empty(len(x))
        for row, c in zip(out, centres, strict=True):
            np.take(c, at, out=one, mode="clip")
            np.add.reduceat(np.multiply(one, x, out=one), first, out=row[lo:hi])
    return out


def _drawn(shards, centres: dict, turn: int) -> dict:
    """For each group the document drawn as the next first centre: (key, buckets, values), the smallest key of all.

    Documents are drawn by hashes, with weights that grow with their distance to the nearest centre so far.
    """
    out: dict = {}
    for g, n, bucket, value, h in shards:
        if g not in centres:
            continue
        key = -np.log(((mix(h + U64(turn)) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        if len(centres[g]):
            away = 1 - _products(n, bucket, value, centres[g]).max(axis=0) * 2.0**-SCALE
            key = np.where(away > 1e-6, key / np.maximum(away, 1e-6) ** AWAY, np.inf)
        i = int(np.argmin(key))
        if np.isfinite(key[i]):
            lo = int(n[:i].sum())
            found = (float(key[i]), bucket[lo : lo + n[i]].tobytes(), value[lo : lo + n[i]].tobytes())
            out[g] = min(out.get(g, found), found)
    return out


def _summed(shards, centres: dict) -> dict:
    """For each group the sum of the vectors nearest to each centre, and their number."""
    out: dict = {}
    for g, n, bucket, value, _ in shards:
        if g not in centres:
            continue
        k = len(centres[g])
        best = np.argmax(_products(n, bucket, value, centres[g]), axis=0)
        sums = np.bincount(np.repeat(best << BITS, n) + bucket, value, k << BITS).reshape(k, -1)
        counts = np.bincount(best, minlength=k)
        if g in out:
            out[g][0].__iadd__(sums)
            out[g][1].__iadd__(counts)
        else:
            out[g] = (sums, counts)
    return out


def _least(found: dict, part: dict) -> None:
    """Merges what _drawn gives for other vectors into found."""
    for g, x in part.items():
        found[g] = min(found.get(g, x), x)


def _added(total: dict, part: dict) -> None:
    """Adds what _summed or _having gives for other rows to total; sums are whole numbers, so their order is free."""
    for g, (a, b) in part.items():
        total[g] = (total[g][0] + a, total[g][1] + b) if g in total else (a, b)


def _clustered(groups: dict, k: int, run) -> dict:
    """The table of each group; groups: for each its idf, run: the merged result of a step over all vectors.

    Spherical k-means: the first centres are drawn far from each other, then rounds over all
    vectors follow until nothing changes. Topics are numbered from the largest. With fewer
    distinct texts than k there are fewer topics.
    """
    centres = {g: np.zeros((0, 1 << BITS)) for g in groups}
    live = set(groups)
    for turn in range(k):
        found = run(_drawn, _least, {g: centres[g] for g in live}, turn) if live else {}
        live = set(found)
        for g, (_, bucket, value) in found.items():
            one = np.zeros(1 << BITS)
            one[np.frombuffer(bucket, "<u2")] = np.frombuffer(value, "<i4") * 2.0**-SCALE
            centres[g] = np.vstack([centres[g], one])
    before: dict = {}
    sizes = {g: np.zeros(len(c), np.int64) for g, c in centres.items()}
    live = {g for g in groups if len(centres[g])}
    for _ in range(STEPS):
        total = run(_summed, _added, {g: centres[g] for g in live}) if live else {}
        for g, (sums, counts) in total.items():
            sizes[g] = counts
            if g in before and np.array_equal(before[g], sums):
                live.discard(g)
                continue
            before[g] = sums
            length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            centres[g] = np.where(counts[:, None] > 0, sums / np.maximum(length, 1.0), centres[g])
    empty = np.zeros((1 << BITS, 1), np.float32)
    return {g: (c[np.argsort(-sizes[g], kind="stable")] * groups[g]).T.astype(np.float32) if len(c) else empty for g, c in centres.items()}


def _idf(documents: int, having: np.ndarray) -> np.ndarray:
    return np.log((1 + documents) / (1 + having)) + 1e-3


def _needed(documents: int) -> float:
    """Documents with words that a language needs for a table of its own."""
    return max(OWN, OWN_SHARE * documents)


def train_topics(texts: list, langs: list, k: int = TOPICS, keys: list | None = None) -> Topics:
    """A table for each language with enough texts, and one of all texts for the others; keys: a hash of each document, by which first centres are drawn.

    The method of fit_topics() over lists. Texts without words play no part; without any, every text has topic 0.
    """
    n, bucket, count = vectors(texts)
    h = mix(np.arange(len(texts), dtype=U64)) if keys is None else np.array(keys, np.int64).view(U64)
    have = [x for x, c in zip(langs, n, strict=True) if c]
    names = [None, *sorted(x for x in set(have) - {None} if have.count(x) >= _needed(len(have)))]
    groups, shards = {}, []
    for g, lang in enumerate(names):
        own = (n > 0) & np.array([lang is None or x == lang for x in langs], bool)
        b, c, m = bucket[np.repeat(own, n)], count[np.repeat(own, n)], n[own]
        groups[g] = _idf(len(m), np.bincount(b, minlength=1 << BITS))
        if len(m):
            shards.append((g, m, b, _weighted(m, b, c, groups[g]), h[own]))
    tables = _clustered(groups, k, lambda step, _merge, *args: step(shards, *args))
    return Topics({lang: tables[g] for g, lang in enumerate(names)})


def train_table(texts: list, k: int = TOPICS) -> np.ndarray:
    """The table of all texts."""
    return train_topics(texts, [None] * len(texts), k).tables[None]


def _topics(n: np.ndarray, bucket: np.ndarray, count: np.ndarray, langs: list, model: Topics) -> list[str]:
    """The topic of each document among those of its language: the centre with the largest product; none without words."""
    out, names = np.full(len(n), "none", object), {lang: i for i, lang in enumerate(model.tables)}
    of = np.array([names.get(x, names[None]) for x in langs], np.int64)
    for lang, i in names.items():
        own = (n > 0) & (of == i)
        if own.any():
            at = np.repeat(own, n)
            best = np.argmax(_products(n[own], bucket[at], count[at], np.ascontiguousarray(model.tables[lang].T, np.float64)), axis=0)
            out[own] = [f"topic{j}" for j in best]
    return out.tolist()


def topics_of(texts: list, langs: list, model: Topics) -> list[str]:
    """The topic of each whole text; none for a text without words."""
    return _topics(*vectors(texts), langs, model)


def tokens_of(texts: list, path: str) -> list[int]:
    """Tokens of each whole text by the public vocabulary at path; none for a null text."""
    encoding, _ = _vocabulary(path)
    return [sum(map(len, encoded(encoding, t))) if t and t.isascii() else sum(map(len, encoded(encoding, (t or "").encode("utf-8", "replace").decode()))) for t in texts]


_VECTOR = ["h", "bucket", "count"]
_SHARDS = "g int, n binary, bucket binary, value binary, h binary"


def _entries(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(n, values): the arrays that the rows of a binary column hold, end to end."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, kind)
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data, size = column.buffers()[2], np.dtype(kind).itemsize
    lo, hi = int(at[0]), int(at[-1])
    return np.diff(at) // size, np.frombuffer(data, kind, (hi - lo) // size, lo) if hi > lo else np.zeros(0, kind)


def _binary(n: np.ndarray, values: np.ndarray) -> pa.Array:
    """The opposite: a binary column of runs of n values."""
    ends = np.concatenate([[0], np.cumsum(n)]) * values.dtype.itemsize
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())])
    return column.cast(pa.binary())


def _strings(column: pa.Array) -> list:
    return [None if x is None else str(x) for x in column.to_pylist()]


def _with_vectors(batches, at: int, names: list[str], path: str | None):
    """The batches with the columns tokens (if there is a path), bucket and count added."""
    for batch in batches:
        texts = batch.column(at).to_pylist()
        n, bucket, count = vectors(texts)
        tokens = [pa.array(tokens_of(texts, path), pa.int64())] if path else []
        yield pa.RecordBatch.from_arrays([*batch.columns, *tokens, _binary(n, bucket), _binary(n, count)], names=names)
        release()


def _having(batches, names: dict, shared: bool):
    """For each group a row of the documents with words, and of those with each bucket."""
    out = {g: [0, np.zeros(1 << BITS, np.int64)] for g in [0] * shared + list(names.values())}
    for batch in batches:
        n, bucket = _entries(batch.column(1), "<u2")
        of = np.array([names.get(x, -1) for x in _strings(batch.column(0))], np.int64)
        for g, total in out.items():
            own = (n > 0) & ((of == g) | (g == 0))
            total[0] += int(own.sum())
            total[1] += np.bincount(bucket[np.repeat(own, n)], minlength=1 << BITS)
    yield from _parts(out)


def _shards(batches, names: dict, groups: dict):
    """The weighted vectors of each group, about ENTRIES entries to a row."""
    for batch in batches:
        n, bucket = _entries(batch.column(2), "<u2")
        _, count = _entries(batch.column(3), "<u4")
        h = batch.column(1).to_numpy(zero_copy_only=False)
        of = np.array([names.get(x, -1) for x in _strings(batch.column(0))], np.int64)
        block = (np.cumsum(n) - n) // ENTRIES
        first = np.cumsum(n) - n
        for lo, hi in itertools.pairwise(np.flatnonzero(np.diff(block, prepend=-1, append=-1))):
            span = slice(int(first[lo]), int(first[hi - 1] + n[hi - 1]))
            for g, idf in groups.items():
                own = (n[lo:hi] > 0) & ((of[lo:hi] == g) | (g == 0))
                if not own.any():
                    continue
                at, m = np.repeat(own, n[lo:hi]), n[lo:hi][own]
                b = bucket[span][at]
                row = [m.astype("<i4").tobytes(), b.tobytes(), _weighted(m, b, count[span][at], idf).tobytes(), h[lo:hi][own].astype("<i8").tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], names=["g", "n", "bucket", "value", "h"])


def _read(batches):
    for batch in batches:
        for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n, bucket, value, h = (np.frombuffer(x, kind) for x, kind in zip(row, ("<i4", "<u2", "<i4", "<u8"), strict=True))
            yield g, n.astype(np.int64), bucket, value, h.astype(U64)


def _parts(found: dict):
    """A row for each group."""
    for g, x in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps({g: x})], pa.binary())], names=["part"])


def _stepped(batches, step, centres, *args):
    yield from _parts(step(_read(batches), centres.value, *args))
    release()


def _merged(batches, merge):
    out: dict = {}
    for batch in batches:
        for part in batch.column(0):
            merge(out, pickle.loads(part.as_py()))
    yield from _parts(out)
    release()


def _fitted(rows: DataFrame, k: int, shared: bool) -> Topics:
    """Topics from all rows (lang, h, bucket, count); with a table of all only if shared, or if a row needs it."""
    spark = rows.sparkSession
    by = cut(rows.where(F.octet_length("bucket") > 0).groupBy("lang").agg(F.count("*").alias("n")))
    total = by.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = by.where(F.col("lang").isNotNull() & (F.col("n") >= _needed(total))).orderBy("lang").collect()
    names = {r["lang"]: g for g, r in enumerate(own, 1)}
    shared = shared or total > sum(r["n"] for r in own)

    def collected(df: DataFrame, function, merge, slots: int, *args) -> dict:
        # merged in one task: the driver gets one part of each group, however many tasks there are
        tasks = max(1, min(spark.sparkContext.defaultParallelism, SUM_BYTES // (max(1, slots) * 8 << BITS)))
        parts = df.coalesce(tasks).mapInArrow(lambda it: function(it, *args), "part binary").repartition(1)
        out: dict = {}
        for part in parts.mapInArrow(lambda it: _merged(it, merge), "part binary").toArrow()["part"]:
            merge(out, pickle.loads(part.as_py()))
        return out

    n_groups = len(names) + shared
    having = collected(rows.select("lang", "bucket"), _having, _added, n_groups, names, shared)
    groups = {g: _idf(n, b) for g, (n, b) in having.items()}
    shards = cut(rows.select("lang", *_VECTOR).mapInArrow(lambda it: _shards(it, names, groups), _SHARDS))

    def run(step, merge, centres: dict, *args) -> dict:
        # destroyed after each pass, else copies stay everywhere until the driver happens to collect its garbage
        sent = spark.sparkContext.broadcast(centres)
        try:
            return collected(shards.where(F.col("g").isin(list(centres))), _stepped, merge, n_groups * k, step, sent, *args)
        finally:
            sent.destroy()
            give_back(spark)

    tables = _clustered(groups, k, run)
    return Topics({None: tables.get(0, np.zeros((1 << BITS, 1), np.float32)), **{lang: tables[g] for lang, g in names.items()}})


def fit_topics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", k: int = TOPICS) -> Topics:
    """Topics from all documents and their whole texts; first centres are drawn by a hash of id and text."""
    text = F.col(text_col)
    rows = df.select(text.alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), text).alias("h"))
    names = [*rows.columns, "bucket", "count"]
    rows = rows.mapInArrow(lambda it: _with_vectors(it, 0, names, None), "text string, lang string, h long, bucket binary, count binary")
    return _fitted(cut(rows.drop("text")), k, True)


def _described(batches, at: int, lang: int, names: list[str], path: str, model: Topics):
    """The batches with the columns topic and tokens added."""
    for batch in batches:
        texts = batch.column(at).to_pylist()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(topics_of(texts, _strings(batch.column(lang)), model), pa.string()), pa.array(tokens_of(texts, path), pa.int64())], names=names)
        release()


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def described(df: DataFrame, path: str, model: Topics | None, id_col: str, text_col: str, lang_col: str, keep: list[str]) -> tuple[DataFrame, str, str]:
    """The columns keep of df with two more, and their names: the topic and the number of tokens of the whole text.

    Without a model topics are fitted to df: vectors of all texts are written once, beside the
    columns kept, and read for every step.
    """
    topic, tokens, *vector = _fresh(df, "topic", "tokens", *_VECTOR)
    at, lang = df.columns.index(text_col), df.columns.index(lang_col)
    new = {topic: "string", tokens: "long"} if model else {tokens: "long", vector[1]: "binary", vector[2]: "binary"}
    if model is None:
        df = df.withColumn(vector[0], F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    names, kept = [*df.columns, *new], [F.col(f"`{c}`") for c in keep]
    schema = df.limit(0).withColumns({c: F.lit(None).cast(kind) for c, kind in new.items()}).schema
    if model:
        return cut(df.mapInArrow(lambda it: _described(it, at, lang, names, path, model), schema).select(*kept, topic, tokens)), topic, tokens
    rows = df.mapInArrow(lambda it: _with_vectors(it, at, names, path), schema)
    rows = cut(rows.select(*kept, tokens, *vector))
    fitted = _fitted(rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), *(F.col(c).alias(v) for c, v in zip(vector, _VECTOR, strict=True))), TOPICS, False)

    @F.arrow_udf("string")
    def found(langs: pa.Array, bucket: pa.Array, count: pa.Array) -> pa.Array:
        n, b = _entries(bucket, "<u2")
        return pa.array(_topics(n, b, _entries(count, "<u4")[1], _strings(langs), fitted), pa.string())

    return rows.withColumn(topic, found(F.col(f"`{lang_col}`").cast("string"), vector[1], vector[2])).select(*kept, topic, tokens), topic, tokens


# Raking ----------------------------------------------------------------------------------------
def needs(have: np.ndarray, share: np.ndarray, budget: float) -> np.ndarray:
    """Tokens wanted of each class: in proportion to share, none more than it has, budget in all.

    What a class lacks goes to the others in proportion; classes without tokens or share get none.
    """
    share = np.where(have > 0, share, 0.0)
    full = np.zeros(len(have), bool)
    while True:
        rest = share[~full].sum()
        unit = (budget - have[full].sum()) / rest if rest > 0 else 0.0
        over = ~full & (unit * share > have)
        if not over.any():
            return np.where(full, have, np.maximum(unit, 0.0) * share)
        full |= over


def rake(base: np.ndarray, keys: list[np.ndarray], wanted: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """(rates, worst miss): base * rate has the wanted totals on each marginal and no rate is over 1.

    base: tokens of each cell; keys: for each marginal the class of each cell; wanted: for each
    marginal the tokens of each class, with equal sums. The worst miss is that of the last round,
    relative to what is wanted; it stays large only where no such rates are.
    """
    total = base.sum()
    rate = np.full(len(base), min(1.0, wanted[0].sum() / total) if total > 0 and wanted else 1.0)
    worst = 0.0
    for _ in range(rounds):
        worst = 0.0
        for key, want in zip(keys, wanted, strict=True):
            have = np.bincount(key, base * rate, len(want))
            some = (have > 0) & (want > 0)
            worst = max(worst, np.abs(have[some] / want[some] - 1).max(initial=0.0))
            scale = np.where(have > 0, want / np.where(have > 0, have, 1.0), 0.0)
            rate = np.minimum(1.0, rate * scale[key])
        if worst < tolerance:
            break
    return rate, worst


def shares(names: list, have: np.ndarray, given: dict | None, alpha: float) -> np.ndarray:
    """Each class's share: the given one, else its part of what the given ones leave of 1."""
    power = np.where(have > 0, have, 0.0) ** alpha * (have > 0)
    if not given:
        return power
    named = np.array([x in given for x in names], bool)
    rest = power[~named].sum()
    left = max(0.0, 1.0 - sum(given.values())) / rest if rest > 0 else 0.0
    return np.where(have > 0, [given[x] if x in given else p * left for x, p in zip(names, power, strict=True)], 0.0)


def _raked_table(cells: DataFrame, dims: list[str], alpha: dict, targets: dict, budget: float, rounds: int, tolerance: float) -> tuple[DataFrame, float]:
    """The same as needs() and rake() over a distributed table of cells, for very many cells."""
    spark, schema = cells.sparkSession, cells.schema
    marginals = {}
    for d in dims:
        given = targets.get(d)
        m = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("have")).withColumn("share", F.when(F.col("have") > 0, F.pow("have", F.lit(alpha.get(d, 1.0)))).otherwise(0.0))
        if given:
            named = spark.createDataFrame([(k, float(v)) for k, v in given.items()], f"named {schema[d].dataType.simpleString()}, given double")
            m = cut(m.join(named, m[d].eqNullSafe(named["named"]), "left").drop("named"))
            rest = m.where("given is null").agg(F.sum("share")).first()[0]
            left = max(0.0, 1.0 - sum(given.values())) / rest if rest else 0.0
            m = m.withColumn("share", F.when(F.col("have") > 0, F.coalesce("given", F.col("share") * left)).otherwise(0.0))
        marginals[d] = cut(m.select(d, "have", "share", F.lit(False).alias("full")))
        budget = min(budget, marginals[d].where("share > 0").agg(F.sum("have")).first()[0] or 0.0)
    total = cells.agg(F.sum("tokens")).first()[0]
    out = cells.withColumn("rate", F.lit(min(1.0, budget / total) if total else 1.0))
    for d, m in marginals.items():
        while True:
            rest, filled = m.agg(F.sum(F.when(~F.col("full"), F.col("share"))), F.sum(F.when(F.col("full"), F.col("have")))).first()
            unit = (budget - (filled or 0.0)) / rest if rest else 0.0
            over = ~F.col("full") & (F.col("share") * unit > F.col("have"))
            if not m.where(over).limit(1).count():
                break
            m = cut(m.withColumn("full", F.col("full") | over))
        want = m.select(F.col(d).alias("k"), F.when(F.col("full"), F.col("have")).otherwise(F.col("share") * max(unit, 0.0)).alias(f"want_{d}"))
        out = out.join(want, out[d].eqNullSafe(want["k"]), "left").drop("k")
    out = cut(out)
    worst = 0.0
    for _ in range(rounds):
        worst = 0.0
        for d in dims:
            w = f"want_{d}"
            have = cut(out.groupBy(d, w).agg(F.sum(F.col("tokens") * F.col("rate")).alias("have")))
            miss = have.where((F.col("have") > 0) & (F.col(w) > 0)).agg(F.max(F.abs(F.col("have") / F.col(w) - 1))).first()[0]
            worst = max(worst, miss or 0.0)
            scale = have.select(F.col(d).alias("k"), F.when(F.col("have") > 0, F.col(w) / F.col("have")).otherwise(0.0).alias("scale"))
            out = out.join(scale, out[d].eqNullSafe(scale["k"]), "left").withColumn("rate", F.least(F.lit(1.0), F.col("rate") * F.col("scale"))).drop("k", "scale")
        out = cut(out)
        if worst < tolerance:
            break
    return out.select(*dims, "tokens", "rate"), worst


def cell_rates(
    df: DataFrame, dims: list[str], *, alpha: dict | None = None, targets: dict | None = None, budget: float | None = None, share: float = SHARE, driver_cells: int = DRIVER_CELLS, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """(dims, tokens, rate): the probability of each cell's documents.

    df: rows with the columns dims and tokens. targets: for a marginal, a dict of shares by
    class; what they leave of 1 goes to the classes not named, in proportion to tokens ** alpha,
    and without a dict all shares are so. budget: tokens to draw in the mean, all at most; by
    default the given share of all tokens. A class that lacks tokens for its share gives all, and
    the others take up the rest. Cells without tokens have the rate 1. Where the marginals
    contradict each other the rates of the last round are given, with a warning of the miss.
    """
    alpha, targets = ALPHA if alpha is None else alpha, targets or {}
    cells = cut(df.groupBy(*dims).agg(F.sum("tokens").alias("tokens")))
    n, total = cells.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    aim = min(float(total), share * total if budget is None else float(budget))
    if n > driver_cells:
        out, worst = _raked_table(cells, dims, alpha, targets, aim, rounds, tolerance)
        out = out.withColumn("rate", F.when(F.col("tokens") > 0, F.col("rate")).otherwise(1.0))
    else:
        rows = sorted(cells.collect(), key=lambda r: tuple((r[d] is not None, str(r[d])) for d in dims))
        tokens = np.array([r["tokens"] for r in rows], np.float64)
        keys, parts = [], []
        for d in dims:
            names = list(dict.fromkeys(r[d] for r in rows))
            place = {x: i for i, x in enumerate(names)}
            key = np.array([place[r[d]] for r in rows], np.int64)
            have = np.bincount(key, tokens, len(names)) if rows else np.zeros(0)
            keys.append(key)
            parts.append((have, shares(names, have, targets.get(d), alpha.get(d, 1.0))))
        aim = min([aim, *(have[part > 0].sum() for have, part in parts)])
        rate, worst = rake(tokens, keys, [needs(have, part, aim) for have, part in parts], rounds, tolerance) if rows else (tokens, 0.0)
        rate = np.where(tokens > 0, rate, 1.0)
        schema = ", ".join(f"{d} {df.schema[d].dataType.simpleString()}" for d in dims) + ", tokens long, rate double"
        out = df.sparkSession.createDataFrame([(*(r[d] for d in dims), r["tokens"], float(p)) for r, p in zip(rows, rate, strict=True)], schema)
    if worst > max(tolerance, 1e-6):
        warnings.warn(f"raking has not settled: a marginal is {worst:.2%} off its target", stacklevel=2)
    return out


def draw(id_col: str, seed: int) -> Column:
    """A number from 0 to 1, uniform over ids and the same on every run."""
    h = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.shiftrightunsigned(h, 11).cast("double") * 2.0**-53


_DIMS = ["source", "lang", "topic"]


def _with_rates(rows: DataFrame, names: list[str], tokens: str, rate: str, driver_cells: int, **how) -> DataFrame:
    """rows with the rate of their cell; names: their columns of source, language and topic."""
    cells = rows.select(*(F.col(f"`{c}`").alias(d) for c, d in zip(names, _DIMS, strict=True)), F.col(f"`{tokens}`").alias("tokens"))
    rates = cell_rates(cells, _DIMS, driver_cells=driver_cells, **how)
    rates = rates.select(F.struct(*_DIMS).alias("cell"), F.col("rate").alias("r"))
    all_rows = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.struct(*(F.col(f"`{c}`").alias(d) for c, d in zip(names, _DIMS, strict=True))).alias("cell"))
    # at most driver_cells rates are sent to every task; a larger table is shuffled
    small = rates.count() <= driver_cells
    return all_rows.join(F.broadcast(rates) if small else rates, "cell").select("row.*", F.col("r").alias(rate))


def mixed(
    df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topics: Topics | None = None, alpha: dict | None = None, targets: dict | None = None,
    budget: float | None = None, share: float = SHARE, seed: int = 17, driver_cells: int = DRIVER_CELLS, rounds: int = ROUNDS,
) -> DataFrame:
    """(id_col, source, lang, topic, tokens, rate, kept) for each row of df.

    path: a public vocabulary in rank form, by which tokens are counted; topics: by default fitted
    to df. targets, alpha, budget and share as in cell_rates. Null sources and languages are
    classes of their own. Documents without tokens weigh nothing and have the rate 1. Rows that
    repeat an id are drawn alike; a null id is drawn as an empty one. Ids must be integers. Other
    columns play no part. An empty table gives an empty one.
    """
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows, topic, tokens = described(rows, path, topics, "id", "text", "lang", ["id", "source", "lang"])
    rows = cut(rows) if topics is None else rows
    out = _with_rates(rows, ["source", "lang", topic], tokens, "rate", driver_cells, alpha=alpha, targets=targets, budget=budget, share=share, rounds=rounds)
    return out.withColumn("kept", draw("id", seed) < F.col("rate")).withColumnRenamed("id", id_col)


def sample(
    df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topics: Topics | None = None, alpha: dict | None = None, targets: dict | None = None,
    budget: float | None = None, share: float = SHARE, seed: int = 17, driver_cells: int = DRIVER_CELLS, rounds: int = ROUNDS,
) -> DataFrame:
    """The rows of df, columns unchanged, that mixed() draws; without a shuffle of the texts.

    Rows are judged as in mixed(); columns of any name are kept as they are.
    """
    integer_id(df, id_col)
    rows, topic, tokens = described(df, path, topics, id_col, text_col, lang_col, df.columns)
    rate = _fresh(rows, "rate")[0]
    out = _with_rates(rows, [source_col, lang_col, topic], tokens, rate, driver_cells, alpha=alpha, targets=targets, budget=budget, share=share, rounds=rounds)
    return out.where(draw(id_col, seed) < F.col(rate)).select(*(F.col(f"`{c}`") for c in df.columns))
