"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of its character n-grams (hashed, with marks for
the word's ends) and of the whole word, so an unseen misspelling shares the vectors of the
spellings it resembles. A window's vector is the mean of its words' vectors, and a document's
vector is the weighted mean of its windows' vectors, which a two-class softmax scores. A window's
weight grows exponentially with its own score, so a few words weigh the same in a short and in a
very long text (with equal weights a thousand clean words hide them). Training and scoring use
the same mean, and embeddings and softmax weights are learnt together. As all steps but the
weights are linear, scoring needs one number for each n-gram bucket.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut, first_by_hash, integer_id
from ._text import U64, Words, _power, chunks, release, runs

SIZES = (3, 4, 5)
BITS = 17
WINDOW = 2
#: The most labelled documents of each class, and the longest text, that training takes.
SAMPLE, LONGEST = 1000, 65536
THRESHOLD = 0.7


@dataclass
class Model:
    """bucket: the class difference of each n-gram bucket's embedding; bias: that of the softmax."""

    bucket: np.ndarray
    bias: float
    embeddings: np.ndarray | None = None
    weights: np.ndarray | None = None


def _hash_at(words: Words, n: int) -> np.ndarray:
    """Bucket of the n-gram at every byte place."""
    at = np.arange(len(words.buf) - n + 1)
    return (words.spans(at, at + n) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _marked(texts: list | Words) -> Words:
    words = texts if isinstance(texts, Words) else Words(texts)
    gaps = np.ones(len(words.buf) + 1, np.int64)
    np.add.at(gaps, words.start, -1)
    inside = np.zeros(len(words.buf) + 1, np.int64)
    inside[words.start] += 1
    inside[words.end] -= 1
    buf = np.where(np.cumsum(inside)[:-1] > 0, words.buf, 32).astype(np.uint8)
    out = object.__new__(Words)
    out.__dict__ |= words.__dict__
    pad = np.concatenate([[32], buf, np.full(max(SIZES), 32)]).astype(np.uint8)
    out.buf, out.start, out.end = pad, words.start + 1, words.end + 1
    out.sums = np.zeros(len(pad) + 1, U64)
    np.cumsum((pad.astype(U64) + U64(1)) * _power(len(pad), False), out=out.sums[1:])
    return out


def word_logits(words: Words, bucket: np.ndarray) -> np.ndarray:
    """The mean of the bucket values of each word's n-grams and of the word itself."""
    whole = (words.hash & np.uint64((1 << BITS) - 1)).astype(np.int64)
    total, count = bucket[whole].astype(np.float64), np.ones(len(whole))
    for n in SIZES:
        value = np.zeros(len(words.buf) + 2)
        np.cumsum(bucket[_hash_at(words, n)], dtype=np.float64, out=value[1 : len(words.buf) - n + 2])
        lo, hi = words.start - 1, np.maximum(words.end + 1 - n + 1, words.start - 1)
        total += value[hi] - value[lo]
        count += hi - lo
    return total / count


def _grams(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, number of buckets of each) of the chosen words' n-grams, word after word; for training."""
    start, end = words.start[chosen], words.end[chosen]
    ids = [np.arange(len(chosen))]
    buckets = [(words.hash[chosen] & np.uint64((1 << BITS) - 1)).astype(np.int64)]
    for n in SIZES:
        at = _hash_at(words, n)
        k = np.maximum(end + 1 - n + 1 - (start - 1), 0)
        word = np.repeat(np.arange(len(chosen)), k)
        ids.append(word)
        buckets.append(at[np.arange(len(word)) - np.repeat(np.cumsum(k) - k, k) + start[word] - 1])
    word = np.concatenate(ids)
    order = np.argsort(word, kind="stable")
    return np.concatenate(buckets)[order], np.bincount(word, minlength=len(chosen))


def _vocabulary(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc and word of every token, buckets and their number of every distinct word), in bounded chunks of text."""
    docs, hashes, gram, per = [], [], [], []
    seen = np.zeros(0, np.uint64)
    first: list[np.ndarray] = []
    for lo, hi in chunks(texts):
        words = _marked(texts[lo:hi])
        docs.append(words.doc + lo)
        hashes.append(words.hash)
        new, at = np.unique(words.hash, return_index=True)
        fresh = ~np.isin(new, seen, assume_unique=True)
        g, k = _grams(words, at[fresh])
        gram.append(g.astype(np.int32))
        per.append(k)
        first.append(new[fresh])
        seen = np.union1d(seen, new[fresh])
    names = np.concatenate(first)
    order = np.argsort(names)
    word = order[np.searchsorted(names[order], np.concatenate(hashes))]
    return np.concatenate(docs), word.astype(np.int64), np.concatenate(gram).astype(np.int64), np.concatenate(per)


def _windows(doc: np.ndarray, n_docs: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first word, end word) of every window; a short document has one."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count) - count
    k = np.where(count > 0, np.maximum(count - window + 1, 1), 0)
    d = np.repeat(np.arange(n_docs), k)
    lo = np.arange(len(d)) - np.repeat(np.cumsum(k) - k, k) + first[d]
    return d, lo, np.minimum(lo + window, first[d] + count[d])


class Mean:
    """The mean of documents' windows, weighted by exp(score), fed run by run."""

    def __init__(self, n: int) -> None:
        self.top, self.weight, self.total = np.full(n, -np.inf), np.zeros(n), np.zeros(n)

    def add(self, d: np.ndarray, z: np.ndarray) -> None:
        """Windows of the documents d with the scores z."""
        if not len(d):
            return
        top = self.top.copy()
        np.maximum.at(top, d, z)
        seen = np.isfinite(self.top)
        shrink = np.zeros(len(top))
        shrink[seen] = np.exp(self.top[seen] - top[seen])
        e = np.exp(z - top[d])
        n = len(top)
        self.weight = self.weight * shrink + np.bincount(d, e, n)
        self.total = self.total * shrink + np.bincount(d, e * z, n)
        self.top = top

    def logits(self, bias: float) -> np.ndarray:
        """The softmax's logits; the bias alone for a document without words."""
        return self.total / np.where(self.weight > 0, self.weight, 1.0) + bias


def window_scores(logits: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(doc, score) of every window of words."""
    d, lo, hi = _windows(doc, n_docs, window)
    sums = np.concatenate([[0.0], np.cumsum(logits)])
    return d, (sums[hi] - sums[lo]) / np.maximum(hi - lo, 1)


def train(texts: list, toxic: np.ndarray, *, dim: int = 8, epochs: int = 80, window: int = WINDOW, rate: float = 0.08, decay: float = 1e-6, seed: int = 7) -> Model:
    """Fit embeddings and softmax weights to whole texts. One class only, or no text: a constant score."""
    y = np.asarray(toxic, np.float64)
    n = len(texts)
    if not n or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), 0.0 if not n else (-4.0, 4.0)[int(y[0])])
    doc, word, gram, per = _vocabulary(texts)
    if not len(word):
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    starts = np.cumsum(per) - per
    d, lo, hi = _windows(doc, n, window)
    width = (hi - lo).astype(np.float64)
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (1 << BITS, dim))
    w = rng.normal(0, 0.5, (dim, 2))
    bias = 0.0
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    m = [np.zeros_like(e), np.zeros_like(w), 0.0]
    v = [np.zeros_like(e), np.zeros_like(w), 0.0]
    for step in range(1, epochs + 1):
        delta = w[:, 1] - w[:, 0]
        z_word = np.add.reduceat((e @ delta)[gram], starts) / per
        sums = np.concatenate([[0.0], np.cumsum(z_word[word])])
        z = (sums[hi] - sums[lo]) / width
        top = np.full(n, -np.inf)
        np.maximum.at(top, d, z)
        share = np.exp(z - top[d])
        share /= np.bincount(d, share, n)[d]
        mean = np.bincount(d, share * z, n)
        g = weight * (1 / (1 + np.exp(-np.clip(mean + bias, -40, 40))) - y)
        g_win = g[d] * share * (1 + z - mean[d]) / width
        edge = np.bincount(lo, g_win, len(word) + 1) - np.bincount(hi, g_win, len(word) + 1)
        g_word = np.bincount(word, np.cumsum(edge)[:-1], len(per)) / per
        g_bucket = np.bincount(gram, np.repeat(g_word, per), 1 << BITS)
        grad_w = e.T @ g_bucket
        grads = [np.outer(g_bucket, delta) + decay * e, np.stack([-grad_w, grad_w], 1) + decay * w, g.sum()]
        params = [e, w, bias]
        for i in range(3):
            m[i] = 0.9 * m[i] + 0.1 * grads[i]
            v[i] = 0.99 * v[i] + 0.01 * grads[i] ** 2
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
        e, w, bias = params
    return Model((e @ (w[:, 1] - w[:, 0])).astype(np.float32), float(bias), e, w)


def score(texts: list, model: Model) -> np.ndarray:
    """Scores of whole texts; a long text is read in runs of words that overlap by a window."""
    mean = Mean(len(texts))
    for lo, hi, part, run in runs(texts, overlap=WINDOW - 1):
        words = _marked(run)
        d, z = window_scores(word_logits(words, model.bucket), words.doc, hi - lo)
        mean.add(d + lo, z)
    return 1 / (1 + np.exp(-np.clip(mean.logits(model.bias), -40, 40)))


def held_out(col) -> F.Column:
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_rows(df: DataFrame, labels: DataFrame, label: str, classes: list, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most per_class documents of each class outside the held-out third, with whole texts.

    The documents are those first in the order of a hash of their id, among the labelled ones
    whose text is there: labels without a document, null texts, texts over LONGEST characters and
    null labels are left out before the sample is cut. A document with several labels has the
    largest; of several texts, the largest in their order.
    """
    own, text = integer_id(df, id_col), F.col(text_col)
    fits = text.isNotNull() & (F.length(text) <= LONGEST)
    named = labels.select(integer_id(labels, id_col).alias("id"), F.col(label).alias("label")).where(F.col("label").isin(classes) & F.col("id").isNotNull())
    named = named.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    usable = named.join(df.where(fits).select(own.alias("id")).distinct(), "id", "left_semi")
    usable = cut(usable.select("id", "label", F.xxhash64(F.col("id").cast("string")).alias("h")))
    picked = [r for c in classes for r in first_by_hash(usable.where(F.col("label") == c), "h", per_class, "id")]
    chosen = df.sparkSession.createDataFrame([(r["id"], r["label"]) for r in picked], usable.select("id", "label").schema)
    # at most per_class rows of each class are broadcast
    return df.where(fits).select(own.alias("id"), text.alias("text")).join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("text").alias("text"), F.max("label").alias("label"))


def _by_id(rows: list[tuple]) -> tuple[list, np.ndarray]:
    rows = sorted(rows, key=lambda r: r[0])
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.float64)


def labelled_sample(df: DataFrame, labels: DataFrame, label: str, classes: list, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list, np.ndarray]:
    """The texts and labels of labelled_rows(), in the order of their ids."""
    return _by_id(labelled_rows(df, labels, label, classes, per_class, id_col, text_col).collect())


def trained(rows: DataFrame, train: Callable, *args) -> object:
    """What train(texts, labels, *args) makes of rows (id, text, label), in one task: texts and training don't reach the driver."""

    def model(batches):
        found = train(*_by_id([r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]), *args)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["model"])
        release()

    found = rows.select("id", "text", "label").repartition(1).mapInArrow(model, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([], np.zeros(0), *args)


def fit(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE) -> Model:
    """A model from a bounded sample of the labelled documents outside the held-out third."""
    return trained(labelled_rows(df, labels, "toxic", [0, 1], per_class, id_col, text_col), train)


def _scored(batches, model: Model):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1).to_pylist(), model))], names=["id", "score"])
        release()


def toxicity(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for each row, over whole texts, without a shuffle.

    A null or empty text, or one without words, has the score of the softmax's bias. Null and
    repeated ids are passed through row by row; ids must be integers; other columns play no part.
    """
    small = Model(model.bucket, model.bias)
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _scored(it, small), "id long, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_clean(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of df, columns unchanged, whose score is under threshold; rows are judged one by one."""
    small = Model(model.bucket, model.bias)
    at = df.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at).to_pylist(), small) < threshold))
            release()

    return df.mapInArrow(keep, df.schema)
