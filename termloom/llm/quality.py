"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
scale into grades: P(grade <= k) = logistic(threshold_k - f(text)). That gives an expected grade
and tail probabilities P(grade >= k), by which documents are selected.

Features of a text are the means, over its tokens (parts between white space), of indicators of
the token, its shape (case, digits and punctuation, runs collapsed), the pair of neighbouring
shapes, and whether it repeats the token before it or an earlier token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import integer_id
from ._text import U64, VISIBLE, Words, _power, chunks, mix, release, runs
from .toxicity import held_out, labelled_rows, trained

BITS = 16
#: The most labelled documents of each grade that training takes.
SAMPLE = 1500
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = 65
_SHAPE[97:123] = 97
_SHAPE[48:58] = 57
_SHAPE[128:] = 97
_KINDS = 5
_MASK = U64((1 << BITS) - 1)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list


def features(texts: list | Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc of each token, buckets (tokens x kinds), tokens of each doc)."""
    words = texts if isinstance(texts, Words) else Words(texts, lower=False, inside=VISIBLE)
    shape = _SHAPE[words.buf]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[words.start] = True
    place = np.cumsum(keep) - keep
    end = np.append(place, keep.sum())[words.end]
    short = object.__new__(Words)
    short.buf = shape[keep]
    short.sums = np.zeros(len(short.buf) + 1, U64)
    np.cumsum((short.buf.astype(U64) + U64(1)) * _power(len(short.buf), False), out=short.sums[1:])
    form = short.spans(place[words.start], end)
    n = len(form)
    same_doc = np.zeros(n, bool)
    same_doc[1:] = words.doc[1:] == words.doc[:-1]
    before = np.where(same_doc, np.concatenate([form[:1], form[:-1]]), U64(0)) if n else form
    twice = np.zeros(n, bool)
    twice[1:] = same_doc[1:] & (words.hash[1:] == words.hash[:-1])
    order = np.lexsort((words.hash, words.doc))
    again = np.zeros(n, bool)
    if n:
        h, d = words.hash[order], words.doc[order]
        again[order[1:]] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    cols = [words.hash, mix(form + U64(1)), mix(mix(before + U64(2)) + form), mix(twice.astype(U64) + U64(3)), _again(again)]
    return words.doc, np.stack([(c & _MASK).astype(np.int64) for c in cols], 1), words.counts()


def _again(seen: np.ndarray) -> np.ndarray:
    """The hash of whether a token repeats an earlier one of its document."""
    return mix(seen.astype(U64) + U64(7))


def scales(texts: list, weights: np.ndarray) -> np.ndarray:
    """f of whole texts: the mean weight of their tokens' features, 0 without tokens.

    A long text is read in runs that overlap by one token; the tokens seen so far are kept as a
    set of hashes, so its value is that of the text in one piece.
    """
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    seen = np.zeros(0, U64)
    for lo, hi, part, words in runs(texts, lower=False, inside=VISIBLE, overlap=1):
        doc, buckets, _ = features(words)
        if part or hi - lo == 1:
            seen = seen if part else seen[:0]
            buckets[:, _KINDS - 1] = np.where(np.isin(words.hash, seen), int(_again(np.ones(1, bool))[0] & _MASK), buckets[:, _KINDS - 1])
            seen = np.union1d(seen, words.hash)
        if part:
            doc, buckets = doc[1:], buckets[1:]
        total[lo:hi] += np.bincount(doc, weights[buckets].sum(1), hi - lo)
        count[lo:hi] += np.bincount(doc, minlength=hi - lo)
    return total / np.maximum(count, 1)


def _cumulative(f: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k) for k = -1 ... K-1: columns from 0 to 1."""
    inner = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - f[:, None], -40, 40)))
    return np.concatenate([np.zeros((len(f), 1)), inner, np.ones((len(f), 1))], 1)


def train(texts: list, grade: np.ndarray, grades: list, *, epochs: int = 150, rate: float = 0.05, decay: float = 1e-5) -> Model:
    """Fit weights and ordered thresholds to whole texts by maximum likelihood, classes weighted alike.

    Thresholds are kept in order as a first value and positive steps. Without texts, or with one
    grade only, the weights are zero and the thresholds give that grade (the highest if none).
    """
    k = len(grades)
    y = np.searchsorted(np.array(grades, np.float64), np.asarray(grade, np.float64))
    n = len(texts)
    if not n or len(set(y.tolist())) < 2 or k < 2:
        at = int(y[0]) if n else k - 1
        return Model(np.zeros(1 << BITS), np.where(np.arange(k - 1) < at, -6.0, 6.0) + np.arange(k - 1) * 1e-6, list(grades))
    parts, base = [], 0
    for lo, hi in chunks(texts):
        d, b, c = features(texts[lo:hi])
        parts.append((d + base, b, c))
        base += hi - lo
    doc, buckets, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    # distinct (doc, bucket) with its share of the document's tokens
    key, times = np.unique(np.repeat(doc, _KINDS) << BITS | buckets.ravel(), return_counts=True)
    row, col = key >> BITS, key & ((1 << BITS) - 1)
    value = times / np.maximum(count, 1)[row]
    weight = (1 / np.bincount(y, minlength=k).clip(1))[y] / k
    w, first, steps = np.zeros(1 << BITS), -0.5 * (k - 2), np.zeros(max(k - 2, 0))
    m, v = None, None
    for step in range(1, epochs + 1):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(steps)))])
        f = np.bincount(row, w[col] * value, n)
        p = _cumulative(f, thresholds)
        hi, lo = p[np.arange(n), y + 1], p[np.arange(n), y]
        mass = np.maximum(hi - lo, 1e-12)
        slope_hi, slope_lo = hi * (1 - hi), lo * (1 - lo)
        g_f = weight * (slope_hi - slope_lo) / mass
        g_t = np.zeros(k + 1)
        np.add.at(g_t, y + 1, -weight * slope_hi / mass)
        np.add.at(g_t, y, weight * slope_lo / mass)
        g_t = g_t[1:-1]
        g_steps = np.array([g_t[i + 1 :].sum() for i in range(k - 2)]) / (1 + np.exp(-steps)) if k > 2 else steps
        grad = np.concatenate([np.bincount(col, g_f[row] * value, 1 << BITS) + decay * w, [g_t.sum()], g_steps])
        m = 0.1 * grad if m is None else 0.9 * m + 0.1 * grad
        v = 0.01 * grad**2 if v is None else 0.99 * v + 0.01 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, first, steps = w - move[: 1 << BITS], first - move[1 << BITS], steps - move[(1 << BITS) + 1 :]
    thresholds = first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(steps)))])
    return Model(w, thresholds, list(grades))


def predict(texts: list, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, P(grade >= k) for k = 1 ... K-1) of whole texts; a text without tokens has f = 0."""
    f = scales(texts, model.weights)
    p = _cumulative(f, model.thresholds)
    return np.diff(p, axis=1) @ np.array(model.grades, np.float64), 1 - p[:, 1:-1]


def fit(df: DataFrame, labels: DataFrame, *, grade: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_grade: int = SAMPLE, most_grades: int = 20) -> Model:
    """A model from a bounded sample of each grade's documents outside the held-out third."""
    found = sorted(r[0] for r in labels.where(F.col(grade).isNotNull()).select(grade).distinct().limit(most_grades + 1).collect())
    if len(found) > most_grades:
        raise ValueError(f"{grade} has more than {most_grades} grades")
    grades = found or [0, 1]
    return trained(labelled_rows(df, labels, grade, grades, per_grade, id_col, text_col), train, grades)


def _scored(batches, model: Model, cut: int):
    for batch in batches:
        expected, tails = predict(batch.column(1).to_pylist(), model)
        tail = tails[:, cut] if tails.shape[1] else np.ones(len(expected))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected), pa.array(tail)], names=["id", "expected_grade", "tail"])
        release()


def quality(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", least: float | None = None, tail: float = 0.5) -> DataFrame:
    """(id_col, held_out, expected_grade, tail, kept) for each row, over whole texts, without a shuffle.

    tail: P(grade >= least), least being the highest grade where not given; kept: tail is at
    least the given probability. Null and empty texts are judged by the thresholds alone. Null
    and repeated ids are passed through row by row; ids must be integers; other columns play no
    part.
    """
    cut = max(0, (len(model.grades) - 1 if least is None else model.grades.index(least)) - 1)
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda it: _scored(it, model, cut), "id long, expected_grade double, tail double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "expected_grade", "tail", (F.col("tail") >= tail).alias("kept"))


def filter_kept(df: DataFrame, model: Model, *, text_col: str = "text", tail: float = 0.5) -> DataFrame:
    """The rows of df, columns unchanged, whose probability of the highest grade is at least tail."""
    at = df.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            _, tails = predict(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array(tails[:, -1] >= tail) if tails.shape[1] else pa.array([True] * batch.num_rows))
            release()

    return df.mapInArrow(keep, df.schema)
