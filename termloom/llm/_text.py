"""Vectorised text primitives over one byte buffer: words, shingles and n-gram hashes.

A word is a maximal run of ASCII letters, digits, underscores and non-ASCII characters,
in lower case; a run of more than LONGEST_WORD bytes is cut into words of that many. Texts are
joined with a line break, so no word or n-gram spans two texts. A long text is read in
overlapping runs of words, so its memory is a few bytes for each of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
#: Bytes of tokens between white space.
VISIBLE = np.ones(256, bool)
VISIBLE[[*range(9, 14), 32]] = False
#: Bytes after which a run of letters is cut.
LONGEST_WORD = 1024
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift and multiply)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _power(n: int, inverse: bool) -> np.ndarray:
    key = "inverse" if inverse else "power"
    if len(_powers.get(key, ())) < n:
        step = np.full(max(n, 1 << 16), pow(_BASE, -1, 1 << 64) if inverse else _BASE, U64)
        step[0] = 1
        _powers[key] = np.cumprod(step)
    return _powers[key][:n]


def release() -> None:
    """Give freed memory back to the system: a worker lives on for other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def chunks(texts: list, limit: int = 1 << 19, most: int = 1 << 14) -> Iterator[tuple[int, int]]:
    """Ranges of at most most texts with about limit characters; a longer text has a range of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i - at >= most or (size and size + n > limit):
            yield at, i
            at, size = i, 0
        size += n + 1
    if len(texts) > at:
        yield at, len(texts)


def folded(text: str | None, lower: bool = True) -> bytes:
    """The bytes that are cut into words; nothing for a null text."""
    return ((text.lower() if lower else text) if text else "").encode("utf-8", "surrogatepass")


class Words:
    """The words of some texts: start, end (byte places), doc (index of the text) and hash."""

    def __init__(self, texts: list, lower: bool = True, inside: np.ndarray | None = None) -> None:
        raw = [t if isinstance(t, bytes) else folded(t, lower) for t in texts]
        self.n_docs = len(raw)
        self.buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        self.doc_end = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
        table = _WORD if inside is None else inside
        self.cuts = np.zeros(0, np.int64)
        self.start, self.end = self._edges(table)
        size = self.end - self.start
        if len(size) and size.max() > LONGEST_WORD:
            # a line break after each part of a long run, which neither words nor texts hold
            more = (size - 1) // LONGEST_WORD
            part = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
            cuts = np.repeat(self.start, more) + part * LONGEST_WORD
            self.doc_end = self.doc_end + np.searchsorted(cuts, self.doc_end)
            self.buf = np.insert(self.buf, cuts, 10)
            self.cuts = cuts + np.arange(len(cuts))
            self.start, self.end = self._edges(table)
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")
        n = len(self.buf)
        sums = np.zeros(n + 1, U64)
        np.cumsum((self.buf.astype(U64) + U64(1)) * _power(n, False), out=sums[1:])
        self.sums = sums
        self.hash = self.spans(self.start, self.end)

    def place(self, k: int) -> int:
        """Where word k starts in the bytes of the texts as they were given."""
        return int(self.start[k] - np.searchsorted(self.cuts, self.start[k]))

    def _edges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        within = np.zeros(len(self.buf) + 2, np.int8)
        within[1:-1] = inside[self.buf]
        edge = np.diff(within)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans; the same bytes have the same hash wherever they stand."""
        h = (self.sums[end] - self.sums[start]) * _power(len(self.buf), True)[start]
        return mix(h + (end - start).astype(U64) * _MUL)

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def _segments(raw: bytes, inside: np.ndarray, size: int, overlap: int) -> Iterator[Words]:
    """Runs of the words of one text; each but the first starts with the last overlap words of the run before."""
    buf = np.frombuffer(raw, np.uint8)
    mask = inside[buf]
    keep = mask.copy()
    keep[1:] |= mask[:-1]
    raw = np.where(mask[keep], buf[keep], np.uint8(10)).tobytes().rstrip(b"\n")
    del buf, mask, keep
    at, back, n = 0, 0, len(raw)
    while at < n:
        end = n if at + size >= n else raw.rfind(b"\n", at, at + size) + 1 or at + size // LONGEST_WORD * LONGEST_WORD
        words = Words([raw[back:end]], inside=inside)
        yield words
        at, back = end, back + words.place(max(0, len(words.start) - overlap)) if overlap else end


def runs(texts: list, *, lower: bool = True, inside: np.ndarray | None = None, overlap: int = 0, limit: int = 1 << 19, most: int = 1 << 14) -> Iterator[tuple[int, int, int, Words]]:
    """(lo, hi, part, words) over texts[lo:hi]; a text far over limit comes in several parts, 0, 1, ...

    Part k > 0 starts with the last overlap words of the part before it; every part has more
    words than that.
    """
    table = _WORD if inside is None else inside
    for lo, hi in chunks(texts, limit, most):
        raw = [folded(t, lower) for t in texts[lo:hi]]
        if hi - lo == 1 and len(raw[0]) > 4 * limit:
            for part, words in enumerate(_segments(raw[0], table, 4 * limit, overlap)):
                yield lo, hi, part, words
        else:
            yield lo, hi, 0, Words(raw, inside=table)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of width words of one text, repeats included.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    n, h, doc = len(words.hash), words.hash, words.doc
    counts = words.counts()
    first = np.cumsum(counts) - counts
    out = np.zeros(max(0, n - width + 1), U64)
    for k in range(width):
        out = mix(out + h[k : n - width + 1 + k]) if len(out) else out
    whole = doc[: len(out)] == doc[width - 1 :] if len(out) else np.zeros(0, bool)
    docs, hashes = doc[: len(out)][whole], out[whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        acc = np.zeros(len(short), U64)
        for k in range(width - 1):
            live = counts[short] > k
            acc[live] = mix(acc[live] + h[first[short[live]] + k])
        docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, mix(acc + counts[short].astype(U64))])
    return docs, hashes


def distinct(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, hash, count) of the distinct pairs, ordered by doc and hash."""
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return docs[at], hashes[at], np.diff(np.append(at, len(docs)))


def merged(docs: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same pairs once each, their counts added."""
    order = np.lexsort((hashes, docs))
    docs, hashes, counts = docs[order], hashes[order], counts[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return docs[at], hashes[at], np.add.reduceat(counts, at) if len(at) else counts


def shingle_counts(texts: list, width: int, most: int = 1 << 14) -> Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(lo, hi, (doc - lo, hash, count)) of the distinct shingles of texts[lo:hi], each text in one item."""
    held: tuple | None = None
    for lo, hi, part, words in runs(texts, overlap=width - 1, most=most):
        if held and not part:
            yield held
            held = None
        found = distinct(*shingles(words, width))
        held = (lo, hi, found if held is None else merged(*(np.concatenate(p) for p in zip(held[2], found, strict=True))))
    if held:
        yield held
