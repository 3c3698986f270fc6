"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

Symbols stream in one by one. For every end position the transducer knows the last token of the
encoding of the text up to there: it is the one token that ends there and that stays next to the
last token at its own start (Merges.beside: undoing both tokens' merges in reverse order, no
merge across the border would have come first). The ends that a later token can start at are
those inside a path of the token trie; a token is emitted once the encodings at all of them share
it. How long that can take is a constant of the merge list (Merges.lookahead), so a word of any
length needs constant memory. Decoding is the inverse state machine: ids in, text out, holding
back no more than the bytes of an unfinished character.

The tokenizer file is a JSON of the public `tokenizers` format with a BPE model, an end-of-word
suffix, NFC + lower case, and a split into contractions, letters, single digits and other runs.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import integer_id

_SHIFT = 20
_MASK = (1 << _SHIFT) - 1
_NEVER = 1 << 62
#: Symbols after which a word's transducer looks for tokens to emit; the longest cached word; cached words; cached borders.
BLOCK, CACHED, CACHE, BORDERS = 64, 64, 150_000, 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in own else next(other)) for b in range(256)]


class Merges:
    """A BPE model: ids of symbols, merges by id pair, and the sufficient lookahead."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [""] * size
        for k, v in [*vocab.items(), *self.special.items()]:
            self.token[v] = k
        self.whole = all(self.token)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {vocab[a] << _SHIFT | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        chars = byte_symbols()
        self.plain = [vocab[c] for c in chars]
        self.last = [vocab[c + self.end] for c in chars]
        self.symbols = [len(t.removesuffix(self.end) if self.end else t) for t in self.token]
        self.lookahead = self._lookahead(merges)
        #: For each token its parts and the rank of the merge that makes it.
        self.left, self.right, self.made = list(range(size)), list(range(size)), [-1] * size
        for rank, (a, b) in enumerate(merges):
            t = vocab[a + b]
            if self.made[t] >= 0:
                raise ValueError(f"two merges make {a + b!r}")
            self.left[t], self.right[t], self.made[t] = vocab[a], vocab[b], rank
        self._borders: dict[int, bool] = {}
        self._trie(vocab, merges)
        self._cache = _Cache(self)

    def _trie(self, vocab: dict, merges: list[tuple]) -> None:
        """next: node and symbol to node; ends: the token of each node, or -1. Only tokens that their own text is encoded to."""
        self.next: dict[int, int] = {}
        self.ends = [-1]
        plain, last = dict(zip(byte_symbols(), self.plain, strict=True)), dict(zip(byte_symbols(), self.last, strict=True))
        good = {*self.plain, *self.last}
        for a, b in merges:
            t = vocab[a + b]
            if vocab[a] in good and vocab[b] in good and self._border(vocab[a], vocab[b], self.made[t]):
                good.add(t)
        for t in good:
            text = self.token[t]
            ended = bool(self.end) and text.endswith(self.end)
            text = text.removesuffix(self.end) if ended else text
            path = [plain[c] for c in text]
            if ended:
                path[-1] = last[text[-1]]
            node = 0
            for x in path:
                at = node << _SHIFT | x
                node = self.next.get(at, 0)
                if not node:
                    node = self.next[at] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = t

    def _border(self, a: int, b: int, own: int | None = None) -> bool:
        """Whether no merge across the border of a and b comes before the merges that make them.

        own: the rank of the merge of a and b, when it is the one that makes a token of them.
        """
        made, get = self.made, self.rank.get
        before_a = before_b = _NEVER if own is None else own
        first = own is not None
        while True:
            m = get(a << _SHIFT | b, _NEVER)
            # of equal ranks the leftmost merge comes first
            if not first and m < before_a and m <= before_b and m != _NEVER:
                return False
            first = False
            if made[a] > made[b]:
                before_a, a = made[a], self.right[a]
            elif made[b] >= 0:
                before_b, b = made[b], self.left[b]
            else:
                return True

    def beside(self, a: int, b: int) -> bool:
        """Whether the tokens a and b can stand next to each other in an encoding."""
        key = a << _SHIFT | b
        ok = self._borders.get(key)
        if ok is None:
            if len(self._borders) >= BORDERS:
                self._borders.clear()
            ok = self._borders[key] = self._border(a, b)
        return ok

    def _lookahead(self, merges: list[tuple]) -> int:
        """Most symbols past a rule's right end that can decide whether it is applied.

        Rules in order of rank: a chain goes from a rule to an earlier one whose string starts
        inside the rule's string and ends beyond it. reach[s] is the furthest end of a chain
        over rules that start with the symbols s.
        """
        made: set[str] = set()
        reach: dict[tuple, int] = {}
        most = 0

        def parts(s: str) -> tuple:
            return (*s[: -len(self.end) - 1], s[-len(self.end) - 1 :]) if self.end and s.endswith(self.end) else tuple(s)

        for a, b in merges:
            x = parts(a) + parts(b)
            if any(len(parts(s)) > 1 and s not in made for s in (a, b)):
                raise ValueError(f"merge list isn't in order: {a!r} {b!r} comes before its parts")
            made.add(a + b)
            far = max([0, *(reach.get(x[k:], 0) - (len(x) - k) for k in range(1, len(x)))])
            most = max(most, far)
            for k in range(1, len(x)):
                reach[x[:k]] = max(reach.get(x[:k], 0), len(x) + far)
        return most + 1

    def word(self, w: str) -> list[int]:
        """The ids of one whole word, through the transducer."""
        t = WordTransducer(self)
        return [*t.push(w.encode()), *t.close()]


class _Cache(dict):
    """Ids of short words, two generations of a bounded size."""

    def __init__(self, merges: Merges) -> None:
        self.merges, self.old = merges, {}

    def __missing__(self, w: str) -> tuple:
        ids = self.old.get(w)
        if ids is None:
            ids = tuple(self.merges.word(w))
            if len(w) > CACHED:
                return ids
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[w] = ids
        return ids


class WordTransducer:
    """One word, byte by byte: push() returns the ids that no later byte can change, close() the rest.

    State: the last token at every end position that isn't settled yet, the paths of the token
    trie that are open, and one byte, as the last byte of a word is a symbol of its own.
    """

    def __init__(self, merges: Merges, block: int = BLOCK) -> None:
        self.m, self.block = merges, block
        self.byte: int | None = None
        #: tokens[k] ends at position base + k; tokens[0] is the last one emitted, or None.
        self.base, self.tokens = 0, [None]
        self.paths: list[tuple[int, int]] = []

    @property
    def held(self) -> int:
        """Symbols that are not settled."""
        return len(self.tokens) - 1

    def _step(self, symbol: int) -> None:
        m, base, tokens = self.m, self.base, self.tokens
        self.paths.append((base + len(tokens) - 1, 0))
        paths, found = [], -1
        for start, node in self.paths:
            node = m.next.get(node << _SHIFT | symbol)
            if node is not None:
                paths.append((start, node))
                t = m.ends[node]
                if t >= 0 and found < 0:
                    before = tokens[start - base]
                    if before is None or m.beside(before, t):
                        found = t
        if found < 0:
            raise AssertionError("no token ends here")
        tokens.append(found)
        self.paths = paths

    def _settled(self, ends: set[int]) -> list[int]:
        """Emit the tokens that the encodings at all these ends share."""
        size, base, tokens = self.m.symbols, self.base, self.tokens
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - size[tokens[last - base]])
        (at,) = ends
        out, back = [], at
        while back > base:
            out.append(tokens[back - base])
            back -= size[out[-1]]
        self.tokens, self.base = tokens[at - base :], at
        return out[::-1]

    def push(self, data: bytes) -> list[int]:
        out: list[int] = []
        plain = self.m.plain
        for b in data:
            if self.byte is not None:
                self._step(plain[self.byte])
                if len(self.tokens) % self.block == 0:
                    out += self._settled({self.base + len(self.tokens) - 1, *(start for start, _ in self.paths)})
            self.byte = b
        return out

    def close(self) -> list[int]:
        if self.byte is None:
            return []
        self._step(self.m.last[self.byte])
        self.byte, self.paths = None, []
        return self._settled({self.base + len(self.tokens) - 1})


#: The split pattern of the public tokenizer file, and the code points that its
#: library, whose letters and numbers are those of Unicode 16, counts as neither, though later
#: tables do; the lower case of letters that earlier tables lack; and the marks that its NFC, of
#: Unicode 9, doesn't know: they neither move nor compose, and nothing moves or composes past them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NEITHER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee "
    "11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 16ff4-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 "
    "18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 "
    "1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
LETTERS = (
    "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e 11390-113b5 113b7 113d1 113d3 11bc0-11be0 "
    "13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0"
)
NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
LOWER = "1c89:1c8a a7cb:264 a7cc:a7cd a7ce:a7cf a7d2:a7d3 a7d4:a7d5 a7da:a7db a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"
MARKS = (
    "7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b 1145e "
    "11839-1183a 11930 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef 1e4ec-1e4ef"
)


def _class(ranges: str) -> str:
    """The inside of a character class."""
    return "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in ranges.split())


def _lower_table() -> dict[int, int]:
    out = {}
    for item in LOWER.split():
        upper, low = item.split(":")
        first, _, last = upper.partition("-")
        for k in range(int(last or first, 16) - int(first, 16) + 1):
            out[int(first, 16) + k] = int(low, 16) + k
    return out


_LOWER = _lower_table()
_UPPER = regex.compile(f"[{''.join(map(chr, _LOWER))}]")
_MARK = regex.compile(f"([{_class(MARKS)}])")
SPLIT = regex.compile(PATTERN)
#: The same split with the letters and numbers of the library, for texts with a character that tables disagree on.
_L, _N = f"[[\\p{{L}}--[{_class(NEITHER)}]]||[{_class(LETTERS)}]]", f"[[\\p{{N}}--[{_class(NEITHER)}]]||[{_class(NUMBERS)}]]"
_PINNED = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{_L}{_N}]").replace(r"[\p{L}]", _L).replace(r"[\p{N}]", _N), regex.V1)
_DISPUTED = regex.compile(f"[{_class(NEITHER)}{_class(LETTERS)}{_class(NUMBERS)}]")
_LETTERS, _OTHER = regex.compile(f"{_L}+", regex.V1), regex.compile(f"[^\\s{_L}{_N}]+", regex.V1)
#: Texts of Latin letters, ASCII digits and common marks need no Unicode properties: the same split in plain classes.
_COMPLEX = re.compile("[^\t-\r -\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f\u2010-\u2027\u2030-\u203a]")
_LATIN = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIMPLE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\s{_LATIN}0-9]+")
_LAST_SPACE = regex.compile(r"(?r)\s")
_RARE = regex.compile(r"[^\u0000-\u0557\u2000-\u203a一-鿿]")
#: Characters that never change, or are changed by, what stands before them under NFC.
_STABLE = regex.compile(r"[\u0000-˿一-鿿]")


def normalised(text: str) -> str:
    """NFC, then lower case character by character (no context rule for the final sigma)."""
    if not text.isascii():
        rare = _RARE.search(text)
        parts = _MARK.split(text) if rare else [text]
        text = "".join([unicodedata.normalize("NFC", part) for part in parts]).replace("Σ", "σ")
        if rare and _UPPER.search(text):
            text = text.translate(_LOWER)
    return text.lower()


def split(text: str) -> list[str]:
    """The words of normalised text."""
    if not _COMPLEX.search(text):
        return _SIMPLE.findall(text)
    if _RARE.search(text) and _DISPUTED.search(text):
        return _PINNED.findall(text)
    return SPLIT.findall(text)


class StreamEncoder:
    """Text in pieces of any size: feed() returns the ids that are certain, close() the rest.

    White space ends a word, so text up to the last white space is encoded at once. In a run
    without white space longer than a block, matches before the last are complete; the last goes
    through a WordTransducer. Memory: the lookahead, a block and the special tokens' length.
    """

    def __init__(self, merges: Merges, block: int = 1 << 16) -> None:
        self.m, self.block, self.text, self.run = merges, block, "", None
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None
        self.keep = max([8, *map(len, merges.special)])

    def feed(self, piece: str) -> list[int]:
        self.text += piece
        if len(self.text) < self.block:
            return []
        if m := _LAST_SPACE.search(self.text):
            done, self.text = self.text[: m.end()], self.text[m.end() :]
            return self._encode(done)
        return self._within(len(self.text) - self.keep)

    def close(self) -> list[int]:
        done, self.text = self.text, ""
        return self._encode(done)

    def _end_run(self) -> list[int]:
        ids = self.run[1].close() if self.run else []
        self.run = None
        return ids

    def _within(self, cut: int) -> list[int]:
        """Encode up to about cut within a run without white space, keeping the last match open."""
        while cut > 0 and not _STABLE.match(self.text[cut]):
            cut -= 1
        if self.special and (m := next((m for m in self.special.finditer(self.text) if m.start() < cut < m.end()), None)):
            cut = m.start()
        if cut <= 0:
            return []
        done, self.text = self.text[:cut], self.text[cut:]
        return self._encode(done, more=True)

    def _encode(self, text: str, more: bool = False) -> list[int]:
        ids: list[int] = []
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            self._part(normalised(text[at : m.start()]), False, ids)
            ids += self._end_run()
            ids.append(self.m.special[m[0]])
            at = m.end()
        self._part(normalised(text[at:]), more, ids)
        return ids

    def _part(self, text: str, more: bool, ids: list[int]) -> None:
        if self.run and text:
            kind = self.run[0]
            m = kind.match(text)
            if m:
                ids += self.run[1].push(m[0].encode())
                text = text[m.end() :]
            if text or not more:
                ids += self._end_run()
            else:
                return
        elif self.run and not more:
            ids += self._end_run()
        words = split(text)
        if more and words:
            last = words.pop()
            kind = _LETTERS if _LETTERS.fullmatch(last) else _OTHER if _OTHER.fullmatch(last) else None
            if kind is None or last == "'" or (words and words[-1] == "'" and len(last) < 2):
                # may still become a contraction
                self.text = (words.pop() if words and words[-1] == "'" else "") + last + self.text
                last = ""
            else:
                self.run = (kind, WordTransducer(self.m))
        ids += itertools.chain.from_iterable(map(self.m._cache.__getitem__, words))
        if more and self.run:
            ids += self.run[1].push(last.encode())


class StreamDecoder:
    """Ids in, text out. mode "join": the vocabulary's strings with a space between, as the
    library decodes where the file names no decoder. mode "bytes": the bytes behind the strings,
    word ends as spaces; an unfinished character waits for its last byte."""

    def __init__(self, merges: Merges, mode: str = "join") -> None:
        self.m, self.mode, self.first = merges, mode, True
        self.whole = merges.whole
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.byte = {c: b for b, c in enumerate(byte_symbols())}

    def feed(self, ids: Iterable[int]) -> str:
        token = self.m.token
        if self.mode == "join":
            out = " ".join([token[i] for i in ids] if self.whole else [token[i] for i in ids if 0 <= i < len(token) and token[i]])
            if out and not self.first:
                out = " " + out
            self.first = self.first and not out
            return out
        out = []
        special = set(self.m.special.values())
        for i in ids:
            if i in special:
                out.append(self.utf8.decode(b"", final=True) + token[i])
                continue
            t = token[i]
            ended = bool(self.m.end) and t.endswith(self.m.end)
            out.append(self.utf8.decode(bytes(self.byte[c] for c in (t.removesuffix(self.m.end) if ended else t))))
            if ended:
                out.append(self.utf8.decode(b"", final=True) + " ")
        return "".join(out)

    def close(self) -> str:
        return self.utf8.decode(b"", final=True)


@functools.lru_cache(maxsize=4)
def load(path: str) -> Merges:
    return Merges(path)


def encode(merges: Merges, text: str | None, piece: int = 1 << 16) -> Iterator[list[int]]:
    """Runs of ids of a whole text, made from pieces of it."""
    e = StreamEncoder(merges, piece)
    for at in range(0, len(text or ""), piece):
        yield e.feed(text[at : at + piece])
    yield e.close()


def _digests(batches, path: str, keep_ids: bool):
    m = load(path)
    names = [str(i) for i in range(len(m.token))]
    for batch in batches:
        n_tokens, ids_sha, text_sha, kept = [], [], [], []
        for v in batch.column(1):
            n, one, two, d, all_ids = 0, hashlib.sha256(), hashlib.sha256(), StreamDecoder(m), []
            for ids in encode(m, v.as_py()):
                if ids:
                    one.update(((" " if n else "") + " ".join([names[i] for i in ids])).encode())
                    two.update(d.feed(ids).encode())
                    n += len(ids)
                    if keep_ids:
                        all_ids += ids
            two.update(d.close().encode())
            n_tokens.append(n)
            ids_sha.append(one.hexdigest())
            text_sha.append(two.hexdigest())
            kept.append(all_ids)
        arrays = [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
        out = pa.RecordBatch.from_arrays(arrays, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        yield out.append_column("ids", pa.array(kept, pa.list_(pa.int32()))) if keep_ids else out


def encode_documents(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row's whole text, without a shuffle.

    A null text is an empty one: no tokens and the digests of empty strings. Null and repeated
    ids are passed through row by row; ids must be integers; other columns play no part. path
    must be readable on every executor.
    """
    rows = df.select(integer_id(df, id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(lambda it: _digests(it, path, keep_ids), schema).withColumnRenamed("id", id_col)
