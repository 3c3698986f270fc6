"""Token counts by section: encode a whole document once, then attribute the tokens.

The document is encoded as one text, so counts add up to the document's own. Token character
spans are joined to the sections' spans by interval (a merge of two ordered lists), and a token
that crosses a boundary goes to one section by an explicit rule.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import integer_id

RULES = ("most", "start", "end")
#: Fixed value: the split pattern of the public byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: what the pattern counts as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space that is encoded without the pattern, and characters that are encoded in one go.
RUN, PIECE = 1000, 1 << 18
_RUNS = re.compile(f"[{SPACE}]{{{RUN},}}")
_EDGE = re.compile(f"[^{SPACE}](?=[{SPACE}])")


@functools.lru_cache(maxsize=4)
def _vocabulary(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for k, v in ranks.items():
        size[v] = len(k)
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text that the pattern splits anyway: one begins where white space follows something else."""
    at = 0
    while len(text) - at > PIECE and (m := _EDGE.search(text, at + PIECE)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:] if at else text


def encoded(encoding: tiktoken.Encoding, text: str) -> Iterator[list[int]]:
    """Ids of a whole text, piece by piece.

    A long run of white space is one match of the pattern up to its last character, which goes
    with what follows it, or to its end where the text ends; the library's matcher would need a
    stack as deep as the run.
    """
    done = 0
    for piece in _pieces(text):
        done += len(piece)
        at = 0
        for m in _RUNS.finditer(piece) if len(piece) >= RUN else ():
            if m.start() > at:
                yield encoding.encode_ordinary(piece[at : m.start()])
            at = m.end() if m.end() == len(piece) and done == len(text) else m.end() - 1
            yield encoding._core_bpe.encode_single_piece(piece[m.start() : at].encode())
        yield encoding.encode_ordinary(piece[at:] if at else piece)


def token_spans(path: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of a text's tokens. A token with part of a character covers all of it."""
    encoding, size = _vocabulary(path)
    text = text.encode("utf-8", "replace").decode() if not text.isascii() else text
    lengths = np.concatenate([size[np.asarray(ids, np.int64)] for ids in encoded(encoding, text)])
    end = np.cumsum(lengths)
    start = end - lengths
    if len(end) and not text.isascii():
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        start, end = char[start], char[end - 1] + 1
    return start, end


def attribute(start: np.ndarray, end: np.ndarray, sections: np.ndarray, length: int, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """(section, crosses) of each token; sections: ordered starts that cut [0, length) into parts.

    most: the section with most of the token's characters, the earliest of equals; start and
    end: that of the token's first or last character.
    """
    first = np.searchsorted(sections, start, side="right") - 1
    last = np.searchsorted(sections, end - 1, side="right") - 1
    crosses = first != last
    if rule == "start":
        return first, crosses
    if rule == "end":
        return last, crosses
    owner = first.copy()
    bound = np.append(sections, length)
    for i in np.flatnonzero(crosses):
        s = np.arange(first[i], last[i] + 1)
        share = np.minimum(bound[s + 1], end[i]) - np.maximum(bound[s], start[i])
        owner[i] = s[np.argmax(share)]
    return owner, crosses


def _starts(text: str, separator: str) -> np.ndarray:
    """A section ends after its separator; an empty text has one empty section."""
    out, at = [0], text.find(separator)
    while at >= 0:
        at += len(separator)
        if at < len(text):
            out.append(at)
        at = text.find(separator, at)
    return np.array(out, np.int64)


def _counted(batches, path: str, n_fields: int, separator: str, rule: str):
    for batch in batches:
        out = {k: [] for k in ("row", "section", "start_char", "end_char", "n_tokens", "n_crossing")}
        fields = [batch.column(1 + i) for i in range(n_fields)]
        for r in range(batch.num_rows):
            parts = [f[r].as_py() or "" for f in fields]
            if n_fields == 1:
                text = parts[0]
                sections = _starts(text, separator)
            else:
                text = separator.join(parts)
                sections = np.cumsum([0, *(len(p) + len(separator) for p in parts[:-1])])
            start, end = token_spans(path, text)
            owner, crosses = attribute(start, end, sections, len(text), rule)
            k = len(sections)
            out["row"].append(np.full(k, r))
            out["section"].append(np.arange(k))
            out["start_char"].append(sections)
            out["end_char"].append(np.append(sections[1:], len(text)))
            out["n_tokens"].append(np.bincount(owner, minlength=k))
            out["n_crossing"].append(np.bincount(owner[crosses], minlength=k))
        if out["row"]:
            cols = {k: np.concatenate(v) for k, v in out.items()}
            row = pa.array(cols.pop("row"))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), *(pa.array(v, pa.int64()) for v in cols.values())], names=["id", *cols])


def section_tokens(df: DataFrame, path: str, *, id_col: str = "doc_id", text_cols: str | list[str] = "text", separator: str = "\n", rule: str = "most") -> DataFrame:
    """(id_col, section, start_char, end_char, n_tokens, n_crossing), one row for each section.

    With one text column the sections are the parts that end with separator (lines); with
    several columns each is a section of the columns joined by separator, which counts with the
    field before it; a column's own line ends don't matter. n_crossing: tokens of the section that also cover characters of another.
    Null texts are empty; an empty text has one section without tokens. Ids are integers and may be null or
    repeat: every row is counted on its own. Sections of a row add up to the row's tokens.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    cols = [text_cols] if isinstance(text_cols, str) else list(text_cols)
    rows = df.select(integer_id(df, id_col).alias("id"), *(F.col(c).cast("string").alias(f"t{i}") for i, c in enumerate(cols)))
    schema = "id long, section long, start_char long, end_char long, n_tokens long, n_crossing long"
    n = len(cols)
    return rows.mapInArrow(lambda it: _counted(it, path, n, separator, rule), schema).withColumnRenamed("id", id_col)
