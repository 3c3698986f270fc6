import base64
import random
import re

import numpy as np
import pytest
import tiktoken

from termloom.llm import token_counts as tc
from termloom.llm.queries import BYTE_BPE as PATH

from .helpers import clash, peak_mb


def brute(text, starts, rule):
    """Token counts by section, character by character."""
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=tc.PATTERN, mergeable_ranks=ranks, special_tokens={})
    owner_of = lambda c: max(i for i, s in enumerate(starts) if s <= c)
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    at, counts, crossing = 0, [0] * len(starts), [0] * len(starts)
    for t in enc.encode_ordinary(text):
        n = len(enc.decode_single_token_bytes(t))
        chars = range(char_of[at], char_of[at + n - 1] + 1)
        at += n
        sections = [owner_of(c) for c in chars]
        own = {"start": sections[0], "end": sections[-1], "most": max(sorted(set(sections)), key=sections.count)}[rule]
        counts[own] += 1
        crossing[own] += len(set(sections)) > 1
    return counts, crossing


@pytest.mark.parametrize("rule", tc.RULES)
def test_lines_against_brute_force(spark, rule):
    texts = ["one line", "a\n\n\nb  \n\n   c\n", "über\nÄä 漢字\n😀😀\n\nx", "\n", "x" * 3000 + "\n" + "y " * 500]
    df = clash(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {}
    for r in tc.section_tokens(df, PATH, rule=rule).orderBy("doc_id", "section").collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        starts = tc._starts(t, "\n").tolist()
        counts, crossing = brute(t, starts, rule)
        assert [r.n_tokens for r in got[i]] == counts and [r.n_crossing for r in got[i]] == crossing
        assert [r.start_char for r in got[i]] == starts and got[i][-1].end_char == len(t)


def test_rules_differ_on_a_crossing_token():
    start, end, sections = np.array([0, 3]), np.array([3, 8]), np.array([0, 4])
    assert [tc.attribute(start, end, sections, 8, r)[0].tolist() for r in tc.RULES] == [[0, 1], [0, 0], [0, 1]]
    assert tc.attribute(np.array([3]), np.array([5]), sections, 8, "most")[0].tolist() == [0]  # a tie goes to the earlier


def test_fields_nulls_and_empties(spark):
    df = spark.createDataFrame([(1, "title", "body text"), (None, None, None), (1, "", "x")], "doc_id long, title string, body string")
    rows = tc.section_tokens(df, PATH, text_cols=["title", "body"]).collect()
    assert len(rows) == 6 and sum(r.n_tokens for r in rows if r.doc_id is None) == 1  # the separator
    one = tc.section_tokens(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), PATH).collect()
    assert [(r.section, r.n_tokens, r.end_char) for r in one] == [(0, 0, 0)] * 2
    assert tc.section_tokens(df.limit(0), PATH, text_cols="title").count() == 0
    with pytest.raises(ValueError):
        tc.section_tokens(df, PATH, rule="other")


def test_text_in_pieces_is_encoded_as_a_whole(monkeypatch):
    encoding, _ = tc._vocabulary(PATH)
    monkeypatch.setattr(tc, "RUN", 3)
    monkeypatch.setattr(tc, "PIECE", 20)
    monkeypatch.setattr(tc, "_RUNS", re.compile(f"[{tc.SPACE}]{{3,}}"))
    r = random.Random(1)
    for _ in range(5000):
        text = "".join(r.choices(["a", "b1", " ", "  ", "\n", "\t", "!", " ", "漢", "\u3000", "'s", "\x1c"], k=r.randint(0, 60)))
        assert [i for part in tc.encoded(encoding, text) for i in part] == encoding.encode_ordinary(text)


@pytest.mark.parametrize("text", [" " * 5_000_000, "a" + " " * 2_000_000 + "b", "\n" * 3_000_000 + "x\n"])
def test_long_white_space(text):
    start, end = tc.token_spans(PATH, text)
    assert start[0] == 0 and end[-1] == len(text) and (start[1:] == end[:-1]).all()


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError):
        tc.section_tokens(spark.createDataFrame([("x", "a")], "doc_id string, text string"), PATH)


def test_a_very_long_text_takes_bounded_memory():
    lines = f"from termloom.llm import token_counts as tc\ntext = 'some words of it ' * 1_200_000\ntc._vocabulary({PATH!r})"
    assert peak_mb(f"tc.token_spans({PATH!r}, text)", lines) < 500
