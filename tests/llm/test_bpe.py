import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termloom.llm import bpe
from termloom.llm.queries import WORD_BPE as PATH

from .helpers import clash, sha

MERGES = bpe.load(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def mine(text, piece=1 << 16):
    return [i for run in bpe.encode(MERGES, text, piece) for i in run]


def theirs(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abcdeth'!?-#1 \n", "É", "Σ", "ß", "e\u0301", "漢", "가", "😀", "\u2028", "'ll", "<|endoftext|>", "<|endof"]), max_size=40).map("".join), st.sampled_from([3, 17, 1 << 16]))
def test_equals_the_library_whatever_the_pieces(text, piece):
    assert mine(text, piece) == theirs(text)


@pytest.mark.parametrize("text", ["-" * 30000, "a" * 20000, "ab!" * 9000, "!?" * 9000 + "é" * 9000, "", " \n", "<|startoftext|>x<|endoftext|>"])
def test_long_runs(text):
    assert mine(text) == theirs(text) == mine(text, 1000)


def test_every_character_is_encoded_as_by_the_library():
    """Between letters, marks and digits, and after marks that may move or compose."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert [c for c in points if mine(f"ab{c}cd !{c}!{c}1{c}") != theirs(f"ab{c}cd !{c}!{c}1{c}")] == []
    mixed = "a\u0345{0}\u0301 e{0}\u0323 {0}\u0307{0}"
    assert [c for c in points if mine(mixed.format(c)) != theirs(mixed.format(c))] == []


def test_random_words():
    r = random.Random(3)
    for alphabet in ("ab", "abc", "aeint", "abcdefghijklmnopqrstuvwxyz", "-=_", "!?.", "0a", "éèa"):
        for _ in range(200):
            w = "".join(r.choices(alphabet, k=r.randint(1, 200)))
            assert mine(w) == theirs(w)


@pytest.mark.parametrize("word", ["a" * 20000, "ha" * 6000, "=" * 9000, "".join(random.Random(5).choices("abcdefthin", k=20000))])
def test_a_word_needs_constant_memory(word):
    t = bpe.WordTransducer(MERGES, block=16)
    out, held = [], 0
    for at in range(0, len(word), 100):
        out += t.push(word[at : at + 100].encode())
        held = max(held, t.held)
    out += t.close()
    assert out == theirs(word)
    assert held <= 16 + 4 * max(MERGES.symbols) < MERGES.lookahead


def test_what_is_emitted_does_not_depend_on_what_follows():
    word = "thinking-of-"
    for tail in ("", "a", "ing", "ofofofof", "zzzz" * 20):
        t = bpe.WordTransducer(MERGES, block=1)
        sure = t.push(("internationalisation" * 5).encode())
        assert theirs("internationalisation" * 5 + tail)[: len(sure)] == sure and sure
    assert MERGES.lookahead > 1 and word


def test_tokens_that_can_stand_side_by_side():
    r = random.Random(6)
    made = [t for t in range(len(MERGES.token)) if MERGES.made[t] >= 0 and not MERGES.token[t].endswith("</w>")]
    chars = {c: b for b, c in enumerate(bpe.byte_symbols())}
    for _ in range(3000):
        a, b = r.choice(made), r.choice(made)
        t = bpe.WordTransducer(MERGES)
        for c in MERGES.token[a] + MERGES.token[b]:
            t._step(MERGES.plain[chars[c]])
        got = t._settled({t.held})
        assert (got == [a, b]) == MERGES.beside(a, b)


def test_two_merges_that_make_one_token_are_refused(tmp_path):
    import json

    chars = {c: i for i, c in enumerate(bpe.byte_symbols())}
    spec = {"model": {"vocab": chars | {"ab": 256, "bc": 257, "abc": 258}, "merges": [["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]], "end_of_word_suffix": ""}, "added_tokens": []}
    p = tmp_path / "m.json"
    p.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Merges(str(p))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(1, 5))
def test_decoding(text, step):
    ids = theirs(text)
    d = bpe.StreamDecoder(MERGES)
    got = "".join([d.feed(ids[i : i + step]) for i in range(0, len(ids), step)]) + d.close()
    assert got == LIBRARY.decode(ids, skip_special_tokens=False)


def test_byte_decoder_gives_the_normalised_words_back():
    text = "Héllo wörld 漢字 ok<|endoftext|>"
    d = bpe.StreamDecoder(MERGES, mode="bytes")
    got = "".join(d.feed([i]) for i in mine(text)) + d.close()
    assert got == "héllo wörld 漢字 ok <|endoftext|>"


def test_merge_list_out_of_order_is_refused(tmp_path):
    import json

    spec = {"model": {"vocab": {"a": 0, "b": 1, "ab": 2, "abb": 3}, "merges": [["ab", "b"], ["a", "b"]], "end_of_word_suffix": ""}, "added_tokens": []}
    chars = {c: i + 4 for i, c in enumerate(bpe.byte_symbols()) if c not in "ab"}
    spec["model"]["vocab"] |= chars
    p = tmp_path / "m.json"
    p.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Merges(str(p))


def test_documents(spark):
    texts = {1: "Some Words, here.", 2: "", 3: None, 4: "x" * 50000 + " end", None: "Some Words, here."}
    df = clash(spark.createDataFrame([*texts.items(), (1, "Some Words, here.")], "doc_id long, text string"))
    rows = bpe.encode_documents(df, PATH, keep_ids=True).collect()
    assert len(rows) == 6
    for r in rows:
        ids = theirs(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == sha(" ".join(map(str, ids))) and r.decoded_sha256 == sha(LIBRARY.decode(ids, skip_special_tokens=False))
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0
