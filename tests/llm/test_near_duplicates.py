import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termloom.llm import dartminhash as dm
from termloom.llm._components import components
from termloom.llm._text import Words, distinct, merged, runs, shingles

from . import helpers


def edited(r, words, share):
    w = list(words)
    for i in r.choice(len(w), int(share * len(w)), replace=False):
        w[i] = f"e{r.integers(1 << 30)}"
    return " ".join(w)


def corpus(seed=1, groups=12):
    r = helpers.rng(seed)
    out = []
    for g in range(groups):
        base = [f"w{r.integers(5000)}" for _ in range(int(r.integers(20, 300)))]
        out += [" ".join(base)] * int(r.integers(1, 3)) + [edited(r, base, s) for s in (0.005, 0.01, 0.03, 0.05, 0.2)]
    passage = " ".join(f"p{i}" for i in range(60))
    out += [passage + " " + " ".join(f"u{r.integers(1 << 30)}" for _ in range(int(r.integers(40, 200)))) for _ in range(15)]
    return out + ["", "one two", "one two", "one two three", None, "!!!"]


@pytest.mark.parametrize("weight", ["set", "log", "count"])
def test_components_equal_brute_force(spark, weight):
    texts = [*corpus(), *(" ".join(["line of words that comes again"] * k + [f"end{k % 3}"] * 4) for k in (3, 4, 9, 10, 11, 30)), "X" * 3000 + " y", "x" * 3000 + " y"]
    ids = [7 * i + 3 for i in range(len(texts))]
    df = helpers.clash(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string"))
    got = {r.doc_id: r.component_id for r in dm.near_duplicates(df, weight=weight).collect()}
    assert got == helpers.near(ids, texts, weight=weight)
    assert len(got) == len(ids) and got[ids[texts.index("one two")]] == ids[texts.index("one two")]
    assert sum(got[i] == i for i in ids) < len(ids) - 30


def test_blocks_find_links_between_bucket_members(spark, monkeypatch):
    """A chain whose ends aren't similar, in blocks of very few documents."""
    monkeypatch.setattr(dm, "BLOCK", 600)
    monkeypatch.setattr(dm, "BLOCK_ROWS", 4)
    monkeypatch.setattr(dm, "HOT", 3)
    r = helpers.rng(3)
    base = [f"w{i}" for i in range(200)]
    texts, w = [], list(base)
    for _ in range(30):
        texts.append(" ".join(w))
        w = edited(r, w, 0.01).split()
    ids = [int(x) for x in helpers.rng(4).permutation(1000)[: len(texts)]]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in dm.near_duplicates(df).collect()}
    assert got == helpers.near(ids, texts)


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (5, None)], "doc_id long, text string")
    got = sorted(map(str, [(r.doc_id, r.component_id, r.kept) for r in dm.near_duplicates(df).collect()]))
    assert got == sorted(map(str, [(None, None, True), (None, None, True), (2, 1, False), (1, 1, True), (1, 1, True), (5, 5, True)]))
    assert dm.near_duplicates(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_compared_each(spark):
    a, b, w = ("a1 b1 c1 d1 e1 f1 " * 20, "q2 r2 s2 t2 u2 v2 " * 20, " ".join(f"x{i}" for i in range(150)))
    rows = [(5, w + " end"), (5, b), (7, w), (8, a), (9, b), (9, a + " z"), (5, b), (11, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in dm.near_duplicates(df).collect()}
    assert got == set(helpers.near([i for i, _ in rows], [t for _, t in rows]).items()) and (7, 5) in got
    assert len(dm.near_duplicates(df).collect()) == len(rows)


def test_representatives_keep_one_row_of_each_group(spark):
    w = " ".join(f"x{i}" for i in range(150))
    rows = [(5, w, "s"), (5, w, "r"), (None, w, "s"), (None, w, "s"), (5, "an other text of the same id", "s"), (None, "copy without any id at all", "s"), (None, "copy without any id at all", "s")]
    rows += [(9, w + " end", "s"), (3, None, "s"), (3, None, "s"), (None, "", "s"), (None, "", "s"), (12, "!!", "s")]
    df = helpers.clash(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = dm.representatives(df)
    assert got.columns == df.columns
    left = sorted(((r.doc_id, r.text, r.source) for r in got.collect()), key=str)
    want = [(5, w, "r"), (5, "an other text of the same id", "s"), (None, "copy without any id at all", "s"), (3, None, "s"), (3, None, "s"), (None, "", "s"), (None, "", "s"), (12, "!!", "s")]
    assert left == sorted(want, key=str)
    assert dm.representatives(df.limit(0)).count() == 0


def test_ids_must_be_integers(spark):
    with pytest.raises(TypeError):
        dm.near_duplicates(spark.createDataFrame([("x", "a b")], "doc_id string, text string"))
    assert [r.component_id for r in dm.near_duplicates(spark.createDataFrame([(1, "a b")], "doc_id int, text string")).collect()] == [1]


def test_a_very_long_text_takes_a_few_bytes_for_each_of_its_own():
    lines = "from termloom.llm import dartminhash as dm, _text\nimport pyarrow as pa\nb = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([' '.join(f'w{i % 90001}x{i % 7}' for i in range(2_500_000))])], ['n', 'th', 'text'])"
    assert helpers.peak_mb("n = sum(r.num_rows for r in dm._sketches([b], 5, 24, 5, 'log'))\nassert n == 1", lines) < 450


def test_runs_of_a_long_text_give_the_shingles_of_the_whole():
    r = helpers.rng(9)
    text = " ".join("".join(r.choice(list("abcdéf,"), r.integers(1, 9))) for _ in range(9000)) + "x" * 5000 + " , " * 3000 + "y" * 70000 + " end. of"
    whole = [distinct(*shingles(Words([text]), 5))]
    for limit in (300, 1024, 20000):
        parts = [distinct(*shingles(w, 5)) for _, _, _, w in runs([text], overlap=4, limit=limit)]
        got = merged(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        assert all((x == y).all() for x, y in zip(got, whole[0], strict=True)) and len(parts) > 1
    assert sorted(whole[0][2].tolist()) == sorted(helpers.shingles(text).values())


def test_signatures_estimate_weighted_jaccard():
    r = helpers.rng(5)
    for overlap in (0.3, 0.8):
        n = 400
        a = r.integers(0, 1 << 62, n).astype(np.uint64)
        b = a.copy()
        b[: int(n * (1 - overlap))] = r.integers(0, 1 << 62, int(n * (1 - overlap))).astype(np.uint64)
        wa, wb = r.uniform(0.3, 9, n), r.uniform(0.3, 9, n)
        docs, elements, weights = np.repeat([0, 1], n), np.concatenate([a, b]), np.concatenate([wa, wb])
        s = dm.darts(docs, elements, weights, 2, 2048)
        x, y = dict(zip(a.tolist(), wa.tolist(), strict=True)), dict(zip(b.tolist(), wb.tolist(), strict=True))
        both = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
        want = both / (sum(x.values()) + sum(y.values()) - both)
        assert abs((s[0] == s[1]).mean() - want) < 0.05


def test_signature_of_a_document_does_not_depend_on_its_batch():
    t = ["a b c d e f g h i j", "x " * 40, "q w e r t y u i o p a s d f"]

    def sign(texts):
        d, h, c = distinct(*shingles(Words(texts), 5))
        return dm.darts(d, h, c, len(texts), 60)

    assert (sign(t)[2] == sign(t[2:])[0]).all() and (sign(t) > 0).all()


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == helpers.components(ids, [e for e in edges if e[0] != e[1]])


def test_path_of_components(spark):
    df = spark.range(70).selectExpr("id as a", "id + 1 as b")
    assert {r.component for r in components(df).collect()} == {0}
