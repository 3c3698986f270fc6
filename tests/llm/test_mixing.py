"""Mixing against a plain-Python form of the whole operator, and its raking against the targets."""

import base64
import struct
import warnings

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from termloom.llm import mixing, token_counts
from termloom.llm.queries import BYTE_BPE as PATH

from .helpers import clash, rng, words


def docs(spark, n=600):
    r = rng(4)
    rows = []
    for i in range(n):
        lang = "en" if i % 2 else "fr"
        own = [f"{lang}{(i % 3) * 100 + int(x)}" for x in r.integers(0, 30, int(r.integers(40, 80)))]
        rows.append((i, " ".join(own), "big" if i % 5 == 0 else None if i % 7 == 0 else f"s{i % 11 % 4}", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def plain(rows, model, targets, alpha, share, seed=17):
    """(doc_id, topic, tokens, rate, kept) of rows (doc_id, text, source, lang), without numpy or Spark."""
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    described = []
    for i, text, source, lang in rows:
        table, found = model.tables[lang if lang in model.tables else None], words(text)
        score = [0.0] * table.shape[1]
        for w in found:
            at = int(mixing.Words([w]).hash[0]) % (1 << mixing.BITS)
            score = [s + float(v) for s, v in zip(score, table[at], strict=True)]
        topic = f"topic{max(range(len(score)), key=lambda k: (score[k], -k))}" if found else "none"
        described.append((i, (source, lang, topic), len(enc.encode_ordinary(text or ""))))
    cells = {}
    for _, c, t in described:
        cells[c] = cells.get(c, 0) + t
    total = sum(cells.values())
    wants, aim = [], share * total
    for d, name in enumerate(("source", "lang", "topic")):
        have = {}
        for c, t in cells.items():
            have[c[d]] = have.get(c[d], 0) + t
        given = targets.get(name, {})
        power = {k: v ** alpha[name] if v else 0.0 for k, v in have.items()}
        rest = sum(v for k, v in power.items() if k not in given)
        part = {k: given[k] if k in given else v * ((1 - sum(given.values())) / rest if given else 1) for k, v in power.items()}
        wants.append((have, part))
        aim = min(aim, sum(v for k, v in have.items() if part[k] > 0))
    marginals = []
    for have, part in wants:
        # by bisection: the unit at which no class gives more than it has and all give the aim
        lo, hi = 0.0, 1e18
        for _ in range(300):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(have[k], mid * part[k]) for k in have) < aim else (lo, mid)
        marginals.append({k: min(have[k], hi * part[k]) for k in have})
    rate = {c: min(1.0, aim / total) for c in cells}
    for _ in range(400):
        for d, want in enumerate(marginals):
            have = {}
            for c, t in cells.items():
                have[c[d]] = have.get(c[d], 0.0) + t * rate[c]
            rate = {c: min(1.0, r * want[c[d]] / have[c[d]]) if have[c[d]] else 0.0 for c, r in rate.items()}
    out = {}
    for i, c, t in described:
        p = rate[c] if cells[c] else 1.0
        h = xxhash.xxh64_intdigest(str(i).encode() if i is not None else b"", seed=xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=42))
        out[i] = (c[2], t, p, (h >> 11) * 2.0**-53)
    return out


@pytest.mark.parametrize("targets", [{}, {"lang": {"en": 0.7}}, {"lang": {"en": 0.6, "fr": 0.4}, "source": {"big": 0.2}}])
def test_equals_the_plain_form(spark, targets):
    df = docs(spark, 300)
    model = mixing.fit_topics(df, k=3)
    got = mixing.mixed(clash(df).drop("source_", "id"), PATH, topics=model, targets=targets).collect()
    want = plain([tuple(r) for r in df.collect()], model, targets, mixing.ALPHA, mixing.SHARE)
    assert len(got) == 300 and len({r.topic for r in got}) == 3
    for r in got:
        topic, tokens, rate, drawn = want[r.doc_id]
        assert (r.topic, r.tokens) == (topic, tokens) and abs(r.rate - rate) < 1e-6
        assert r.kept == (drawn < r.rate)


def test_topics_are_the_clusters_of_a_language(spark):
    df = docs(spark)
    names = {r.doc_id: r.topic for r in mixing.mixed(df, PATH, topics=mixing.fit_topics(df, k=3)).collect()}
    for parity in (0, 1):
        assert [len({names[i] for i in range(600) if i % 2 == parity and i % 3 == k}) for k in range(3)] == [1, 1, 1]
    assert mixing.topics_of(["", None, "!!"], ["en", None, "xx"], mixing.train_topics([], [])) == ["none"] * 3


@pytest.fixture(scope="module")
def many(spark):
    """2,600 documents, more than topics were once fitted to, one of them longer than was once read, and a language of 40."""
    r = rng(9)
    rows = []
    for i in range(2600):
        lang = "xx" if i % 65 == 0 else "en" if i % 2 else "fr"
        own = [f"{lang}{(i % 3) * 40 + int(x)}" for x in r.integers(0, 60, int(r.integers(20, 40)))]
        rows.append((i, " ".join(own), f"s{i % 4}", None if i % 400 == 7 else lang))
    rows[1] = (1, " ".join(f"late{i % 700}" for i in range(9000)), "s1", "en")
    rows[4] = (4, " !! ", "s1", "fr")
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4).cache()


def test_topics_are_fitted_to_all_documents(spark, many):
    rows = many.withColumn("h", F.xxhash64("doc_id", "text")).collect()
    want = mixing.train_topics([r.text for r in rows], [r.lang for r in rows], keys=[r.h for r in rows])
    for df in (many, many.repartition(7, "text")):
        got = mixing.fit_topics(df)
        assert got.tables.keys() == want.tables.keys() == {None, "en", "fr"}
        assert all(np.array_equal(got.tables[x], want.tables[x]) for x in want.tables)
    # every document of a language counts: words of the long text alone, and of each document left out
    late = int(mixing.Words(["late5"]).hash[0]) % (1 << mixing.BITS)
    assert want.tables["en"][late].any()
    less = mixing.fit_topics(many.where("doc_id <> 2599"))
    assert not np.array_equal(less.tables["en"], want.tables["en"]) and np.array_equal(less.tables["fr"], want.tables["fr"])


def test_sums_of_all_tasks_reach_the_driver_as_one(spark):
    r, sc = rng(3), spark.sparkContext
    rows = [(i, " ".join(f"w{x}" for x in r.integers(0, 30_000, 2000)), "en") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sc.setLocalProperty("spark.jobGroup.id", "sums")
    try:
        mixing.fit_topics(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("sums") for s in status.getJobInfo(j).stageIds}
    # of two groups, all and en, six sums each; every stage took up to four tasks
    sent = max(sc._jsc.sc().statusStore().lastStageAttempt(s).resultSize() for s in stages)
    one = 2 * mixing.TOPICS * (8 << mixing.BITS)
    assert 0.5 * one < sent < 1.2 * one, sent / one


def test_mix_uses_topics_of_all_documents(spark, many):
    topics = mixing.fit_topics(many)
    one, two = ({r.doc_id: (r.topic, r.tokens, r.rate, r.kept) for r in mixing.mixed(many, PATH, topics=t).collect()} for t in (None, topics))
    assert one == two and one[4][0] == "none"
    assert {r.doc_id for r in mixing.sample(many, PATH).collect()} == {i for i, r in one.items() if r[3]}


def test_vectors_count_the_words_of_whole_texts():
    texts = ["b a b", None, "", "x " * 3, " ".join(f"w{i % 5000}" for i in range(500_000)), "a"]
    n, bucket, count = mixing.vectors(texts)
    ends = np.cumsum(n)
    for t, hi, m in zip(texts, ends, n, strict=True):
        want = np.bincount([int(h) % (1 << mixing.BITS) for h in mixing.Words([t]).hash], minlength=1 << mixing.BITS)
        got = np.zeros(1 << mixing.BITS, np.int64)
        got[bucket[hi - m : hi]] = count[hi - m : hi]
        assert np.array_equal(got, want)
    assert mixing._entries(mixing._binary(n, bucket).slice(3, 2), "<u2")[0].tolist() == n[3:5].tolist()
    assert np.array_equal(mixing._entries(mixing._binary(n, count).slice(3), "<u4")[1], count[n[:3].sum() :])


def test_rake_meets_all_marginals():
    r = np.random.default_rng(1)
    base = r.integers(50, 100, 60).astype(float)
    keys = [np.arange(60) % 5, np.arange(60) % 3, np.arange(60) % 4]
    wants = [mixing.needs(np.bincount(k, base), r.uniform(1, 2, n), 0.4 * base.sum()) for k, n in zip(keys, (5, 3, 4), strict=True)]
    rate, worst = mixing.rake(base, keys, wants)
    assert worst < 1e-9 and rate.max() <= 1
    for k, w in zip(keys, wants, strict=True):
        assert np.allclose(np.bincount(k, base * rate), w, rtol=1e-6)


def test_needs_give_what_a_class_lacks_to_the_others():
    got = mixing.needs(np.array([10.0, 100.0, 1000.0, 0.0]), np.array([1.0, 1.0, 2.0, 5.0]), 410.0)
    assert np.allclose(got, [10, 100, 300, 0])
    assert np.allclose(mixing.needs(np.array([10.0, 5.0]), np.array([1.0, 0.0]), 10.0), [10, 0])


def test_rates_meet_the_marginals_and_the_budget(spark):
    df = docs(spark)
    rows = mixing.mixed(df, PATH, targets={"lang": {"en": 0.7, "fr": 0.3}}).collect()
    expected = sum(r.rate * r.tokens for r in rows)
    assert abs(expected / (0.5 * sum(r.tokens for r in rows)) - 1) < 1e-6 and all(0 <= r.rate <= 1 for r in rows)
    assert abs(sum(r.rate * r.tokens for r in rows if r.lang == "en") / expected - 0.7) < 1e-6
    again = {r.doc_id: r.kept for r in mixing.mixed(df.repartition(5), PATH, targets={"lang": {"en": 0.7, "fr": 0.3}}).collect()}
    assert again == {r.doc_id: r.kept for r in rows} and 0 < sum(again.values()) < 600


def test_table_form_is_the_driver_form(spark):
    """Very many cells are raked by the same rule: default rounds, budgets that clip, targets, classes left out."""
    df = spark.createDataFrame([("a", "x", 900), ("a", "y", 300), ("b", "x", 310), ("b", "y", 110), (None, "z", 0), ("c", "z", 40)], "source string, lang string, tokens long")
    both = ["source", "lang"]
    for dims, more in (
        (["lang"], {}), (["lang"], {"budget": 1500.0}), (["source"], {"targets": {"source": {"c": 0.5, "b": 0.2}}, "share": 0.3}), (both, {"rounds": 5}),
        (both, {"targets": {"lang": {"x": 1.0, "q": 0.5}}, "rounds": 3}), (both, {"targets": {"lang": {"x": 0.6, "z": 0.1}}, "rounds": 3, "budget": 1500.0}),
    ):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            driver, table = ({tuple(r[d] for d in dims): r.rate for r in mixing.cell_rates(df, dims, driver_cells=n, **more).collect()} for n in (100, 0))
        assert driver.keys() == table.keys() and max(abs(driver[k] - table[k]) for k in driver) < 1e-8, more
        assert max(driver.values()) <= 1 and driver.get((None, "z"), 1) == 1


def test_contradicting_marginals_are_reported(spark):
    df = spark.createDataFrame([("a", "x", 100), ("b", "y", 100)], "source string, lang string, tokens long")
    for n in (100, 0):
        with pytest.warns(UserWarning, match="not settled"):
            mixing.cell_rates(df, ["source", "lang"], targets={"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.2, "y": 0.8}}, driver_cells=n, rounds=3).collect()


def test_sample_keeps_rows_and_targets(spark):
    df = clash(docs(spark))
    kept = {r.doc_id for r in mixing.mixed(df, PATH).collect() if r.kept}
    s = mixing.sample(df, PATH)
    got = s.collect()
    assert s.columns == df.columns and {r.doc_id for r in got} == kept and all(r.rate == r["topic"] == r["tokens"] == 1 for r in got)
    only = mixing.mixed(df, PATH, targets={"lang": {"en": 1.0}}).where("kept").select("lang").distinct().collect()
    assert [r.lang for r in only] == ["en"]
    few = mixing.mixed(df, PATH, budget=500.0).agg(F.sum(F.col("rate") * F.col("tokens"))).first()[0]
    assert abs(few - 500) < 1


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, None), (None, "", "a", "en"), (2, " \n ", "a", "en"), (2, "x y", "a", "en"), (2, "x y", "a", "en")], "doc_id long, text string, source string, lang string")
    got = mixing.mixed(df, PATH, share=1.0).collect()
    assert sorted(r.tokens for r in got) == [0, 0, 2, 2, 3] and all(r.rate == 1 for r in got)
    assert mixing.mixed(df.limit(0), PATH).count() == 0 and mixing.sample(df.limit(0), PATH).count() == 0
    assert mixing.sample(df.where("doc_id = 1"), PATH).count() == 1
    with pytest.raises(TypeError):
        mixing.sample(df.withColumn("doc_id", F.lit("x")), PATH)
