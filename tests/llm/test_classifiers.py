import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import quality, toxicity
from termloom.llm._text import Words, runs

from .helpers import clash, peak_mb, rng, words


def corpus(n, seed, bad=("idiot", "moron", "scumbag")):
    r = rng(seed)
    base = ["".join(r.choice(list("abcdeorst"), r.integers(2, 8))) for _ in range(400)]
    texts, y = [], []
    for i in range(n):
        w = list(r.choice(base, r.integers(5, 200)))
        if i % 3 == 0:
            for b in r.choice(bad, 3):
                w.insert(int(r.integers(0, len(w))), b)
        texts.append(" ".join(w))
        y.append(int(i % 3 == 0))
    return texts, np.array(y)


def test_misspellings_share_the_vectors_of_what_they_resemble():
    texts, y = corpus(300, 1)
    m = toxicity.train(texts, y)
    assert toxicity.score(["aa bb idiot cc", "aa bb idiott cc", "aa bb moronn cc"], m).min() > 0.5
    assert toxicity.score(["aa bb store cc"], m)[0] < 0.5
    other, want = corpus(200, 2)
    assert ((toxicity.score(other, m) >= 0.5) == want).mean() > 0.95
    assert m.embeddings.shape[1] == 8 and m.weights.shape == (8, 2)


def test_score_of_a_word_equals_the_embedding_average():
    texts, y = corpus(60, 3)
    m = toxicity.train(texts, y, epochs=10)
    z = toxicity.word_logits(toxicity._marked(["idiot xy"]), m.bucket)
    delta = m.weights[:, 1] - m.weights[:, 0]
    words = toxicity._marked(["idiot xy"])
    gram, per = toxicity._grams(words, np.arange(2))
    for i, part in enumerate(np.split(gram, np.cumsum(per)[:-1])):
        assert np.isclose(m.embeddings[part].mean(0) @ delta, z[i], atol=1e-4)


ALL = np.arange(256) != 10


def buckets(word, plus=b" "):
    """Hash buckets of a word's character n-grams, marked at its ends, and of the word, one by one."""
    marked = plus + word + plus
    grams = [marked[i : i + n] for n in toxicity.SIZES for i in range(len(marked) - n + 1)]
    return [int(Words([g], inside=ALL).hash[0]) % (1 << toxicity.BITS) for g in [word, *grams]]


def plain_score(text, model):
    """The score of a text from the model's embeddings and softmax, word by word."""
    vectors = [np.mean([model.embeddings[b] for b in buckets(w)], axis=0) for w in words(text)]
    windows = [np.mean(vectors[i : i + 2], axis=0) for i in range(max(1, len(vectors) - 1))] if vectors else []
    delta = model.weights[:, 1] - model.weights[:, 0]
    share = np.exp([v @ delta - max(w @ delta for w in windows) for v in windows])
    mean = sum(s * v for s, v in zip(share / share.sum(), windows, strict=True)) if len(windows) else np.zeros(len(delta))
    return 1 / (1 + np.exp(-(mean @ delta + model.bias)))


def test_scores_equal_the_plain_form():
    texts, y = corpus(120, 6)
    m = toxicity.train(texts, y, epochs=20)
    some = [*texts[:6], "", None, "!!", "x", "Idiot", "ünï çödé idiiot", "a" * 1500 + " b"]
    for got, t in zip(toxicity.score(some, m), some, strict=True):
        assert abs(got - plain_score(t, m)) < 1e-4


def test_training_follows_the_gradient():
    """One step moves each parameter against the slope of the loss, taken by differences."""
    texts, y = corpus(30, 8)
    before = toxicity.train(texts, y, epochs=1, rate=0.0)
    after = toxicity.train(texts, y, epochs=1, rate=1e-3)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(w):
        m = toxicity.Model((before.embeddings @ (w[:, 1] - w[:, 0])).astype(np.float64), before.bias, before.embeddings, w)
        p = toxicity.score(texts, m)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    for i in range(3):
        for j in range(2):
            step = np.zeros_like(before.weights)
            step[i, j] = 1e-4
            slope = (loss(before.weights + step) - loss(before.weights - step)) / 2e-4
            assert np.sign(before.weights[i, j] - after.weights[i, j]) == np.sign(slope)


def plain_quality(text, model):
    """(expected grade, tails) of a text, token by token."""
    import re

    tokens = re.findall(rb"[^\t-\r ]+", (text or "").encode())
    tokens = [t[i : i + 1024] for t in tokens for i in range(0, len(t), 1024)]
    mask, total, before, seen = (1 << quality.BITS) - 1, 0.0, 0, set()
    hashed = lambda b: int(Words([b], inside=ALL).hash[0])
    mixed = lambda x: int(quality.mix(np.array([x % (1 << 64)], np.uint64))[0])
    for k, t in enumerate(tokens):
        shape = re.sub(rb"[0-9]", b"9", re.sub(rb"[a-z\x80-\xff]", b"a", re.sub(rb"[A-Z]", b"A", t)))
        form = hashed(re.sub(rb"(.)\1+", rb"\1", shape, flags=re.S))
        same = k > 0 and tokens[k - 1] == t
        for f in (hashed(t), mixed(form + 1), mixed(mixed(before + 2) + form), mixed(int(same) + 3), mixed(int(t in seen) + 7)):
            total += model.weights[f & mask]
        before = form
        seen.add(t)
    f = total / max(1, len(tokens))
    below = [0.0, *(1 / (1 + np.exp(-(c - f))) for c in model.thresholds), 1.0]
    return sum(g * (b - a) for g, a, b in zip(model.grades, below[:-1], below[1:], strict=True)), [1 - b for b in below[1:-1]]


def test_quality_equals_the_plain_form():
    m = quality.Model(rng(3).normal(0, 1, 1 << quality.BITS), np.array([-0.3, 0.2, 0.9]), [0, 1, 2, 5])
    some = ["Some text, some Text 12 12 12 a", "", None, " \n", "x", "AAA!! AAA!! bbb", "é" * 1500 + " é", "a b a b c"]
    expected, tails = quality.predict(some, m)
    for i, t in enumerate(some):
        e, tail = plain_quality(t, m)
        assert abs(expected[i] - e) < 1e-9 and np.allclose(tails[i], tail)


def test_long_texts_are_scored_as_in_one_piece(monkeypatch):
    r = rng(11)
    text = " ".join("".join(r.choice(list("abcdéf!A9"), r.integers(1, 9))) for _ in range(30000))
    m, q = toxicity.Model(r.normal(0, 1, 1 << toxicity.BITS).astype(np.float32), -0.3), r.normal(0, 1, 1 << quality.BITS)
    whole = toxicity.score([text, "x y"], m), quality.scales([text, "x y x"], q)
    small = lambda texts, **how: runs(texts, limit=4096, **how)
    monkeypatch.setattr(toxicity, "runs", small)
    monkeypatch.setattr(quality, "runs", small)
    assert np.allclose(whole[0], toxicity.score([text, "x y"], m)) and np.allclose(whole[1], quality.scales([text, "x y x"], q))


def test_a_very_long_text_takes_bounded_memory():
    lines = "import numpy as np\nfrom termloom.llm import toxicity as t, quality as q\ntext = ' '.join(f'w{i % 90001}x{i % 7}' for i in range(2_500_000))"
    assert peak_mb("t.score([text], t.Model(np.zeros(1 << t.BITS, np.float32), 0.0))", lines) < 400
    assert peak_mb("q.scales([text], np.zeros(1 << q.BITS))", lines) < 400


def test_the_sample_is_cut_among_labels_with_a_document(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)] + [(401, None), (3, "text 3"), (None, "x")], "doc_id long, text string")
    labels = spark.range(100_400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic")).union(spark.createDataFrame([(None, 1)], "doc_id long, toxic int"))
    texts, y = toxicity.labelled_sample(docs, labels, "toxic", [0, 1], 200)
    want = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(int(t.split()[1]) for t in texts) == want and y.sum() == sum(i % 2 for i in want)
    few, _ = toxicity.labelled_sample(docs, labels, "toxic", [0, 1], 20)
    assert len(few) == 40


def test_ids_must_be_integers(spark):
    df = spark.createDataFrame([("x", "a")], "doc_id string, text string")
    for call in (lambda: toxicity.toxicity(df, toxicity.train([], [])), lambda: quality.quality(df, quality.train([], [], [0, 1]))):
        with pytest.raises(TypeError):
            call()


def test_long_texts_weigh_as_short_ones():
    texts, y = corpus(300, 4)
    m = toxicity.train(texts, y)
    clean = " ".join(t for t, k in zip(texts, y, strict=True) if not k)
    assert toxicity.score([clean[:50000] + " idiot moron " + clean[:50000]], m)[0] > 0.5


def test_toxicity_rows(spark):
    texts, y = corpus(200, 5)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "idiot"), (3, texts[3]), (900, None), (901, ""), (902, "!!")]
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = clash(spark.createDataFrame([(i, int(k)) for i, k in enumerate(y)] + [(None, 1), (5, None)], "doc_id long, toxic int"))
    model = toxicity.fit(docs.drop("score"), labels)
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows if i is not None}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    kept = toxicity.filter_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.7 for r in got)
    empty = toxicity.fit(docs.limit(0), labels.limit(0))
    assert toxicity.toxicity(docs.limit(0), empty).count() == 0
    assert toxicity.train(["a b"], np.array([1.0])).bias > 0


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    texts, _ = toxicity.labelled_sample(docs, labels, "toxic", [0, 1], 100)
    assert {int(t.split()[1]) for t in texts} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_ordinal_grades():
    r = rng(7)
    grade = r.integers(0, 5, 400)
    texts = [" ".join(["good"] * g + ["bad"] * (4 - g) + list(r.choice(["a", "b", "c"], 5))) for g in grade]
    m = quality.train(texts, grade, [0, 1, 2, 3, 4])
    assert (np.diff(m.thresholds) > 0).all()
    expected, tails = quality.predict(texts, m)
    assert np.corrcoef(expected, grade)[0, 1] > 0.97 and (np.diff(tails, axis=1) <= 1e-12).all()
    assert ((tails[:, 1] >= 0.5) == (grade >= 2)).mean() > 0.95


def test_quality_rows(spark):
    r = rng(8)
    good = [" ".join("".join(r.choice(list("abcde"), 4)) for _ in range(60)) for _ in range(80)]
    junk = ["SPAM!! " * 60 for _ in range(40)]
    rows = list(enumerate(good + junk)) + [(None, "a b"), (0, good[0]), (500, None), (501, "")]
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(120)] + [(7, None)], "doc_id long, quality int")
    m = quality.fit(docs, labels)
    got = {x.doc_id: x for x in quality.quality(docs, m).collect()}
    assert all(got[i].kept for i in range(80)) and not any(got[i].kept for i in range(80, 120))
    assert quality.filter_kept(docs, m).columns == docs.columns
    assert quality.quality(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0
    only = quality.train(["x"], np.array([1]), [0, 1])
    assert quality.predict(["y", ""], only)[1].min() > 0.9


def test_word_hashes_do_not_depend_on_place():
    a, b = Words(["xx abc yy"]), Words(["abc"])
    assert a.hash[1] == b.hash[0] and len(set(a.hash.tolist())) == 3


def test_rows_first_by_hash(spark):
    from termloom.llm._spark import first_by_hash

    df = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    got = [r.id for r in first_by_hash(df, "h", 50, "id")]
    want = sorted(df.collect(), key=lambda r: (r.h >> 11) & ((1 << 53) - 1))[:50]
    assert got == [r.id for r in want]
    same = spark.range(3000).select("id", F.xxhash64(F.lit(1)).alias("h"))
    assert [r.id for r in first_by_hash(same, "h", 5, "id")] == [0, 1, 2, 3, 4]
    assert first_by_hash(df.limit(0), "h", 5) == [] and len(first_by_hash(df.limit(3), "h", 5)) == 3
