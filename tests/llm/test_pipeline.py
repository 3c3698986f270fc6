"""The pipeline against its stages in plain Python, and the registered queries against SQL."""

import glob
import os
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from termloom.llm import _spark, mixing, quality, toxicity
from termloom.llm import queries as q
from termloom.llm._components import components

from .helpers import clash, near, sha

SF = "/root/testdata/sf0.001"


def test_mixing_stage_fits_topics_to_all_documents(spark):
    """More documents than topics were once fitted to, and one longer than was once read."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i % 3) * 9 + (i * j) % 17}" for j in range(9)) if i else "late word " * 9000, f"s{i % 3}", ("en", "fr")[i % 2]) for i in range(2300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    keys = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text) as h").collect()}
    model = mixing.train_topics([r[1] for r in rows], [r[3] for r in rows], keys=[keys[r[0]] for r in rows])
    assert model.tables["en"][int(mixing.Words(["late"]).hash[0]) % (1 << mixing.BITS)].any()
    want = {r.doc_id for r in mixing.mixed(docs, q.BYTE_BPE, topics=model, targets=q.TARGETS).where("kept").collect()}
    assert {r.doc_id for r in cp.mix_sources(spark, docs, SF).collect()} == want and 0 < len(want) < 2300


def test_pipeline_equals_its_stages(spark):
    docs = q.table(spark, SF, "documents")
    labels = q.table(spark, SF, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    ids = sorted(rows)
    scores = toxicity.score([rows[i].text for i in ids], toxicity.Model(model.bucket, model.bias))
    ids = [i for i, s in zip(ids, scores, strict=True) if s < toxicity.THRESHOLD]
    kept = docs.where(docs.doc_id.isin(ids))
    _, tails = quality.predict([rows[i].text for i in ids], quality.fit(kept, labels))
    ids = [i for i, t in zip(ids, tails[:, -1], strict=True) if t >= 0.5]
    comp = near(ids, [rows[i].text for i in ids])
    ids = [i for i in ids if comp[i] == i]
    drawn = {r.doc_id for r in mixing.mixed(docs.where(docs.doc_id.isin(ids)), q.BYTE_BPE, targets=q.TARGETS).where("kept").collect()}
    library = Tokenizer.from_file(q.WORD_BPE)
    want = {}
    for i in drawn:
        t = library.encode(rows[i].text, add_special_tokens=False).ids
        want[i] = (len(t), sha(" ".join(map(str, t))))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in cp.run(spark, SF).collect()}
    assert got == want and len(got) > 10


def test_classifiers_are_not_trained_on_the_driver(spark, monkeypatch):
    docs, labels = q.table(spark, SF, "documents"), q.table(spark, SF, "labels")
    want = toxicity.train(*toxicity.labelled_sample(docs, labels, "toxic", [0, 1], toxicity.SAMPLE))
    grades = [r[0] for r in labels.where("quality is not null").select("quality").distinct().orderBy("quality").collect()]
    graded = quality.train(*toxicity.labelled_sample(docs, labels, "quality", grades, quality.SAMPLE), grades)

    def refused(*args, **how):
        raise AssertionError("texts are read on the driver")

    monkeypatch.setattr(toxicity, "_vocabulary", refused)
    monkeypatch.setattr(quality, "features", refused)
    got = toxicity.fit(docs, labels)
    assert np.allclose(got.bucket, want.bucket, atol=1e-5) and np.isclose(got.bias, want.bias) and got.bucket.any()
    got = quality.fit(docs, labels)
    assert np.allclose(got.weights, graded.weights) and np.allclose(got.thresholds, graded.thresholds) and got.weights.any()


def test_few_edges_take_few_tasks(spark):
    """Rounds over 47 edges in 64 partitions took thousands of tasks, of which the driver keeps account."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc, status = spark.sparkContext, spark.sparkContext.statusTracker()
    edges = spark.range(48).selectExpr("id as a", "case when id % 12 > 0 then id - 1 end as b").repartition(64)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few edges", "")
        found = {r.id: r.component for r in components(edges).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {i: i - i % 12 for i in range(48)}
    infos = [status.getStageInfo(i) for i in {s for j in status.getJobIdsForGroup("few edges") for s in status.getJobInfo(j).stageIds}]
    assert 100 < sum(x.numCompletedTasks for x in infos if x) < 700


def test_driver_gives_freed_memory_back(spark, monkeypatch):
    """What the JVM frees outside its heap stayed with the C library, and added up from stage to stage."""
    jvm, given, give_back = spark._jvm, [], _spark.give_back
    rollup = Path(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup")
    mb = lambda: int(re.search(r"\nPss_Anon:\s+(\d+)", rollup.read_text())[1]) / 1024

    def measured(session):  # the heap may grow during a checkpoint, so only this step is weighed
        before = mb()
        give_back(session)
        given.append(before - mb())

    monkeypatch.setattr(_spark, "give_back", measured)
    _spark.cut(spark.range(9))
    held = [jvm.java.util.zip.Deflater() for _ in range(600)]
    for i, x in enumerate(held):
        if i % 20:
            x.end()
    _spark.cut(spark.range(9))
    for x in held[::20]:
        x.end()
    assert len(given) == 2 and given[1] > 50, given


def test_stages_return_the_columns_of_documents(spark):
    docs = q.table(spark, SF, "documents")
    assert 4 <= len(cp.STAGES) <= 5
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_take_nulls_repeats_and_clashing_names(spark):
    docs = q.table(spark, SF, "documents")
    odd = docs.limit(40).union(docs.limit(40)).union(docs.limit(3).selectExpr("null", "null", "null", "null", "null")).union(docs.limit(5).selectExpr("null", "text", "lang", "source", "n_chars"))
    odd = clash(odd.union(docs.limit(2).selectExpr("doc_id", "''", "lang", "source", "n_chars")))
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.schema.names == odd.columns and all(r.topic == 1 for r in out.collect())
    left = cp.drop_near_duplicates(spark, odd, SF).where("text <> ''").collect()
    assert len({r.text for r in left}) == len(left) and all(r.doc_id is not None for r in left)
    assert cp.drop_near_duplicates(spark, odd, SF).where("text is null or text = ''").count() == 5
    assert cp.encode(spark, odd, SF).count() == odd.count()


def test_run_leaves_one_stage_table(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file:")
    before = set(glob.glob(f"{base}/termloom/pipeline-*/*"))
    cp.run(spark, SF).count()
    assert [os.path.basename(p) for p in set(glob.glob(f"{base}/termloom/pipeline-*/*")) - before] == ["mixing"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    res = duck.execute(q.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    key = lambda cols, data: sorted(str([r[i] for i in sorted(range(len(cols)), key=lambda i: cols[i])]) for r in data)
    assert key(df.columns, [tuple(r) for r in df.collect()]) == key(names, res.fetchall())


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES if n.startswith("op")) == list(range(1, 11))
