import json

import pytest
from pyspark.sql import functions as F

from termloom.operators import store
from termloom.sources import readers, sinks
from termloom.streaming import store as streaming


def test_extraction_csv(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('Original_Text,Final_Curated_Terms,Final_Curated_Terms_Detailed\n"A text, with comma",aa|bb cc|7,"[{""term"": ""dd""}, {""term"": ""aa""}]"\n"Other",,\n')
    rows = readers.extraction(spark, str(p)).collect()
    assert sorted(r.term for r in rows) == ["aa", "bb cc", "dd"] and {r.original_text for r in rows} == {"A text, with comma"}
    bad = tmp_path / "bad.csv"
    bad.write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        readers.extraction(spark, str(bad))


def test_glossary_tree(spark, tmp_path):
    files = {
        "general/english-to-others/DEU.csv": "﻿source,target\nbolt,Bolzen\n empty ,\n", "general/english-to-others/ACAD/ACAD_CHT_terms.csv": "source,target\nline,xian\n",
        "general/others-to-english/ACAD_CHT-EN_terms.csv": "source,target\nxian,line\n", "ui-element/acc/acc-nor.csv": "source,target\nok,greit\n", "general/DNT.csv": "source,target\nName,Name\n",
        "general/index.csv": "file,source,target\na,b,c\n",
    }
    for name, text in files.items():
        f = tmp_path / "data" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text, encoding="utf-8")
    got = {(r.pair, r.source, r.target) for r in readers.glossary_tree(spark, str(tmp_path)).collect()}
    assert got == {("ENG-DEU", "bolt", "Bolzen"), ("ENG-CHT", "line", "xian"), ("ACAD_CHT-ENG", "xian", "line"), ("ACC-NOR", "ok", "greit"), ("DNT", "Name", "Name")}


@pytest.mark.parametrize("key", ["terms", "dictionary_terms", "non_dictionary_terms", None])
def test_term_json(spark, tmp_path, key):
    rows = [{"term": "bolt", "frequency": 3, "original_texts": {"texts": ["a", "b"]}}, {"term": "the", "frequency": 9}, {"x": 1}]
    p = tmp_path / "t.json"
    p.write_text(json.dumps({key: rows} if key else rows))
    assert sorted((r.term, r.frequency, len(r.contexts)) for r in readers.term_json(spark, str(p)).collect()) == [("bolt", 3, 2), ("the", 9, 0)]
    assert [r.term for r in readers.prioritised(spark, str(p)).collect()] == ["bolt"]


def test_simple_csv(spark):
    df = spark.createDataFrame([("bolt", "NN|VB", "one | two | [... 3 more texts]", "5", "7"), ("x", None, None, "0", "bad")], "Terms string, POS_Tags string, Sample_Texts string, Text_Count string, Frequency string")
    got = {r.term: r for r in readers.enriched_from_simple(df).collect()}
    assert got["bolt"].contexts == ["one", "two"] and got["bolt"].frequency == 7 and got["x"].frequency is None


def test_damaged_json_falls_back(spark, tmp_path):
    bad, good = tmp_path / "bad.json", tmp_path / "good.json"
    bad.write_text('[{"term": "a", "status": "completed"}, {"term": "b", "status": "compl')
    good.write_text('[{"term": "c", "status": "completed"}]')
    schema = "term string, status string"
    assert [r.term for r in readers.json_or_backup(spark, schema, str(bad), str(good)).collect()] == ["c"]
    assert [r.term for r in readers.json_or_backup(spark, schema, str(bad)).collect()] == ["a"]
    text = spark.createDataFrame([('x "total_terms": 5 ... "total_terms": 7, "completed_terms": 2',)], "t string")
    r = text.select(readers.salvage_counters(F.col("t")).alias("c")).first().c
    assert (r.total_terms, r.completed_terms, r.remaining_terms) == (7, 2, None)


def test_stage_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert sinks.stage(spark, f"{tmp_path}/manifest", 1, "collect", f"{tmp_path}/stage1", build).count() == 3
    assert len(calls) == 1


def test_batch_files(spark, tmp_path):
    from termloom.operators import batches

    batches.as_batch_files(spark.createDataFrame([(1, True), (1, False), (2, True)], "batch_id long, ok boolean"), f"{tmp_path}/b")
    per, total = sinks.consolidated(spark, f"{tmp_path}/b")
    assert sorted((r.batch_id, r.n, r.n_ok) for r in per.collect()) == [(1, 2, 1), (2, 1, 1)] and total.first().results == 3


def test_streaming_store_equals_batch(spark, tmp_path):
    schema = "term string, source_file string, contexts array<string>, pos_tags array<string>, metadata string, seen_at timestamp, seq long"
    src = tmp_path / "src"
    rows = spark.range(60).select(
        F.concat(F.lit("T"), (F.col("id") % 23).cast("string")).alias("term"), F.lit("f").alias("source_file"), F.array(F.col("id").cast("string")).alias("contexts"), F.array(F.lit("NN")).alias("pos_tags"),
        F.lit(None).cast("string").alias("metadata"), F.timestamp_seconds("id").alias("seen_at"), F.col("id").alias("seq"),
    )
    for i in range(3):
        rows.where(f"seq >= {20 * i} and seq < {20 * i + 20}").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = streaming.upsert_stream(stream, f"{tmp_path}/store", f"{tmp_path}/cp")
    q.awaitTermination(120)
    key = lambda df: sorted((r.term_id, r.occurrence_count, r.status, tuple(sorted(r.original_contexts))) for r in df.collect())
    assert streaming.wait(q, poll=0.1) == "finished"
    assert key(streaming.latest(spark, f"{tmp_path}/store")) == key(store.upsert(store.empty(spark), rows))
    # a part has at most the last two versions, and one term touches one part
    parts = list((tmp_path / "store").glob("bucket=*"))
    assert parts and all(len([v for v in p.iterdir() if v.is_dir()]) <= streaming.KEPT for p in parts)
    before = {v for p in parts for v in p.iterdir()}
    rows.where("seq = 0").withColumn("seq", F.lit(100).cast("long")).coalesce(1).write.mode("append").parquet(str(src))
    streaming.upsert_stream(stream, f"{tmp_path}/store", f"{tmp_path}/cp").awaitTermination(120)
    assert len({v for p in parts for v in p.iterdir()} - before) == 1
    assert streaming.latest(spark, f"{tmp_path}/store").count() == 23


def test_collector_keeps_each_term_once(spark, tmp_path):
    src = tmp_path / "r"
    for i in range(2):
        spark.createDataFrame([("a", "completed", 1), ("a", "completed", 0), (f"b{i}", "failed", 2), (f"c{i}", "completed", 3)], "term string, status string, seq long").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("term string, status string, seq long").option("maxFilesPerTrigger", 1).parquet(str(src))
    streaming.collect_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp", dead_letters=f"{tmp_path}/dead").awaitTermination(120)
    done = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.term for r in streaming.unprocessed(spark, f"{tmp_path}/dead", done).collect()) == ["b0", "b1"]
    assert sorted(r.term for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "c0", "c1"]


def test_store_import(spark, tmp_path):
    rows = [{"term": "bolt", "frequency": 1, "original_texts": {"texts": ["a"]}, "pos_tag_variations": {"tags": ["N"]}}, {"term": "the", "frequency": 9}, {"term": "", "frequency": 1}, {"term": "nut"}]
    (tmp_path / "t.json").write_text(json.dumps({"terms": rows}))
    (tmp_path / "t.csv").write_text("Terms,Frequency,Original Text\ngear,1,a gear\nmesh,2,x\nbolt,1,\n")
    (tmp_path / "bad.csv").write_text("x,y\n1,2\n")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    one = readers.store_import(spark, str(tmp_path / "t.json"), now, "source")
    two = readers.store_import(spark, str(tmp_path / "t.csv"), now)
    assert {(r.term, r.source_file, tuple(r.contexts), tuple(r.pos_tags)) for r in one.collect()} == {("bolt", "source", ("a",), ("N",)), ("nut", "source", (), ())}
    assert {(r.term, tuple(r.contexts)) for r in two.collect()} == {("gear", ("a gear",)), ("bolt", ())}
    kept = {r.term: (r.status, r.occurrence_count) for r in store.upsert(store.upsert(store.empty(spark), one), two).collect()}
    assert kept == {"bolt": ("promoted", 2), "nut": ("stored", 1), "gear": ("stored", 1)}
    for bad in ("bad.csv", "t.txt"):
        with pytest.raises(ValueError):
            readers.store_import(spark, str(tmp_path / bad), now)


def test_store_export_has_statistics(spark, tmp_path):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    arrivals = store.arrivals_of(spark.createDataFrame([("bolt", 1, ["a"], ["N"])], "term string, frequency long, contexts array<string>, pos_tags array<string>"), "s", now)
    sinks.store_json(store.upsert(store.empty(spark), arrivals), str(tmp_path / "out"), now)
    assert spark.read.json(str(tmp_path / "out" / "terms")).first().term == "bolt"
    assert {r.measure: r.n for r in spark.read.json(str(tmp_path / "out" / "statistics")).collect()}["total_terms"] == 1


def test_step_json_and_split(spark, tmp_path):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "term string, in_dictionary boolean")
    sinks.step_json(df, str(tmp_path / "step"), step=3, note="x")
    assert spark.read.json(str(tmp_path / "step" / "rows")).count() == 3 and spark.read.json(str(tmp_path / "step" / "metadata")).first().asDict() == {"step": 3, "note": "x", "rows": 3}
    sinks.by_dictionary(df, str(tmp_path / "split"))
    assert {r.term for r in spark.read.json(str(tmp_path / "split" / "in_dictionary=false")).collect()} == {"b", "c"}


def test_pending_terms(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"term": "bolt"}, {"term": "nut"}]))
    done = spark.createDataFrame([("nut",)], "term string")
    assert [r.term for r in readers.pending(spark, done, str(tmp_path / "none.json"), str(tmp_path / "t.json")).collect()] == ["bolt"]
    with pytest.raises(FileNotFoundError):
        readers.pending(spark, done, str(tmp_path / "none.json"))


def test_wait_sees_a_stalled_stream(spark):
    q = spark.readStream.format("rate").load().writeStream.format("noop").trigger(processingTime="1 hour").start()
    try:
        assert streaming.wait(q, stalled=3, poll=0.2) == "stalled"
        assert streaming.wait(q, limit=0.5, poll=0.2) == "timeout"
    finally:
        q.stop()


def test_glossary_rows_of_other_than_two_columns(spark, tmp_path):
    (tmp_path / "DEU.csv").write_text('source,target\nbolt,Bolzen\nnut\ngear,Rad,x\n a ,\n"q ""x""",y\n')
    got = {r.source: (r.target, r.two_columns) for r in readers.glossary_rows(spark, str(tmp_path)).collect()}
    assert got == {"bolt": ("Bolzen", True), "nut": (None, False), "gear": ("Rad", False), " a ": ("", True), 'q "x"': ("y", True)}
    from termloom.operators import glossary

    flags = {r.source: r for r in glossary.content_issues(readers.glossary_rows(spark, str(tmp_path))).collect()}
    assert flags[" a "].space_source and flags[" a "].empty_target and flags['q "x"'].quote_source and not flags["bolt"].space_source


def test_batch_files_with_counters(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "c", True)], "batch_id long, term string, ok boolean")
    sinks.batch_json(df, str(tmp_path), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert {(r.batch_id, r.n, r.n_ok, r.n_failed, r.success_rate) for r in spark.read.json(f"{tmp_path}/metadata").collect()} == {(1, 2, 1, 1, 50.0), (2, 1, 1, 0, 100.0)}
    per, totals = sinks.consolidated(spark, f"{tmp_path}/rows")
    assert per.count() == 2 and totals.first().successes == 2
