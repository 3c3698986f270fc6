from pyspark.sql import functions as F

from termloom.operators import providers
from termloom.plans import curation, pipeline


def test_nine_steps_and_resume(spark, tmp_path):
    rows = [("mesh toolpath", 1, "A mesh toolpath is a path of the machine tool over the part.", i) for i in range(3)] + [("click", 1, "click the button", 5), ("click", 1, "click", 6), ("rare thing", 1, "x", 7), ("newton", 1, "n", 8)]
    combined = spark.createDataFrame(rows, "term string, frequency int, original_text string, source_row long")
    g = spark.createDataFrame([("DNT", "newton", "newton", 1), ("deu_Latn", "click", "klicken", 2)], "pair string, source string, target string, load_order long")
    words = spark.createDataFrame([("click",)], "word string")
    languages = spark.createDataFrame([("deu_Latn",), ("fra_Latn",)], "language string")
    inputs = pipeline.Inputs(combined, g, words, languages)
    out = pipeline.run(spark, inputs, str(tmp_path))
    decisions = {r.term: r for r in spark.read.parquet(f"{tmp_path}/7_decisions").collect()}
    assert set(decisions) == {"mesh toolpath", "click"} and all(0 <= r.final_score <= 1 for r in decisions.values())
    assert decisions["mesh toolpath"].final_score > decisions["click"].final_score
    assert {r.source for r in out.collect()} == {t for t, r in decisions.items() if "APPROVED" in r.decision}
    again = pipeline.run(spark, pipeline.Inputs(combined.limit(0), g, words, languages), str(tmp_path))
    assert again.count() == out.count()


def test_a_term_seen_once_in_each_of_two_runs_goes_on(spark, tmp_path):
    combined = spark.createDataFrame([("rare thing", 1, "a rare thing", 1), ("mesh", 2, "a mesh", 2)], "term string, frequency int, original_text string, source_row long")
    g = spark.createDataFrame([("DNT", "newton", "newton", 1)], "pair string, source string, target string, load_order long")
    words, languages = spark.createDataFrame([("click",)], "word string"), spark.createDataFrame([("deu_Latn",)], "language string")
    found, known = [], None
    for run in ("first", "second", "third"):
        out = f"{tmp_path}/{run}"
        pipeline.run(spark, pipeline.Inputs(combined, g, words, languages, store=known), out)
        found.append({r.term for r in spark.read.parquet(f"{out}/7_decisions").collect()})
        known = spark.read.parquet(f"{out}/41_store")
    assert found == [{"mesh"}, {"mesh", "rare thing"}, {"mesh", "rare thing"}]
    r = spark.read.parquet(f"{tmp_path}/second/7_decisions").where("term = 'rare thing'").first()
    assert r.reasons[0].startswith(("Translatable", "Untranslatable", "New term")) and "'rare thing' (multi-word)" in r.reason_text


def test_curation_of_documents(spark):
    docs = spark.createDataFrame([(1, "bolt Bolt the mesh"), (2, "bolt mesh, 42 !!"), (3, None)], "doc_id long, text string")
    assert {r.term: r.frequency for r in curation.curate(docs).collect()} == {"bolt": 2, "mesh": 2}


def test_provider_retries_and_falls_back(spark):
    def make():
        calls = []

        def model(texts):
            calls.append(1)
            if len(calls) == 1:
                raise RuntimeError("first call fails")
            return [t.upper() for t in texts]

        return model

    def broken():
        def model(texts):
            raise RuntimeError("always")

        return model

    df = spark.createDataFrame([("a",), ("b",)], "term string").coalesce(1)
    up = providers.with_provider(df, "x", providers.batched(make, pause=0.01), "term", F.lit("none"))
    assert sorted(r.x for r in up.collect()) == ["A", "B"]
    down = providers.with_provider(df, "x", providers.batched(broken, attempts=2, pause=0.01), "term", F.concat(F.lit("fallback "), F.col("term")))
    assert sorted(r.x for r in down.collect()) == ["fallback a", "fallback b"]
    empty = F.array().cast("array<string>")
    assert df.select(providers.accepted_description(F.lit("short"), empty, F.lit("APPROVED")).alias("d")).first().d.startswith("Technical term")
