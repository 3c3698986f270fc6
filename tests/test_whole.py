"""The whole-text and whole-table queries see what lies behind a prefix or outside an id subset."""

import pytest

from termloom.plans import more, queries
from termloom.plans import fixtures as X

PAD = "filler words " * 60


@pytest.fixture
def tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, PAD + "lastterm bolt"), (2, PAD + "lastterm bolt"), (3, PAD + "lastterm bolt")], "doc_id long, text string")
    labels = spark.createDataFrame([(2,)], "doc_id long")
    monkeypatch.setattr(X, "table", lambda s, d, name: {"documents": docs, "labels": labels}[name])


def test_terms_behind_the_prefix(spark, tables):
    run = lambda name: queries.QUERIES[name](spark, "").collect()
    assert all(r.term.endswith("lastterm bolt") for r in run("clean_term"))
    assert {r.source_row for r in run("parse_term_field_split") if "lastterm" in r.term} == {1, 2, 3}
    assert {(r.term, r.origin) for r in run("merge_new")} == {(2, "old"), (1, "new"), (3, "new")}


def test_replacements_behind_the_prefix(spark, tables, monkeypatch):
    g = spark.createDataFrame([("ENG-DEU", "bolt", "Bolzen", 1), ("DNT", "that", "that", 2)], "pair string, source string, target string, load_order long")
    monkeypatch.setattr(queries, "_glossary", lambda s, d: g)
    assert all(r.replaced.endswith("lastterm Bolzen") for r in queries.QUERIES["replace_terms"](spark, "").collect())


def test_answers_and_contexts_cover_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = {r.term: r.n_texts for r in queries.QUERIES["cleaned_context"](spark, sf).collect()}
    names = {r.p_name for r in X.table(spark, sf, "part").select("p_name").distinct().collect()}
    assert all(n[x] > 0 for x in names) and any(not n[x] for x in n.keys() - names)
    few = queries.terms.with_contexts(queries._terms(spark, sf), X.fixture(spark, sf, queries.CLEANED), keep=3).collect()
    assert all(len(r.contexts) == min(3, r.n_texts) for r in few) and max(r.n_texts for r in few) > 3
    assert queries.QUERIES["answer_classes"](spark, sf).count() == X.table(spark, sf, "conversations").count()
    assert "left(" not in queries.ANSWERS + queries.AGG_INPUT + queries.TERM_FIELD + queries._REPLACED


def test_pairs_of_codes_not_of_documents(spark, monkeypatch):
    docs = spark.createDataFrame([("en",), ("de",), (None,), ("fr",)], "lang string")
    docs = docs.crossJoin(spark.range(30_000)).select("lang")
    monkeypatch.setattr(X, "table", lambda s, d, name: docs)
    plan = more.glossary_pairs(spark, "")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Join Cross" in line or "Join Inner, " not in line and "Join Inner" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    sides = [line for line in plan[at + 1 :] if depth(line) == depth(plan[at]) + 3][:2]
    assert len(sides) == 2 and all("Aggregate" in s for s in sides), plan
    got = more._pairs(spark, "").collect()
    few = docs.distinct()
    monkeypatch.setattr(X, "table", lambda s, d, name: few)
    assert sorted(map(str, got)) == sorted(map(str, X.fixture(spark, "", more.PAIRS).collect())) and len(got) == 36
    assert {(r.src, r.tgt): r.pair for r in more.glossary_pairs(spark, "").collect()}[("en", "de")] == "EN-DE"
