import datetime as dt

import pytest
from pyspark.sql import functions as F

from termloom.functions.lexicon import Lexicon
from termloom.operators import agents, batches, context, decide, dictionary, export, generic, glossary, scoring, store, terms, translation


def col(spark, values, name="term", kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def test_aggregate_takes_the_longest_text_first_of_equals(spark):
    df = spark.createDataFrame([("a", 1, "xx", 2), ("a", 1, "yy", 1), ("b", 1, None, 3), ("a", 1, "z", 0)], "term string, frequency int, original_text string, source_row long")
    got = {r.term: (r.frequency, r.original_text, r.source_row) for r in terms.aggregate(df).collect()}
    assert got == {"a": (3, "yy", 0), "b": (1, None, 3)}


def test_row_terms_needs_a_column(spark):
    with pytest.raises(ValueError):
        terms.row_terms(col(spark, ["x"]), ["none"], [], "term")


def test_pending_and_completed_make_up_required(spark):
    required, done = col(spark, ["a", "b", "c"]), col(spark, ["b", "z"])
    assert sorted(r.term for r in terms.missing(required, done).collect()) == ["a", "c"]


@pytest.mark.parametrize(("hit", "want"), [(8, 2), (10, 0), (9, 1)])
def test_resolve_overlap(spark, hit, want):
    rest = col(spark, [f"t{i}" for i in range(10)])
    assert terms.resolve_overlap(rest, col(spark, [f"t{i}" for i in range(hit)])).count() == want


@pytest.mark.parametrize(
    ("term", "votes", "penalty", "protection", "is_generic"),
    [
        ("extrude command", 0, 0.0, "Contains domain root 'extrude'", False), ("new bolt", 2, -0.07, None, True), ("click", 2, -0.07, None, True),
    ],
)
def test_generic(spark, term, votes, penalty, protection, is_generic):
    r = col(spark, [term]).select(generic.detect(F.col("term"), F.array().cast("array<string>")).alias("g")).first().g
    assert (r.votes, r.penalty, r.protection, r.is_generic) == (votes, penalty, protection, is_generic)


def test_generic_feature_pair(spark):
    r = col(spark, ["loft feature"]).select(generic.detect(F.col("term"), F.array().cast("array<string>")).alias("g")).first().g
    assert (r.m2, r.m5, r.penalty) == (False, True, -0.015)


@pytest.mark.parametrize(("score", "term", "want"), [(0.47, "bolt", "conditionally_approved"), (0.47, "two words", "conditionally_approved"), (0.50, "bolt", "conditionally_approved"), (0.50, "two words", "approved"), (0.1, "bolt", "rejected")])
def test_decision(spark, score, term, want):
    assert col(spark, [term]).select(decide.decision(F.lit(score), F.lit(None).cast("string"), F.col("term")).alias("s")).first().s == want


def test_decision_grows_with_score(spark):
    order = ["rejected", "needs_review", "conditionally_approved", "approved"]
    df = spark.range(101).select((F.col("id") / 100).alias("s")).select("s", decide.decision(F.col("s"), F.lit("APPROVE"), F.lit("bolt")).alias("d")).orderBy("s")
    got = [order.index(r.d) for r in df.collect()]
    assert got == sorted(got)


@pytest.mark.parametrize(("score", "want"), [(0.85, "Exceptional"), (0.549, "Standard Quality"), (0.25, "Below Standard"), (0.2499, "Poor Quality")])
def test_quality_tier(spark, score, want):
    assert spark.range(1).select(decide.quality_tier(F.lit(score)).alias("t")).first().t == want


def test_translatability_of_a_version(spark):
    r = col(spark, ["v1.2.dwg"]).select(decide.translatability(F.col("term"), F.lit(0.0), F.lit(0.5), F.lit(0.9)).alias("x")).first().x
    assert r.indicators == ["contains_numbers", "contains_special_chars", "contains_dot", "file_extension", "version_pattern"]
    assert (r.category, r.has_technical_value, r.action) == ("UNTRANSLATABLE", True, "APPROVE_AS_NEW_TERM")


def test_product_names_are_a_parameter(spark):
    lex = Lexicon(product_names=("examplecad",))
    df = col(spark, ["ExampleCAD tool"])
    assert df.select(scoring.pattern_adjustment(F.col("term")).alias("x")).first().x == 0.0
    assert df.select(scoring.pattern_adjustment(F.col("term"), lex).alias("x")).first().x == 0.15


def test_scores_stay_within_bounds(spark):
    df = spark.range(200).select(F.concat(F.lit("t"), F.repeat(F.lit("w "), F.col("id").cast("int") % 40)).alias("term"), F.col("id").alias("f"))
    q = scoring.quality_score(F.col("term"), F.col("f"), F.col("f") / 100, F.col("f") % 2 == 0, F.col("f") % 30)
    lo, hi = df.select(q.alias("q")).agg(F.min("q"), F.max("q")).first()
    assert 0 <= lo <= hi <= 1


def test_compat_quality(spark):
    df = col(spark, ["bolt head"])
    args = (F.col("term"), F.lit(0), F.lit(0.5), F.lit(True))
    default, compat = (df.select(scoring.quality_score(*args, F.lit(10), compat=c).alias("q")).first().q for c in (False, True))
    assert default - compat == pytest.approx(0.135, abs=2e-3)


@pytest.mark.parametrize(("word", "method", "found"), [("abcabcx", "repeating_pattern", False), ("baaad", "consecutive_letters", False), ("a b", "non_alphabetic", False), ("x", "too_short", False), ("the", "common_word", True), ("json", "technical_term", True), ("q" + "zx" * 13, "too_long", False)])
def test_classify(spark, word, method, found):
    r = col(spark, [word]).select(dictionary.classify(F.col("term")).alias("c")).first().c
    assert (r.method, r.in_dictionary) == (method, found)


def test_summary_and_verification(spark):
    df = spark.createDataFrame([("bolt", "de", "Bolzen"), ("bolt", "fr", "Bolt"), ("bolt", "es", "ERROR: x"), ("ab", "de", "abcdefghijk"), ("ab", "fr", " "), ("ab", "es", "ok")], "term string, language string, translation string")
    s = {r.term: r for r in translation.summary(df).collect()}["bolt"]
    assert (s.same_languages, s.translated_languages, s.error_languages, s.translatability_score) == (1, 1, 1, 0.5)
    v = {r.term: r for r in translation.verified(df).collect()}["ab"]
    assert (v.verified_languages, v.verification_issues_count, v.verification_passed) == (["de", "es"], 2, False)


def test_expansion_and_tiers(spark):
    r = spark.range(1).select(F.size(translation.expansion(F.lit(0.99), F.array(F.lit("eng_Latn")))).alias("n"), translation.tier(F.lit("general"), F.lit(0.9)).alias("t"), F.size(translation.tier_languages(F.lit("extended"))).alias("k")).first()
    assert (r.n, r.t, r.k) == (20, "extended", 83)


def test_missing_ranges_and_refill(spark):
    b = col(spark, [1, 2, 5, 6, 9], "batch_id", "long")
    missing = batches.missing_numbers(b)
    assert sorted(r.batch_id for r in missing.collect()) == [3, 4, 7, 8]
    assert sorted(r.label for r in batches.ranges(missing).collect()) == ["3-4", "7-8"]
    rows = spark.range(20).withColumnRenamed("id", "k")
    assert sorted(r.k for r in batches.refill(rows, "k", 5, col(spark, [2], "batch_id", "long")).collect()) == [5, 6, 7, 8, 9]


ARR = "term string, source_file string, contexts array<string>, pos_tags array<string>, metadata string, seen_at timestamp, seq long"


def arrivals(spark, rows):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(term, f"f{i}", [f"c{i}"], ["NN"], None, t + dt.timedelta(days=i), i) for i, term in rows], ARR)


def test_store_promotes_at_two_and_then_stays(spark):
    all_at_once = store.upsert(store.empty(spark), arrivals(spark, [(0, "Bolt"), (1, "bolt"), (2, "BOLT"), (3, "nut")]))
    got = {r.term: r for r in all_at_once.collect()}
    assert (got["Bolt"].occurrence_count, got["Bolt"].status, got["Bolt"].source_files, got["Bolt"].original_contexts) == (2, "promoted", ["f0", "f1"], ["c0", "c1"])
    assert (got["nut"].occurrence_count, got["nut"].status) == (1, "stored")
    step = store.empty(spark)
    for i, t in [(0, "Bolt"), (1, "bolt"), (2, "BOLT"), (3, "nut")]:
        step = store.upsert(step, arrivals(spark, [(i, t)]))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(step) == key(all_at_once)
    acc = store.accepted(store.empty(spark), arrivals(spark, [(0, "Bolt"), (1, "bolt"), (2, "BOLT")])).orderBy("seq").collect()
    assert [r.accepted for r in acc] == [True, True, False]


def test_store_mark_search_cleanup(spark):
    s = store.upsert(store.empty(spark), arrivals(spark, [(0, "bolt"), (1, "bolt"), (2, "nut")]))
    assert [r.term for r in store.ready(s).collect()] == ["bolt"]
    marked = store.mark_processed(s, col(spark, ["BOLT"]))
    assert store.search(marked, status="processed").count() == 1 and store.ready(marked).count() == 0
    as_of = F.lit(dt.datetime(2024, 6, 1))
    assert [r.term for r in store.cleanup(s, as_of).collect()] == ["bolt"]
    stats = {(r.measure, r.key): r.n for r in store.statistics(s, F.lit(dt.datetime(2024, 1, 3, 1))).collect()}
    assert stats[("total_terms", None)] == 2 and stats[("by_status", "promoted")] == 1 and stats[("recent_activity", None)] == 1


def test_cache(spark):
    t = dt.datetime(2024, 1, 1)
    cache = spark.createDataFrame([("k", "old", t)], "cache_key string, result string, created_at timestamp")
    new = spark.createDataFrame([("k", "new", t + dt.timedelta(days=40))], cache.schema)
    assert [r.result for r in store.cache_put(cache, new).collect()] == ["new"]
    assert store.cache_expire(cache, F.lit(t + dt.timedelta(days=31))).count() == 0
    assert store.cached(cache, spark.createDataFrame([("k",)], "cache_key string"), F.lit(t + dt.timedelta(days=5))).first().result == "old"


def g(spark):
    return spark.createDataFrame([("ENG-DEU", "bolt", "Bolzen", 1), ("ENG-DEU", "bolt head", "Kopf", 2), ("ENG-DEU", "new", "neu", 3), ("DNT", "newton", "newton", 4)], "pair string, source string, target string, load_order long")


def test_replace_longest_first_and_protect(spark):
    text = col(spark, ["new bolt head and bolt in newton", None, ""], "text")
    for size in (None, 1, 2):
        got = [r.replaced for r in glossary.replaced(text, g(spark), "ENG-DEU", size=size).collect()]
        assert got == ["neu Kopf and Bolzen in newton", None, ""]
    pairs = F.array(*(F.struct(F.lit(a).alias("source"), F.lit(b).alias("target")) for a, b in (("new", "neu"), ("bolt", "Bolzen"), ("bolt head", "Kopf"))))
    assert text.select(glossary.replace_terms(F.col("text"), pairs, F.array(F.lit("newton"))).alias("x")).first().x == "neu Kopf and Bolzen in newton"
    assert glossary.replaced(text, g(spark).limit(0), "ENG-DEU").where("replaced = text").count() == 2


def test_replacements_may_give_rise_to_later_ones(spark):
    """A target that holds a shorter source is replaced again, in one pass as in many."""
    rows = [("ENG-DEU", "aaa", "xbb", 1), ("ENG-DEU", "bb", "c", 2), ("ENG-DEU", "x", "y", 3)]
    own = spark.createDataFrame(rows, "pair string, source string, target string, load_order long")
    assert [glossary.replaced(col(spark, ["aaa"], "text"), own, "ENG-DEU", size=k).first().replaced for k in (1, 5)] == ["yc", "yc"]


def test_many_terms_by_grams(spark):
    """All lengths of terms, repeated texts and repeated terms, against Python."""
    import random

    r = random.Random(2)
    texts = ["".join(r.choices("abc ", k=r.randint(0, 30))) for _ in range(60)] + ["aaaa", "aaaa", None, ""]
    names = sorted({"".join(r.choices("abc", k=r.randint(1, 7))) for _ in range(60)})
    df, t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), col(spark, [*names, "", None], "source")
    want = sorted((i, n) for i, x in enumerate(texts) if x is not None for n in names if n in x)
    for limit in (0, 1000):
        assert sorted((x.doc_id, x.source) for x in glossary.contained(df, t, limit=limit).collect()) == want


def test_numbered_is_the_place_in_the_order(spark):
    import random

    keys = random.Random(3).sample(range(100_000), 3000)
    df = spark.createDataFrame([(k, f"k{k}") for k in keys], "k long, s string")
    assert [(r.k, r.rn) for r in batches.numbered(df, "k").orderBy("k").collect()] == [(k, i + 1) for i, k in enumerate(sorted(keys))]
    assert [(r.s, r.rn) for r in batches.numbered(df.repartition(7), "s").orderBy("rn").collect()] == [(k, i + 1) for i, k in enumerate(sorted(f"k{k}" for k in keys))]
    assert batches.numbered(df.limit(0), "k").count() == 0
    clash = spark.createDataFrame([(5, 1, 2), (3, 4, 5)], "part long, n long, before long")
    assert [tuple(r) for r in batches.numbered(clash, "part").orderBy("rn").collect()] == [(3, 4, 5, 1), (5, 1, 2, 2)]


def test_missing_numbers_of_wide_gaps(spark, monkeypatch):
    monkeypatch.setattr(batches, "GAP", 7)
    have = [3, 4, 9, 100, 100, None, 130]
    got = batches.missing_numbers(spark.createDataFrame([(x,) for x in have], "batch_id long"))
    assert sorted(r.batch_id for r in got.collect()) == [i for i in range(3, 131) if i not in have]


def test_recent_average_of_the_whole_table(spark):
    values = [(i, float(i * 7 % 11)) for i in range(100)]
    df = spark.createDataFrame(values, "at long, score double").repartition(5)
    got = {r["at"]: r.recent for r in translation.recent_average(df, "at", block=16).collect()}
    assert len(got) == 100 and all(got[i] == (None if i < 10 else round(sum(v for _, v in values[i - 10 : i]) / 10, 6)) for i in range(100))


def test_accepted_arrivals_of_a_hot_term(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, "Hot" if i % 2 else "hot", "f", [], [], None, t) for i in range(50)] + [(60, "cold", "f", [], [], None, t)]
    a = spark.createDataFrame(rows, "seq long, term string, source_file string, contexts array<string>, pos_tags array<string>, metadata string, seen_at timestamp")
    assert sorted(r.seq for r in store.accepted(store.empty(spark), a).where("accepted").collect()) == [0, 1, 60]
    assert store.accepted(store.empty(spark), a).count() == 51


def test_translation_insight_of_samples(spark):
    def of(*samples, n=60, score=0.9):
        x = scoring.translation_insight(F.lit(n), F.lit(50), F.lit(5), F.lit(5), F.lit(score), F.array(*(F.lit(s) for s in samples)).cast("array<string>"))
        return spark.range(1).select(x.alias("x")).first().x

    assert "highly consistent" in of("a", "a").notes and "consistent" in of(*"aaaabaaa").notes and not {"consistent", "highly consistent"} & set(of("a", "b", "c").notes)
    assert of("a").contribution == round(0.9 * 0.2 + round(55 / 60 * 0.4 + 0.36 + 0.2, 3) * 0.1 + 0.05, 6) and of(n=0, score=0.0).contribution == 0


def test_gram_join_equals_nested_loop(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["new bolt head", "newton", "", "xx newt bol", None])], "doc_id long, text string")
    sources = g(spark).select("source").union(col(spark, ["bo", "ewt"], "source"))
    key = lambda df: sorted((r.doc_id, r.source) for r in df.collect())
    assert key(glossary.contained_by_grams(texts, sources)) == key(glossary.contained(texts, sources)) != []


def test_default_glossary_only_where_missing(spark):
    assert glossary.with_default(g(spark)).where("pair = 'EN-CS'").count() == 12
    have = g(spark).withColumn("pair", F.lit("EN-CS"))
    assert glossary.with_default(have).where("pair = 'EN-CS'").count() == 4


def test_header(spark):
    df = col(spark, ["source,target", "﻿source,target\r", "Source,Target"], "line")
    assert [r.ok for r in df.select(glossary.header_ok(F.col("line")).alias("ok")).collect()] == [True, True, False]


def test_describe(spark):
    df = spark.createDataFrame([([], "CONDITIONALLY_APPROVED"), (["use the command to edit objects"], "APPROVED"), (["plain words that say nothing at all"], "APPROVED")], "t array<string>, d string")
    got = [r.x for r in df.select(context.describe(F.col("t"), F.col("d")).alias("x")).collect()]
    assert got == [context.CONDITIONAL, "Command used in CAD software to edit objects or elements", "plain words that say nothing at all"]


def test_export_and_report(spark):
    d = spark.createDataFrame([("Beta", "APPROVED", "approved", 0.6, ["x; y"]), ("alpha", "CONDITIONALLY_APPROVED", "conditionally_approved", 0.4, None), ("no", "REJECTED", "rejected", 0.1, None)], "term string, decision string, status string, final_score double, texts array<string>")
    assert [r.source for r in export.approved_export(d).collect()] == ["alpha", "Beta"]
    assert "| approved | 1 | 33.3 |" in export.report(d)
    a = export.audit(d, {"out": "x"}, {"k": "v"}, F.lit(dt.datetime(2024, 1, 1))).first()
    assert a.statistics.total_decisions == 3 and a.files == {"out": "x"} and all(a.steps.values())


def test_fallback_decisions(spark):
    df = spark.range(150).select(F.concat(F.lit("t"), "id").alias("term"), F.col("id").alias("index"))
    assert decide.fallback_decisions(df).count() == 100 and decide.empty_decisions(df).count() == 0


def test_error_classes(spark):
    df = col(spark, ["Access token expired", "HTTP 503", "blocked by content_filter", "mismatch: closing tag", "fine"], "m")
    assert [r.c for r in df.select(glossary.error_class(F.col("m")).alias("c")).collect()] == ["token_expired", "server", "content_filter", "xml", None]


def test_agent_calls(spark):
    words = col(spark, ["run", "color"], "word")
    own = spark.createDataFrame([("ENG-DEU", "bolt", "Bolzen", 1), ("ENG-DEU", "bolt head", "Kopf", 2), ("DNT", "newton", "newton", 4)], "pair string, source string, target string, load_order long")
    a = agents.Terminology(own, words)
    assert {(r.term, r.kind, r.translation) for r in a.text_terms(["a bolt of newton"], "english", "german").collect()} == {("bolt", "glossary", "Bolzen"), ("newton", "dnt", "newton")}
    assert [r.replaced for r in a.translate(["bolt head, newton bolt"], "english", "german").collect()] == ["Kopf, newton Bolzen"]
    assert a.text_terms(["a bolt"], "en", "xx").count() == 0 and [r.replaced for r in a.translate(["a bolt"], "en", "xx").collect()] == ["a bolt"]
    assert {r.pair: r.n_terms for r in a.overview().collect()} == {"ENG-DEU": 2, "DNT": 1}
    assert a.related(["bolt"]).first().duplicates == 1
    assert a.lookup("runs").first().method == "nltk_variation" and {r.term: r.in_dictionary for r in a.lookup(["color", "qqzz"]).collect()} == {"color": True, "qqzz": False}


def test_lemmas_come_before_suffixes(spark):
    words, lemmas = col(spark, ["go", "run", "went"], "word"), spark.createDataFrame([("gone", "go"), ("ran", "run"), ("went", "go"), ("runs", "Run")], "word string, lemma string")
    got = {r.term: (r.method, r.found_as) for r in dictionary.classify_terms(col(spark, ["gone", "ran", "went", "runs", "qqzz"], "term"), words, lemmas=lemmas).collect()}
    assert got == {"gone": ("nltk_variation", "go"), "ran": ("nltk_variation", "run"), "went": ("nltk_direct", None), "runs": ("nltk_variation", "run"), "qqzz": ("nltk_not_found", None)}
