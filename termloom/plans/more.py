"""Further registered queries: reasons, insights, texts for export, cleaning of results, marks and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import decide, export, glossary, scoring, store, translation
from . import fixtures as X
from .pipeline import decided
from .queries import (
    ANSWERS, CTX_BASE, CTX_SCORE, DECIDE, DECISIONS, GENERIC, ISSUE, JOINED, KIND, N_CTX, PENALTIES, PENALTY, QUALITY, RATES, STORE_SQL, TIER, TRANSLATABLE, _any, _contexts, _count, _decisions, _store, _terms,
    _translations, query,
)

_PERCENT = "printf('%.1f', round({0} * 100, 1)) || '%'"
_USAGE = "list_filter([" + ", ".join(f"CASE WHEN {_any('x', w)} THEN '{k}' END" for k, w in L.USAGE.items()) + "], lambda u: u IS NOT NULL)"
_REASONS = f"""list_filter([
  CASE WHEN category <> 'UNTRANSLATABLE' THEN 'Translatable: ' || category WHEN tech THEN 'New term candidate: untranslatable but of technical value' ELSE 'Untranslatable without technical value' END,
  'Translation coverage: ' || {_PERCENT.format("coverage")} || ' - ' || CASE WHEN coverage >= 0.9 THEN 'Excellent' WHEN coverage >= 0.7 THEN 'Good' ELSE 'Poor' END,
  CASE WHEN same > 0.8 THEN 'Universal technical term: ' || {_PERCENT.format("same")} || ' unchanged' WHEN same > 0.3 THEN 'Partially universal: ' || {_PERCENT.format("same")} || ' unchanged' END,
  CASE WHEN len(ind) > 0 THEN 'Technical indicators: ' || array_to_string(ind[1:3], ', ') END, CASE WHEN len(ind) >= 3 THEN 'Several technical patterns' END,
  'Recommendation: ' || action, 'Quality score: ' || printf('%.3f', ml),
  CASE WHEN frequency % 9 > 0 THEN 'Translated: ' || (frequency % 4) || '/' || (frequency % 9) || ' languages' END,
  CASE WHEN iss = 0 AND ver > 0 THEN 'Verification: passed' WHEN iss = 0 AND ver = 0 THEN 'Verification: skipped' ELSE 'Verification: failed (' || iss || ' issues)' END,
  CASE WHEN len(usage) > 0 THEN 'Usage: ' || array_to_string(usage, ', ') END], lambda r: r IS NOT NULL)"""


@query(f"""
{DECISIONS}, u AS (SELECT *, {_USAGE} AS usage FROM (SELECT *, lower(array_to_string(contexts, ' ')) AS x FROM dd) AS a), r AS (SELECT *, {_REASONS} AS reasons FROM u)
SELECT term, array_to_string(reasons, ' | ') AS reasons, 'Term ''' || term || ''' (' || CASE WHEN n = 1 THEN 'single-word' ELSE 'multi-word' END || ') scored ' || CAST(CAST(round(CAST(final_score AS DECIMAL(10, 6)), 3) AS DECIMAL(10, 3)) AS VARCHAR) || ': ' || upper(status) || '. '
 || array_to_string(reasons[1:2], '; ') || '. Quality tier: ' || quality_tier || '.' AS reason_text FROM r
""")
def decision_reasons(spark, d):
    """What speaks for and against each decided term, and the sentence that sums it up."""
    t, f = _decisions(spark, d), F.col("frequency")
    n_issues, n_verified = f % 13, f % 12
    why = decide.reasons(F.col("tr"), F.col("coverage"), F.col("same"), F.col("score"), f % 4, f % 9, (n_issues == 0) & (n_verified > 0), n_issues, n_verified, scoring.usage_patterns(F.col("contexts")))
    t = t.withColumn("reasons", why)
    return t.select("term", F.array_join("reasons", " | ").alias("reasons"), decide.reason_text(F.col("term"), F.col("final_score"), F.col("status"), F.col("reasons")).alias("reason_text"))


@query(f"{DECISIONS} SELECT term, status, CAST(row_number() OVER (ORDER BY term) AS BIGINT) AS place FROM dd")
def decisions_by_term(spark, d):
    """Decisions with their place in the order of the terms."""
    from ..operators import batches

    return batches.numbered(decide.by_term(_decisions(spark, d)).select("term", "status"), "term", "place")


@query(f"""
WITH t AS (SELECT *, {KIND} AS kind FROM ({X.TRANSLATIONS}) AS x),
s AS (SELECT term, count(*) AS total, count(*) FILTER (WHERE kind = 'same') AS same, count(*) FILTER (WHERE kind = 'translated') AS translated, count(*) FILTER (WHERE kind = 'error') AS errors,
  (list(translation ORDER BY language) FILTER (WHERE kind = 'translated'))[1:5] AS samples FROM t GROUP BY term),
q AS (SELECT *, round(CASE WHEN same + translated > 0 THEN translated / (same + translated) ELSE 0.0 END, 6) AS score, coalesce(len(list_distinct(samples)), 0) AS kinds FROM s),
c AS (SELECT *, round((translated + same) / total * 0.4 + score * 0.4, 3) AS confidence FROM q)
SELECT term, confidence, CASE WHEN score >= 0.8 THEN 'Excellent' WHEN score >= 0.6 THEN 'Good' WHEN score >= 0.4 THEN 'Fair' ELSE 'Limited' END AS label,
 concat_ws('; ', CASE WHEN score > 0.8 THEN 'high translatability' WHEN score > 0.5 THEN 'moderate translatability' ELSE 'low translatability' END, CASE WHEN same > translated THEN 'often unchanged' END,
  CASE WHEN errors = 0 THEN 'no errors' WHEN errors / total > 0.2 THEN 'translation challenges' END, CASE WHEN kinds = 1 THEN 'highly consistent' WHEN kinds > 0 AND kinds / len(samples) < 0.3 THEN 'consistent' END) AS notes,
 round(round(score, 3) * 0.2 + confidence * 0.1, 6) AS contribution FROM c
""")
def translation_insight(spark, d):
    """Confidence, label, notes and the contribution to the review score of each term's translations."""
    s = translation.summary(_translations(spark, d))
    samples = F.transform(F.slice("translated_language_codes", 1, 5), lambda c: F.try_element_at(F.col("all_translations"), c))
    x = scoring.translation_insight(F.col("total_languages"), F.col("translated_languages"), F.col("same_languages"), F.col("error_languages"), F.col("translatability_score"), samples)
    return s.select("term", x.alias("x")).select("term", "x.confidence", "x.label", F.array_join("x.notes", "; ").alias("notes"), "x.contribution")


@query(f"""
WITH t AS (SELECT *, {KIND} AS kind FROM ({X.TRANSLATIONS}) AS x), r AS (SELECT term, language, translation, row_number() OVER (PARTITION BY term ORDER BY language) AS k FROM t WHERE kind = 'translated')
SELECT n.term, coalesce(string_agg(language || '=' || translation, '|' ORDER BY language) FILTER (WHERE k <= 5), '') AS samples FROM (SELECT DISTINCT term FROM t) AS n LEFT JOIN r ON r.term = n.term GROUP BY n.term
""")
def translation_samples(spark, d):
    """The first five translations of each term."""
    return translation.summary(_translations(spark, d)).select("term", F.array_join("sample_translations", "|").alias("samples"))


@query(f"SELECT CAST(row_number() OVER (ORDER BY term, language) AS BIGINT) AS index, term, language, {ISSUE} AS issue FROM ({X.TRANSLATIONS}) AS x")
def verified_in_order(spark, d):
    """Every translation's issue with its place in the original order."""
    from ..operators import batches

    rows = _translations(spark, d).withColumn("key", F.concat_ws("\x01", "term", "language"))
    rows = batches.numbered(rows, "key", "index").drop("key")
    return translation.by_index(rows.select("index", "term", "language", translation.issue(F.col("term"), F.col("translation")).alias("issue")))


@query(f"WITH a AS ({ANSWERS}) SELECT conv_id, turn, NOT ({_any('lower(answer)', glossary.NOT_FOUND_BATCH)} OR (contains(lower(answer), 'error') AND contains(lower(answer), 'failed'))) AS known FROM a")
def answers_of_batches(spark, d):
    """Whether each answer of a batch worker says that the term is known."""
    return X.fixture(spark, d, ANSWERS).select("conv_id", "turn", glossary.answer_found_batch(F.col("answer")).alias("known"))


RESULTS = "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Search failed: ' ELSE '' END || CASE WHEN page_id % 4 = 0 THEN ' short ' ELSE html END AS result, page_id % 5 AS related FROM {pages}"
_CLEANED = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g'), '\[[^\]]*\]', '', 'g'), '[<>\[\]]', '', 'g'), '\s+', ' ', 'g'), '^\s+', ''), '\s+$', '')"""


@query(rf"""
WITH r AS ({RESULTS}), w AS (SELECT *, NOT {_any("lower(result)", L.WEB_FAILURES)} AND length(regexp_replace(regexp_replace(result, '^\s+', ''), '\s+$', '')) > 50 AS ok FROM r)
SELECT page_id, ok, related > 3 OR ok AS worth FROM w
""")
def web_results(spark, d):
    """Search results without a failure, and review results worth saving."""
    r = X.fixture(spark, d, RESULTS).withColumn("ok", scoring.web_ok(F.col("result")))
    return r.select("page_id", "ok", scoring.worth_saving(F.lit(0.0), F.greatest(F.col("related") - 3, F.lit(0)), F.lit(0), F.col("ok"), F.lit(0.0)).alias("worth"))


@query(f"SELECT page_id, {_CLEANED.format('url')} AS url, {_CLEANED.format('html')} AS html FROM pages")
def result_clean(spark, d):
    """The text values of a result, cleaned."""
    both = F.create_map(F.lit("url"), F.col("url"), F.lit("html"), F.col("html"))
    return X.table(spark, d, "pages").select("page_id", T.result_clean(both).alias("r")).select("page_id", F.col("r")["url"].alias("url"), F.col("r")["html"].alias("html"))


STORED = "SELECT p_brand AS term, p_partkey AS source_row, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE concat(p_name, '; ', p_type, ';  ; ', p_name) END AS original_text FROM {part}"


@query(f"""
WITH c AS ({STORED}), l AS (SELECT term, arg_max(original_text, source_row) AS t FROM c WHERE original_text <> '' GROUP BY term), n AS (SELECT DISTINCT p_brand AS term FROM part UNION SELECT DISTINCT p_type FROM part)
SELECT n.term, array_to_string(list_filter(list_transform(string_split(t, '; '), lambda x: trim(x)), lambda x: x <> ''), '|') AS texts FROM n LEFT JOIN l ON l.term = n.term
""")
def export_texts(spark, d):
    """The texts of each term's last row, from the first source that has any."""
    part = X.table(spark, d, "part")
    decided = part.select(F.col("p_brand").alias("term")).union(part.select("p_type")).distinct()
    combined = X.fixture(spark, d, STORED)
    return export.with_texts(decided, export.last_texts(combined.limit(0)), export.last_texts(combined)).select("term", F.array_join("texts", "|").alias("texts"))


@query(f"""
WITH c AS (SELECT term, frequency, list_transform(range(0, CAST(frequency % 14 AS BIGINT)), lambda i: term || ' ' || repeat('w ', CAST(i * 12 AS BIGINT)) || i) AS t FROM ({X.TERMS}) AS x), n AS (SELECT *, len(t) AS n FROM c),
p AS (SELECT term, CASE WHEN n > 10 THEN [t[1], t[2], t[n // 3 + 1], t[n // 2 + 1], t[n - 2], t[n - 1], t[n]] WHEN n >= 6 THEN t[1:5] ELSE t END AS t FROM n)
SELECT term, array_to_string(list_transform(t, lambda v: CASE WHEN length(v) > 150 THEN left(v, 150) || '...' ELSE v END), '|') AS sample FROM p
""")
def prompt_sample(spark, d):
    """A few of each term's texts for a prompt."""
    n = (F.col("frequency") % 14).cast("int")
    texts = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.concat(F.col("term"), F.lit(" "), F.repeat(F.lit("w "), i * 12), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    return _terms(spark, d).select("term", F.array_join(T.prompt_sample(texts), "|").alias("sample"))


@query(f"SELECT term, round(greatest(0.1::DOUBLE, least(0.4::DOUBLE, length(term) / 20.0::DOUBLE)), 6) AS score FROM ({X.TERMS}) AS t")
def unreadable_review(spark, d):
    """The score of terms whose review gave no readable answer."""
    return _terms(spark, d).select("term", scoring.enhanced_fallback_score(F.col("term")).alias("score"))


@query(f"{STORE_SQL} SELECT term, CASE WHEN term LIKE '%1' THEN 'processed' WHEN promoted THEN 'promoted' ELSE 'stored' END AS status FROM s")
def store_marked(spark, d):
    """The store after some terms were marked as processed."""
    s = _store(spark, d)
    return store.mark_processed(s, s.where(F.col("term").endswith("1")).select("term")).select("term", "status")


@query(f"{STORE_SQL} SELECT term, CAST(occurrence_count AS BIGINT) AS occurrence_count FROM s WHERE promoted AND NOT term LIKE '%1'")
def store_ready(spark, d):
    """Promoted terms that wait to be processed."""
    s = _store(spark, d)
    return store.ready(store.mark_processed(s, s.where(F.col("term").endswith("1")).select("term"))).select("term", "occurrence_count")


@query(f"WITH s AS ({X.CONTEXTS}) SELECT count(*) FILTER (WHERE len(contexts) > 0) AS with_contexts, count(*) FILTER (WHERE len(contexts) = 0) AS without_contexts, round(avg(frequency), 6) AS average_frequency, max(frequency) AS max_frequency, min(frequency) AS min_frequency FROM s")
def convert_statistics(spark, d):
    """Counts and frequencies of converted terms."""
    from ..sources import readers

    return readers.simple_statistics(_contexts(spark, d))


# The parts of a decision from the operators themselves, not from made-up rates.
_RATES = f"""
s AS (SELECT term, count(*) AS total, count(*) FILTER (WHERE kind = 'same') AS sm, count(*) FILTER (WHERE kind = 'translated') AS tl, count(*) FILTER (WHERE kind <> 'error') AS ok,
  count(issue) AS iss, count(*) FILTER (WHERE issue IS NULL OR issue = 'suspicious_length') AS ver FROM (SELECT *, {KIND} AS kind, {ISSUE} AS issue FROM ({X.TRANSLATIONS}) AS x) AS t GROUP BY term),
rates AS (SELECT c.term, c.frequency, c.contexts, round(CASE WHEN ok > 0 THEN tl / ok ELSE 0.0 END, 6)::DOUBLE AS score, tl / total AS coverage, sm / total AS same, iss, ver FROM ({X.CONTEXTS}) AS c JOIN s ON s.term = c.term)"""
_QUALITY_OF = rf"""SELECT term, round(CASE WHEN {N_CTX} = 0 THEN 0.0 ELSE least(1.0::DOUBLE, (least(1.0::DOUBLE, list_sum(list_transform(contexts, lambda c: length(c))) / {N_CTX} / 100::DOUBLE) + len(list_distinct(w)) / greatest(1, len(w))) / 2) END, 6) AS cq,
  round(CASE WHEN {N_CTX} = 0 THEN 0.1 ELSE least(1.0::DOUBLE, ((length(x) - length(replace(x, lower(term), ''))) / greatest(1, length(term)) + {_count("x", L.RICHNESS)}) / 10::DOUBLE) END, 6) AS cr
  FROM (SELECT term, contexts, {JOINED} AS x, list_filter(string_split_regex({JOINED}, '\s+'), lambda w: w <> '') AS w FROM ({X.CONTEXTS}) AS t) AS u"""
_SUM = """round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, quality * 0.25 + rel * 0.2
 + CASE category WHEN 'UNTRANSLATABLE' THEN CASE WHEN tech AND same > 0.8 THEN 0.08 WHEN tech THEN 0.06 ELSE -0.05 END WHEN 'PARTIALLY_TRANSLATABLE' THEN CASE WHEN coverage >= 0.3 THEN 0.04 ELSE -0.02 END ELSE 0.08 END::DOUBLE
 - least(0.05::DOUBLE, len(ind) * 0.01::DOUBLE)
 + CASE WHEN coverage >= 0.95 THEN 0.15 WHEN coverage >= 0.85 THEN 0.12 WHEN coverage >= 0.70 THEN 0.09 WHEN coverage >= 0.50 THEN 0.06 WHEN coverage >= 0.30 THEN 0.03 ELSE 0.0 END::DOUBLE
 + CASE WHEN iss = 0 THEN CASE WHEN ver >= 10 THEN 0.10 WHEN ver >= 5 THEN 0.09 ELSE 0.08 END WHEN iss <= 2 THEN -0.01 WHEN iss <= 5 THEN -0.03 ELSE -least(0.08::DOUBLE, iss * 0.015::DOUBLE) END::DOUBLE
 + cq * 0.08 + cr * 0.07 + 0.02 + penalty)), 6)"""


@query(f"""
WITH {_RATES}, {TRANSLATABLE.replace(RATES, "SELECT * FROM rates")},
rev AS (WITH c AS ({CTX_BASE}) SELECT term, {CTX_SCORE} AS rel FROM c),
qual AS ({PENALTIES}, r AS (SELECT p.*, rev.rel FROM p JOIN rev ON rev.term = p.term) SELECT term, rel, n, {QUALITY} AS quality FROM r),
gen AS ({GENERIC} SELECT term, {PENALTY} AS penalty FROM g), ctx AS ({_QUALITY_OF}),
f AS (SELECT tr.*, qual.n, qual.rel, qual.quality, gen.penalty, {_SUM} AS final_score FROM tr JOIN qual ON qual.term = tr.term JOIN gen ON gen.term = tr.term JOIN ctx ON ctx.term = tr.term)
SELECT term, category, action, final_score, {DECIDE} AS status, {TIER} AS quality_tier FROM f
""")
def composed_decisions(spark, d):
    """Step 7 as the plan runs it: reviews, genericness, translations and verification of the operators joined, scored and decided."""
    rows = _translations(spark, d)
    t = decided(_contexts(spark, d).withColumn("in_dictionary", F.lit(None).cast("boolean")), translation.summary(rows), translation.verified(rows), L.DEFAULT)
    return t.select("term", "category", "action", "final_score", "status", "quality_tier")


# Codes and pairs over table columns.
def _base(x: str) -> str:
    """The normal form of a language code, in SQL."""
    rules = [(f"lower({x}) IN ({', '.join(repr(n) for n in names)})", f"'{code}'") for code, names in L.LANGUAGE_CODES.items()]
    rules += [(f"starts_with({x}, 'CORE_') AND contains({x}, '_TERMS')", f"replace(replace({x}, 'CORE_', ''), '_TERMS', '')"), (f"contains(lower({x}), '-') AND lower({x}) <> 'zh-tw'", f"split_part(lower({x}), '-', 1)")]
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE upper({x}) END"


CODES = """SELECT DISTINCT code FROM (SELECT lang AS code FROM {documents} UNION ALL SELECT upper(lang) FROM {documents} UNION ALL SELECT concat(lang, '-', upper(source)) FROM {documents}
  UNION ALL SELECT concat('CORE_', upper(lang), '_TERMS') FROM {documents} UNION ALL SELECT n_name FROM {nation} UNION ALL SELECT substr(lower(n_name), 1, 2) FROM {nation} UNION ALL SELECT substr(n_name, 1, 3) FROM {nation}) AS c"""


@query(f"SELECT code, {_base('code')} AS base, CASE lower(code) {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in L.TRANSLATOR_CODES.items())} END AS translator FROM ({CODES}) AS c")
def lang_codes(spark, d):
    """Codes of documents and nations in normal form, and as the translator names them."""
    return X.fixture(spark, d, CODES).select("code", T.language(F.col("code")).alias("base"), T.translator_code(F.lower("code")).alias("translator"))


PAIRS = "SELECT DISTINCT s.code AS src, t.code AS tgt FROM (SELECT lang AS code FROM {documents} UNION ALL SELECT 'eng' UNION ALL SELECT 'English') AS s, (SELECT lang AS code FROM {documents} UNION ALL SELECT 'french' UNION ALL SELECT 'csy') AS t"


def _pairs(spark, d):
    """The rows of PAIRS; each side's codes are made distinct before they are paired, as pairs of documents grow with their square."""
    langs = X.table(spark, d, "documents").select(F.col("lang").alias("code")).distinct()
    side = lambda names: langs.union(spark.createDataFrame([(n,) for n in names], "code string")).distinct()
    return side(["eng", "English"]).select(F.col("code").alias("src")).crossJoin(side(["french", "csy"]).select(F.col("code").alias("tgt")))


@query(f"""
WITH r AS ({PAIRS}), g AS (SELECT DISTINCT pair FROM ({X.GLOSSARY}) AS g),
c AS (SELECT src, tgt, unnest([1, 2, 3, 4]) AS i, unnest([upper(src) || '-' || upper(tgt), lower(src) || '-' || lower(tgt), {_base("src")} || '-' || {_base("tgt")}, CASE WHEN upper(src) IN ('EN', 'ENG') THEN 'ENG-CSY' END]) AS pair FROM r)
SELECT src, tgt, arg_min(c.pair, i) AS pair FROM c JOIN g ON g.pair = c.pair GROUP BY src, tgt
""")
def glossary_pairs(spark, d):
    """The glossary of each pair of the documents' languages, and of some names."""
    from .queries import _glossary

    return glossary.resolve_pairs(_pairs(spark, d), _glossary(spark, d))


SPECS = "SELECT DISTINCT o_custkey % 60 AS k, concat(CAST(o_custkey % 60 AS VARCHAR(9)), '-', CAST(o_custkey % 60 + o_custkey % 3 AS VARCHAR(9)), ', ', CAST(o_custkey % 60 + 7 AS VARCHAR(9)), ',x,', CAST(o_custkey % 60 AS VARCHAR(9))) AS spec FROM {orders}"


@query(f"WITH s AS ({SPECS}) SELECT spec, CAST(n AS BIGINT) AS n FROM (SELECT spec, unnest(range(k, k + k % 3 + 1)) AS n FROM s UNION SELECT spec, k + 7 FROM s) AS u")
def batch_specs(spark, d):
    """The batches that written lists of numbers and ranges name."""
    return X.fixture(spark, d, SPECS).select("spec", F.explode(T.batch_numbers(F.col("spec"))).alias("n"))
