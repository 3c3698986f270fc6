"""Registered queries: each operator on the driver's tables, with the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import batches, context, decide, dictionary, export, generic, glossary, scoring, store, terms, translation
from . import fixtures as X
from .curation import curate, document_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name; whole numbers come back as 64 bits."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c.name: F.col(c.name).cast("long") for c in df.schema if isinstance(c.dataType, Ty.IntegerType)})

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = X.other(sql)
        return f

    return add


# SQL pieces -----------------------------------------------------------------------------------
def _in(x: str, words) -> str:
    return f"{x} IN ({', '.join(repr(w) for w in words)})"


def _any(x: str, words) -> str:
    words = list(words)
    return "(" + " OR ".join("contains(%s, '%s')" % (x, w.replace("'", "''")) for w in words) + ")" if words else "FALSE"


def _count(x: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, '{w}') AS INT)" for w in words) + ")"


def _strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


def _words(x: str) -> str:
    return rf"list_filter(string_split_regex({_strip(x)}, '\s+'), lambda w: w <> '')"


def _clean(x: str) -> str:
    t = _strip(x)
    c = _strip(rf"regexp_replace(regexp_replace({t}, '[^\p{{L}}\p{{N}}_\s\-.]', '', 'g'), '\s+', ' ', 'g')")
    return rf"CASE WHEN length({t}) >= 2 AND NOT regexp_matches({t}, '^\p{{Nd}}+$') AND {c} <> '' THEN {c} END"


def _upper(x: str) -> str:
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


def _special(x: str) -> str:
    return "(" + " OR ".join("contains(%s, '%s')" % (x, c) for c in L.SPECIAL_CHARS) + ")"


def _first(rules, other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {other} END"


JOINED = "lower(array_to_string(contexts, ' '))"
N_CTX = "len(contexts)"
TERM_FIELD = "replace(text, ' ', CASE WHEN doc_id % 3 = 0 THEN '|' WHEN doc_id % 3 = 1 THEN ',' ELSE ' ' END)"


def _terms(spark, d):
    return X.fixture(spark, d, X.TERMS)


def _contexts(spark, d):
    return X.fixture(spark, d, X.CONTEXTS)


def _translations(spark, d):
    return X.fixture(spark, d, X.TRANSLATIONS)


def _glossary(spark, d):
    return X.fixture(spark, d, X.GLOSSARY)


# cleaning and scans ---------------------------------------------------------------------------
@query(rf"""
WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents),
c AS (SELECT doc_id, {_clean("w")} AS term FROM w)
SELECT term, CAST(count(*) AS BIGINT) AS frequency, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_documents FROM c WHERE term IS NOT NULL GROUP BY term
""")
def term_extract_freq(spark, d):
    """Cleaned words of all documents with their counts."""
    per = document_words(X.table(spark, d, "documents"))
    return per.groupBy("term").agg(F.sum("n").alias("frequency"), F.count("*").alias("n_documents"))


@query(f"SELECT doc_id, {_clean('text')} AS term FROM documents")
def clean_term(spark, d):
    """Each document, cleaned as a whole."""
    return X.table(spark, d, "documents").select("doc_id", T.clean_term(F.col("text")).alias("term"))


@query(f"""
WITH f AS (SELECT doc_id, {TERM_FIELD} AS v FROM documents),
p AS (SELECT doc_id, unnest(CASE WHEN contains(v, '|') THEN string_split(v, '|') WHEN contains(v, ',') THEN string_split(v, ',') ELSE [v] END) AS x FROM f),
c AS (SELECT DISTINCT doc_id, {_clean("x")} AS term FROM p)
SELECT doc_id AS source_row, term, CAST(1 AS BIGINT) AS frequency FROM c WHERE term IS NOT NULL
""")
def parse_term_field_split(spark, d):
    """Terms of a field that holds the whole text, each once for a row."""
    field = F.replace("text", F.lit(" "), F.when(F.col("doc_id") % 3 == 0, "|").when(F.col("doc_id") % 3 == 1, ",").otherwise(" "))
    docs = X.table(spark, d, "documents").select("doc_id", field.alias("Final_Curated_Terms"))
    return terms.row_terms(docs, ["Final_Curated_Terms"], [], "doc_id").select("source_row", "term", "frequency")


@query("SELECT doc_id, left(coalesce(CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END, CASE WHEN doc_id % 8 = 0 THEN NULL ELSE lang END, source), 200) AS picked FROM documents")
def pick_text(spark, d):
    docs = X.table(spark, d, "documents")
    return docs.select("doc_id", T.pick_text(F.when(F.col("doc_id") % 4 != 0, F.col("text")), F.when(F.col("doc_id") % 8 != 0, F.col("lang")), F.col("source")).alias("picked"))


@query(r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g'), '\[[^\]]*\]', '', 'g'),
  '[<>\[\]]', '', 'g'), '\s+', ' ', 'g'), '^\s+', ''), '\s+$', '') AS cleaned FROM pages
""")
def html_clean(spark, d):
    return X.table(spark, d, "pages").select("page_id", T.html_clean(F.col("html")).alias("cleaned"))


@query(f"SELECT term, left(md5(lower(term)), 16) AS term_id, left(md5(term), 8) AS hash8, md5(term || '|EN|' || coalesce(CASE WHEN frequency % 2 = 0 THEN 'DE' END, 'None') || '|General') AS cache_key FROM ({X.TERMS}) AS t")
def term_id(spark, d):
    t, c = _terms(spark, d), F.col("term")
    return t.select("term", T.term_id(c).alias("term_id"), T.term_hash8(c).alias("hash8"), T.cache_key(c, F.lit("EN"), F.when(F.col("frequency") % 2 == 0, "DE"), F.lit("General")).alias("cache_key"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field_extract(spark, d):
    return X.table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


@query("SELECT CAST(n AS BIGINT) AS n FROM (VALUES (3),(4),(5),(10),(75),(76)) AS t(n)")
def batch_spec(spark, d):
    return spark.range(1).select(F.explode(T.batch_numbers(F.lit("3-5, 10,75-76,x,4"))).alias("n"))


@query(f"SELECT term, array_to_string(list_filter(list_transform(contexts[1:10], lambda t: trim(t)), lambda t: t <> ''), '; ') AS samples FROM ({X.CONTEXTS}) AS t")
def context_samples(spark, d):
    return _contexts(spark, d).select("term", T.context_samples(F.col("contexts")).alias("samples"))


# aggregates, filters, order, sets -------------------------------------------------------------
AGG_INPUT = "SELECT doc_id AS source_row, lang AS term, 1 AS frequency, text AS original_text FROM {documents} UNION ALL SELECT doc_id, source, 1, concat(lang, repeat('-', CAST(doc_id % 7 AS INT))) FROM {documents}"


@query(f"""
WITH t AS ({AGG_INPUT}),
r AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY length(original_text) DESC, source_row) AS rn FROM t)
SELECT term, CAST(sum(frequency) AS BIGINT) AS frequency, max(CASE WHEN rn = 1 THEN original_text END) AS original_text, min(source_row) AS source_row FROM r GROUP BY term
""")
def agg_term_longest_text(spark, d):
    return terms.aggregate(X.fixture(spark, d, AGG_INPUT))


@query(f"SELECT term, frequency, frequency >= 20 AS processed FROM ({X.TERMS}) AS t")
def freq_split(spark, d):
    often, rare = terms.split_by_frequency(_terms(spark, d), 20)
    return often.withColumn("processed", F.lit(True)).unionByName(rare.withColumn("processed", F.lit(False)))


@query(f"""
SELECT term, frequency, round(frequency * 0.7 + {N_CTX} / 10.0 * 30, 6) AS priority FROM ({X.CONTEXTS}) AS t
WHERE frequency >= 2 AND length(term) > 1 AND NOT ({_in("lower(term)", L.STOP_LOAD)} AND {N_CTX} < 3)
""")
def load_priority(spark, d):
    return terms.by_priority(terms.loadable(_contexts(spark, d))).select("term", "frequency", "priority")


@query(f"SELECT term, frequency FROM ({X.TERMS}) AS t ORDER BY frequency DESC, term LIMIT 5")
def topk_freq(spark, d):
    return terms.most_frequent(_terms(spark, d))


@query(f"WITH t AS ({AGG_INPUT}) SELECT term, min(source_row) AS source_row FROM t GROUP BY term ORDER BY source_row, term LIMIT 10")
def limit_summary(spark, d):
    cleaned = X.fixture(spark, d, AGG_INPUT).groupBy("term").agg(F.min("source_row").alias("source_row"))
    return terms.summary_head(cleaned, 10)


def _words_by(spark, d, lang):
    return X.table(spark, d, "documents").where(F.col("lang") == lang).select(F.explode(F.split("text", r"\s+")).alias("term")).where("term <> ''")


def _words_sql(lang: str) -> str:
    return rf"SELECT w AS term FROM (SELECT unnest(string_split_regex(text, '\s+')) AS w FROM documents WHERE lang = '{lang}') AS x WHERE w <> ''"


@query(f"{_words_sql('en')} INTERSECT {_words_sql('fr')}")
def set_intersect(spark, d):
    return terms.both(_words_by(spark, d, "en"), _words_by(spark, d, "fr"))


@query(f"{_words_sql('de')} EXCEPT {_words_sql('en')}")
def set_except(spark, d):
    return terms.missing(_words_by(spark, d, "de").distinct(), _words_by(spark, d, "en"))


@query(f"SELECT term, count(*) AS n FROM ({_words_sql('es')} UNION ALL {_words_sql('fr')}) AS u GROUP BY term")
def set_union(spark, d):
    return terms.either(_words_by(spark, d, "es"), _words_by(spark, d, "fr")).groupBy("term").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT term FROM ({X.TERMS}) AS t")
def unique_terms(spark, d):
    return terms.unique_terms(_terms(spark, d))


CLEANED = "SELECT p_name AS term, p_size AS frequency, p_type AS original_text, p_partkey AS source_row, p_brand AS pos_tag FROM {part}"


@query(f"""
WITH c AS ({CLEANED}), n AS (SELECT DISTINCT term FROM ({X.TERMS}) AS t)
SELECT n.term, CAST(coalesce(arg_min(c.frequency, c.source_row), 1) AS BIGINT) AS frequency, count(c.original_text) AS n_texts, coalesce(string_agg(DISTINCT c.pos_tag, ',' ORDER BY c.pos_tag), '') AS tags
FROM n LEFT JOIN c ON c.term = n.term GROUP BY n.term
""")
def cleaned_context(spark, d):
    """All terms against all parts; terms of other columns and tables have no cleaned row."""
    t = terms.with_contexts(_terms(spark, d), X.fixture(spark, d, CLEANED))
    return t.select("term", "frequency", "n_texts", F.array_join("pos_tags", ",").alias("tags"))


@query("SELECT doc_id AS term, 'old' AS origin FROM labels UNION ALL SELECT doc_id, 'new' FROM documents AS d WHERE NOT EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = d.doc_id)")
def merge_new(spark, d):
    """All labelled documents, and every other document as new."""
    old = X.table(spark, d, "labels").select(F.col("doc_id").alias("term"), F.lit("old").alias("origin"))
    return terms.merge_new(old, X.table(spark, d, "documents").select(F.col("doc_id").alias("term"), F.lit("new").alias("origin")))


@query("""
WITH c AS (SELECT lang, source, count(*) AS k FROM documents GROUP BY 1, 2), p AS (SELECT lang, k / sum(k) OVER (PARTITION BY lang) AS p FROM c)
SELECT lang, round(-sum(p * ln(p)), 6) AS entropy, count(*) AS types FROM p GROUP BY lang
""")
def source_entropy(spark, d):
    """The spread of each language over sources, from two levels of counts."""
    counts = X.table(spark, d, "documents").groupBy("lang", "source").count()
    k = F.col("count").cast("double")
    # ln N - sum(k ln k) / N: sums only, so a language of very many sources is never gathered
    return counts.groupBy("lang").agg(F.round(F.ln(F.sum(k)) - F.sum(k * F.ln(k)) / F.sum(k), 6).alias("entropy"), F.count("*").alias("types"))


# joins ----------------------------------------------------------------------------------------
@query(f"""
WITH g AS ({X.GLOSSARY}), f AS (SELECT DISTINCT doc_id, g.source AS term, 'glossary' AS kind FROM documents JOIN g ON contains(text, g.source) WHERE pair = 'ENG-DEU'),
n AS (SELECT DISTINCT doc_id, g.source AS term, 'dnt' AS kind FROM documents JOIN g ON contains(text, g.source) WHERE pair = 'DNT')
SELECT * FROM f UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = n.doc_id AND f.term = n.term)
""")
def glossary_contains(spark, d):
    return glossary.used_terms(X.table(spark, d, "documents").select("doc_id", "text"), _glossary(spark, d), "ENG-DEU")


@query(f"""
WITH g AS ({X.GLOSSARY}), u AS (SELECT DISTINCT t.term, CASE WHEN g.pair = 'DNT' THEN 'dnt' ELSE 'glossary' END AS kind FROM ({X.TERMS}) AS t JOIN g ON contains(t.term, g.source) WHERE g.pair IN ('ENG-FRE'))
SELECT t.term, count(u.term) > 0 AS hit FROM ({X.TERMS}) AS t LEFT JOIN u ON u.term = t.term GROUP BY t.term
""")
def glossary_verdict(spark, d):
    known, new = glossary.verdict(_terms(spark, d), _glossary(spark, d).where("pair = 'ENG-FRE'"))
    return known.select("term", F.lit(True).alias("hit")).unionByName(new.select("term", F.lit(False).alias("hit")))


REQUESTS = "SELECT src, tgt FROM (VALUES ('EN', 'DE'), ('en', 'fr'), ('english', 'german'), ('EN', 'JA'), ('FR', 'DE'), ('eng-US', 'deu')) AS r(src, tgt)"


@query("SELECT * FROM (VALUES ('EN', 'DE', 'EN-DE'), ('en', 'fr', 'ENG-FRE'), ('english', 'german', 'ENG-DEU'), ('EN', 'JA', 'ENG-CSY')) AS r(src, tgt, pair)")
def glossary_pair(spark, d):
    return glossary.resolve_pairs(X.fixture(spark, d, REQUESTS), _glossary(spark, d))


@query(f"""
WITH g AS ({X.GLOSSARY}), u AS (
  SELECT pair AS own, pair, source, target, load_order FROM g WHERE pair <> 'DNT' UNION ALL SELECT pair, lower(pair), source, target, load_order FROM g WHERE pair <> 'DNT'
  UNION ALL SELECT pair, CASE pair WHEN 'ENG-DEU' THEN 'EN-DE' WHEN 'ENG-FRE' THEN 'EN-FR' WHEN 'ENG-CSY' THEN 'EN-CS' END, source, target, load_order FROM g WHERE pair IN ('ENG-DEU', 'ENG-FRE', 'ENG-CSY')),
r AS (SELECT *, row_number() OVER (PARTITION BY pair, source ORDER BY own = pair DESC, load_order DESC, target DESC) AS rn FROM u)
SELECT pair, split_part(pair, '-', 1) AS source_language, CASE WHEN contains(pair, '-') THEN split_part(pair, '-', 2) END AS target_language, count(*) AS n_terms
FROM (SELECT pair, source FROM r WHERE rn = 1 UNION SELECT pair, source FROM g WHERE pair = 'DNT') AS x GROUP BY pair
""")
def glossary_stats(spark, d):
    return glossary.statistics(glossary.with_aliases(_glossary(spark, d)))


@query(f"""
WITH g AS (SELECT DISTINCT pair, source FROM ({X.GLOSSARY}) AS g), h AS (
  SELECT t.term, g.pair, g.source, row_number() OVER (PARTITION BY t.term, g.pair ORDER BY g.source) AS rn FROM ({X.TERMS}) AS t JOIN g ON contains(lower(g.source), lower(t.term)) OR contains(lower(t.term), lower(g.source)))
SELECT term, count(*) FILTER (WHERE lower(term) = lower(source)) AS duplicates, array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE rn <= 5)), ',') AS related FROM h GROUP BY term
""")
def domain_related(spark, d):
    return glossary.related(_terms(spark, d), _glossary(spark, d)).withColumn("related", F.array_join("related", ","))


def _nested_replace(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_PLACEHOLDERS = [(t, f"__DNT_PLACEHOLDER_{i}__") for i, t in enumerate(("ation", "that", "ou"))]
_REPLACED = _nested_replace("text", [*_PLACEHOLDERS, ("ation", "ierung"), ("thing", "Ding"), ("bolt", "Bolzen"), ("ing", "end"), ("the", "die"), *((b, a) for a, b in _PLACEHOLDERS)])


@query(f"SELECT doc_id, {_REPLACED} AS replaced FROM documents")
def replace_terms(spark, d):
    """Replacements throughout each document."""
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    return glossary.replaced(docs, _glossary(spark, d), "ENG-DEU").select("doc_id", "replaced")


QC = "SELECT p_brand AS file, CASE WHEN p_partkey % 11 = 0 THEN ' ' || p_name WHEN p_partkey % 13 = 0 THEN '  ' ELSE p_name END AS source, CASE WHEN p_partkey % 7 = 0 THEN p_type || '\"' ELSE p_type END AS target FROM {part}"


@query(f"""
WITH g AS ({QC})
SELECT file, source, target, count(*) OVER (PARTITION BY file, source) > 1 AS duplicate, source IS NULL AND target IS NULL AS empty_line,
 trim(source) = '' AS empty_source, source <> trim(source) AS space_source, contains(source, chr(160)) AS nbsp_source, contains(source, '"') AS quote_source,
 trim(target) = '' AS empty_target, target <> trim(target) AS space_target, contains(target, chr(160)) AS nbsp_target, contains(target, '"') AS quote_target FROM g
""")
def glossary_qc(spark, d):
    return glossary.content_issues(X.fixture(spark, d, QC))


@query("""
SELECT DISTINCT d.doc_id AS term FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def anti_pending(spark, d):
    docs, done = (X.table(spark, d, t).select(F.col("doc_id").alias("term")).distinct() for t in ("documents", "labels"))
    return terms.missing(docs, done)


@query("""
WITH r AS (SELECT DISTINCT source AS term FROM documents), t AS (SELECT DISTINCT source AS term FROM documents WHERE doc_id % 5 = 0 AND source <> 'src1'),
s AS (SELECT count(t.term) * 1.0 / count(*) AS share FROM r LEFT JOIN t ON r.term = t.term)
SELECT r.term FROM r, s WHERE share <= 0.9 AND r.term NOT IN (SELECT term FROM t)
""")
def overlap_resolve(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", F.col("source").alias("term"))
    return terms.resolve_overlap(docs.select("term").distinct(), docs.where("doc_id % 5 = 0 and term <> 'src1'").select("term"))


@query("""
WITH v AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations), t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations WHERE role = 'assistant')
SELECT v.conv_id AS term, v.turn AS index, v.text AS first_text, t.text AS last_text FROM v LEFT JOIN t ON t.conv_id = v.conv_id AND t.rn = 1 WHERE v.rn = 1
""")
def step_join_dedup(spark, d):
    c = X.table(spark, d, "conversations").select(F.col("conv_id").alias("term"), F.col("turn").alias("index"), "text", "role")
    v = c.select("term", "index", F.col("text").alias("first_text"))
    return decide.join_steps(v, c.where("role = 'assistant'").select("term", "index", F.col("text").alias("last_text")))


@query(f"""
WITH g AS ({X.GLOSSARY}), u AS (SELECT DISTINCT doc_id, g.source AS term, CASE WHEN pair = 'DNT' THEN 'dnt' ELSE 'glossary' END AS kind FROM documents JOIN g ON contains(text, g.source) WHERE pair IN ('ENG-DEU', 'DNT')),
k AS (SELECT * FROM u WHERE kind = 'glossary' UNION ALL SELECT * FROM u WHERE kind = 'dnt' AND NOT EXISTS (SELECT 1 FROM u v WHERE v.doc_id = u.doc_id AND v.term = u.term AND v.kind = 'glossary')),
t AS (SELECT source, arg_max(target, load_order) AS target FROM g WHERE pair = 'ENG-DEU' GROUP BY source)
SELECT k.doc_id, k.term, k.kind, CASE WHEN kind = 'dnt' THEN k.term ELSE t.target END AS translation FROM k LEFT JOIN t ON t.source = k.term
""")
def term_details(spark, d):
    g = _glossary(spark, d)
    return glossary.term_details(glossary.used_terms(X.table(spark, d, "documents").select("doc_id", "text"), g, "ENG-DEU"), g, "ENG-DEU")


@query(f"""
WITH g AS ({X.GLOSSARY}), x AS (SELECT pair, source, target FROM g UNION ALL SELECT p, s, t FROM (VALUES {", ".join(f"('{s}', '{t}')" for s, t in L.DEFAULT_GLOSSARY.items())}) AS v(s, t), (VALUES ('EN-CS'), ('en-cs')) AS q(p)) SELECT * FROM x
""")
def glossary_default(spark, d):
    return glossary.with_default(_glossary(spark, d)).select("pair", "source", "target")


# lexicon --------------------------------------------------------------------------------------
def _dict(x: str) -> str:
    return _first(
        [
            (f"length({x}) < 2", "'too_short'"), (f"NOT regexp_matches({x}, '^[a-zA-Z''-]+$')", "'non_alphabetic'"), (_in(f"lower({x})", L.DEFAULT.common_words), "'common_word'"),
            (_in(f"lower({x})", L.DEFAULT.technical_terms), "'technical_term'"), (f"length({x}) > 25", "'too_long'"),
            (f"len(list_filter(range(1, length({x})), lambda i: len(list_filter(range(3, 13), lambda k: i + 2 * k <= length({x}) + 1 AND substr(lower({x}), i, k) = substr(lower({x}), i + k, k))) > 0)) > 0", "'repeating_pattern'"),
            ("(" + " OR ".join(f"contains(lower({x}), '{c * 3}')" for c in "abcdefghijklmnopqrstuvwxyz") + ")", "'consecutive_letters'"),
        ],
        "'uncertain'",
    )


@query(f"""
WITH w AS (SELECT DISTINCT lower(p_name) AS word FROM part UNION SELECT 'run' UNION SELECT 'stop' UNION SELECT 'color' UNION SELECT 'fillet'),
c AS (SELECT term, {_dict("term")} AS rule FROM ({X.TERMS}) AS t),
v AS (SELECT term, rule, lower(term) AS k, [CASE WHEN lower(term) LIKE '%s' AND length(term) > 3 THEN left(lower(term), -1) END, CASE WHEN lower(term) LIKE '%ed' AND length(term) > 4 THEN left(lower(term), -2) END,
  CASE WHEN lower(term) LIKE '%ing' AND length(term) > 5 THEN left(lower(term), -3) END, CASE WHEN lower(term) LIKE '%ly' AND length(term) > 4 THEN left(lower(term), -2) END] AS forms FROM c),
f AS (SELECT term, min(x.i) AS i FROM (SELECT term, unnest(forms) AS form, unnest([1, 2, 3, 4]) AS i FROM v WHERE rule = 'uncertain') AS x JOIN w ON w.word = x.form GROUP BY term)
SELECT v.term, CASE WHEN rule <> 'uncertain' THEN rule IN ('common_word', 'technical_term') ELSE w.word IS NOT NULL OR f.i IS NOT NULL END AS in_dictionary,
  CASE WHEN rule <> 'uncertain' THEN rule WHEN w.word IS NOT NULL THEN 'nltk_direct' WHEN f.i IS NOT NULL THEN 'nltk_variation' ELSE 'nltk_not_found' END AS method,
  CASE WHEN rule = 'uncertain' AND w.word IS NULL AND f.i IS NOT NULL THEN forms[f.i] END AS found_as
FROM v LEFT JOIN w ON w.word = v.k AND rule = 'uncertain' LEFT JOIN f ON f.term = v.term
""")
def dict_classify(spark, d):
    words = X.table(spark, d, "part").select(F.lower("p_name").alias("word")).union(spark.createDataFrame([(x,) for x in ("run", "stop", "color", "fillet")], "word string"))
    return dictionary.classify_terms(_terms(spark, d), words).select("term", "in_dictionary", "method", "found_as")


CODES = "SELECT code FROM (VALUES ('cs'), ('German'), ('zh-tw'), ('zh-CN'), ('CORE_FRA_TERMS'), ('pt-BR'), ('xx'), ('ENG'), ('Japanese')) AS c(code)"


@query("SELECT * FROM (VALUES ('cs','CSY','ces_Latn'),('German','DEU',NULL),('zh-tw','CHT','zho_Hant'),('zh-CN','zh',NULL),('CORE_FRA_TERMS','FRA',NULL),('pt-BR','pt',NULL),('xx','XX',NULL),('ENG','ENG',NULL),('Japanese','JPN',NULL)) AS c(code, base, translator)")
def lang_norm(spark, d):
    return X.fixture(spark, d, CODES).select("code", T.language(F.col("code")).alias("base"), T.translator_code(F.lower("code")).alias("translator"))


CATEGORY = _first(
    [
        (_any("lower(term)", L.CATEGORY_TECH), "'ultra_technical'"), ("regexp_matches(term, '[0-9]') AND " + _any("lower(term)", L.CATEGORY_VERSION), "'version'"),
        (f"{_upper('term')} OR " + _any("lower(term)", L.DEFAULT.brand_names), "'brand'"), (_any("lower(term)", L.CATEGORY_TECHNICAL), "'technical'"),
        (_any("lower(term)", L.CATEGORY_BUSINESS), "'business'"), (_any("lower(term)", L.CATEGORY_COMMON), "'common'"),
    ],
    "'general'",
)


_TIER_OF = "CASE WHEN category IN ('ultra_technical', 'version') THEN 'ultra_minimal' WHEN category IN ('brand', 'technical') THEN 'minimal' ELSE 'core' END"


@query(f"SELECT term, {CATEGORY} AS category FROM ({X.TERMS}) AS t")
def term_category(spark, d):
    return _terms(spark, d).select("term", translation.category(F.col("term")).alias("category"))


@query(f"""
WITH c AS (SELECT term, {CATEGORY} AS category FROM ({X.TERMS}) AS t)
SELECT CASE WHEN category IN ('ultra_technical', 'version') THEN 'ultra_minimal' WHEN category IN ('brand', 'technical') THEN 'minimal' ELSE 'core' END AS tier, count(*) AS n,
  CAST(sum(CASE WHEN category IN ('ultra_technical', 'version') THEN 15 WHEN category IN ('brand', 'technical') THEN 20 ELSE 40 END) AS BIGINT) AS n_languages FROM c GROUP BY 1
""")
def lang_tier_counts(spark, d):
    t = _terms(spark, d).select(translation.tier(translation.category(F.col("term"))).alias("tier"))
    return t.select("tier", F.size(translation.tier_languages(F.col("tier"))).alias("k")).groupBy("tier").agg(F.count("*").alias("n"), F.sum("k").alias("n_languages"))


@query("""
SELECT event_id, CASE WHEN count(v) OVER w >= 10 THEN round(avg(v) OVER w, 6) END AS recent FROM (SELECT event_id, user_id, CAST(event_id % 100 AS DOUBLE) / 100 AS v FROM events) AS e
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
""")
def recent_avg(spark, d):
    e = X.table(spark, d, "events").select("event_id", "user_id", (F.col("event_id") % 100 / F.lit(100.0)).alias("score"))
    return translation.recent_average(e, "event_id", by=("user_id",)).select("event_id", "recent")


# translation ----------------------------------------------------------------------------------
KIND = "CASE WHEN starts_with(translation, 'ERROR:') THEN 'error' WHEN lower(translation) = lower(term) THEN 'same' ELSE 'translated' END"


@query(f"""
WITH t AS (SELECT *, {KIND} AS kind FROM ({X.TRANSLATIONS}) AS x)
SELECT term, count(*) AS total_languages, count(*) FILTER (WHERE kind = 'same') AS same_languages, count(*) FILTER (WHERE kind = 'translated') AS translated_languages, count(*) FILTER (WHERE kind = 'error') AS error_languages,
 round(CASE WHEN count(*) FILTER (WHERE kind <> 'error') > 0 THEN count(*) FILTER (WHERE kind = 'translated') / count(*) FILTER (WHERE kind <> 'error') ELSE 0.0 END, 6) AS translatability_score,
 coalesce(string_agg(language, ',' ORDER BY language) FILTER (WHERE kind = 'same'), '') AS same_codes FROM t GROUP BY term
""")
def translation_summary(spark, d):
    s = translation.summary(_translations(spark, d))
    return s.select("term", "total_languages", "same_languages", "translated_languages", "error_languages", "translatability_score", F.array_join("same_language_codes", ",").alias("same_codes"))


@query(f"""
WITH t AS (SELECT term, {KIND} AS kind FROM ({X.TRANSLATIONS}) AS x), s AS (SELECT term, count(*) AS n, count(*) FILTER (WHERE kind = 'translated') AS tr, count(*) FILTER (WHERE kind = 'same') AS sm, count(*) FILTER (WHERE kind = 'error') AS er FROM t GROUP BY term)
SELECT count(*) AS terms, CAST(sum(n) AS BIGINT) AS translations, CAST(sum(tr) AS BIGINT) AS translated, CAST(sum(sm) AS BIGINT) AS same, CAST(sum(er) AS BIGINT) AS errors,
 round(avg(round(CASE WHEN tr + sm > 0 THEN tr / (tr + sm) ELSE 0.0 END, 6)), 6) AS mean_score,
 (SELECT string_agg(DISTINCT tier, ',' ORDER BY tier) FROM (SELECT {_TIER_OF} AS tier FROM (SELECT term, {CATEGORY} AS category FROM s) AS c) AS y) AS tiers FROM s
""")
def translation_totals(spark, d):
    return translation.totals(translation.summary(_translations(spark, d))).withColumn("tiers", F.array_join("tiers", ","))


@query(f"WITH s AS (SELECT term, count(*) AS n FROM ({X.TRANSLATIONS}) AS x GROUP BY term) SELECT CAST(sum(n) AS BIGINT) AS processed, round((count(*) * 202 - sum(n)) / (count(*) * 202) * 100, 6) AS saved_percent FROM s")
def translation_efficiency(spark, d):
    return translation.efficiency(translation.summary(_translations(spark, d)))


ISSUE = "CASE WHEN starts_with(translation, 'ERROR:') THEN 'translation_error' WHEN translation IS NULL OR trim(translation) = '' THEN 'empty_translation' WHEN length(translation) > 5 * length(term) THEN 'suspicious_length' END"


@query(f"SELECT * FROM (SELECT term, language, {ISSUE} AS issue FROM ({X.TRANSLATIONS}) AS x) AS y WHERE issue IS NOT NULL")
def verify_issues(spark, d):
    return translation.issues(_translations(spark, d))


@query(f"""
WITH t AS (SELECT *, {ISSUE} AS issue FROM ({X.TRANSLATIONS}) AS x)
SELECT term, count(issue) AS verification_issues_count, count(issue) = 0 AS verification_passed, count(*) FILTER (WHERE issue IS NULL OR issue = 'suspicious_length') AS verified_count,
 coalesce(string_agg(language, ',' ORDER BY language) FILTER (WHERE issue IS NULL OR issue = 'suspicious_length'), '') AS verified FROM t GROUP BY term
""")
def verify_pass(spark, d):
    return translation.verified(_translations(spark, d)).select("term", "verification_issues_count", "verification_passed", "verified_count", F.array_join("verified_languages", ",").alias("verified"))


@query(f"""
WITH g AS (SELECT 'deu_Latn' AS language, source, target, load_order FROM ({X.GLOSSARY}) AS g WHERE pair = 'ENG-DEU'), b AS (SELECT language, source, arg_max(target, load_order) AS target FROM g GROUP BY 1, 2),
r AS (SELECT term, language FROM ({X.TERMS}) AS t, (VALUES ('deu_Latn'), ('xxx_Xxxx')) AS l(language)),
e AS (SELECT r.*, CASE WHEN trim(term) = '' THEN 'empty text' WHEN language = 'xxx_Xxxx' THEN 'unsupported language: ' || language END AS error FROM r)
SELECT e.term, e.language, e.error, CASE WHEN e.error IS NULL THEN coalesce(b.target, e.term) ELSE e.term END AS translation, lower(CASE WHEN e.error IS NULL THEN coalesce(b.target, e.term) ELSE e.term END) = lower(e.term) AS is_same
FROM e LEFT JOIN b ON b.language = e.language AND b.source = e.term
""")
def translate_guards(spark, d):
    g = _glossary(spark, d).where("pair = 'ENG-DEU'").withColumn("language", F.lit("deu_Latn"))
    rows = _terms(spark, d).select("term", F.explode(F.array(F.lit("deu_Latn"), F.lit("xxx_Xxxx"))).alias("language"))
    valid = spark.createDataFrame([("deu_Latn",), ("fra_Latn",)], "language string")
    return translation.guarded(rows, valid, translation.glossary_translator(g)).select("term", "language", "error", "translation", "is_same")


@query(f"""
WITH t AS (SELECT term, {KIND} AS kind, language FROM ({X.TRANSLATIONS}) AS x), s AS (SELECT term, list(language) FILTER (WHERE kind <> 'error') AS done, count(*) FILTER (WHERE kind = 'translated') AS tr, count(*) FILTER (WHERE kind <> 'error') AS ok FROM t GROUP BY term)
SELECT term, CASE WHEN ok > 0 AND tr / ok > 0.98 THEN 20 ELSE 0 END AS n FROM s
""")
def language_expansion(spark, d):
    s = translation.summary(_translations(spark, d))
    return s.select("term", F.size(translation.expansion(F.col("translatability_score"), F.array_union("same_language_codes", "translated_language_codes"))).alias("n"))


@query(f"""
WITH t AS (SELECT *, {KIND} AS kind, {ISSUE} AS issue FROM ({X.TRANSLATIONS}) AS x), s AS (SELECT term, count(*) FILTER (WHERE kind = 'translated') AS a, count(*) FILTER (WHERE kind = 'translated' AND (issue IS NULL OR issue = 'suspicious_length')) AS b,
 count(*) FILTER (WHERE issue IS NULL OR issue = 'suspicious_length') AS v FROM t GROUP BY term)
SELECT term, round(CASE WHEN a > 0 AND v > 0 THEN b / a ELSE 0.0 END, 6) AS consistency FROM s
""")
def step_consistency(spark, d):
    rows = _translations(spark, d)
    both = translation.summary(rows).select("term", "translated_language_codes").join(translation.verified(rows).select("term", "verified_languages"), "term")
    return both.select("term", translation.consistency(F.col("translated_language_codes"), F.col("verified_languages")).alias("consistency"))


# features and scores --------------------------------------------------------------------------
_LOW = "lower(term)"
CHARS = {
    "length": "length(term)", "has_numbers": "regexp_matches(term, '[0-9]')", "has_special_chars": _special("term"), "is_very_short": "length(term) <= 3", "is_long": "length(term) > 15",
    "is_filename": "contains(term, '.') AND " + _any(_LOW, L.FILE_WORDS), "is_error_related": _any(_LOW, L.ERROR_CHARACTER), "is_technical_code": _any(_LOW, L.CODE_PREFIXES),
    "potential_acronym": f"{_upper('term')} AND length(term) <= 6", "has_version_pattern": r"regexp_matches(term, '\d+\.\d+|\d+_\d+')",
}
CHAR_COLS = ", ".join(f"{v} AS {k}" for k, v in CHARS.items())
STRATEGY = _first([("is_very_short OR potential_acronym", "'definition_focused'"), ("is_filename", "'software_focused'"), ("is_error_related", "'error_focused'"), ("is_technical_code", "'technical_focused'"), ("is_long", "'context_focused'")], "'comprehensive'")


@query(f"WITH c AS (SELECT term, {CHAR_COLS} FROM ({X.TERMS}) AS t) SELECT *, {STRATEGY} AS strategy FROM c")
def term_characteristics(spark, d):
    c = scoring.characteristics(F.col("term"))
    return _terms(spark, d).select("term", c.alias("c"), scoring.search_strategy(c).alias("strategy")).select("term", "c.*", "strategy")


CTX_SCORE = f"""round(greatest(0.0, least(1.0, CASE WHEN is_very_short THEN 0.1 WHEN length BETWEEN 4 AND 12 THEN 0.3 ELSE 0.0 END::DOUBLE + CASE WHEN is_technical_code OR is_error_related THEN 0.2 ELSE 0.0 END::DOUBLE
 + CASE WHEN is_filename THEN 0.15 ELSE 0.0 END::DOUBLE + CASE WHEN inside THEN 0.3 ELSE 0.0 END::DOUBLE + CASE WHEN inside AND {_any("joined", ("error", "system", "software", "technical"))} THEN 0.1 ELSE 0.0 END::DOUBLE
 - CASE WHEN has_special_chars AND NOT is_filename THEN 0.1 ELSE 0.0 END::DOUBLE)), 6)"""
CTX_BASE = f"SELECT term, frequency, contexts, {CHAR_COLS}, {JOINED} AS joined, {N_CTX} > 0 AND contains({JOINED}, lower(term)) AS inside FROM ({X.CONTEXTS}) AS t"
CTX_STATUS = "CASE WHEN score >= 0.7 THEN 'accepted' WHEN score >= 0.5 THEN 'needs_review' WHEN score >= 0.3 THEN 'low_priority' ELSE 'not_recommended' END"


@query(f"""
WITH c AS ({CTX_BASE}), s AS (SELECT *, {CTX_SCORE} AS score, {STRATEGY} AS strategy FROM c)
SELECT term, score, {CTX_STATUS} AS status, strategy, score > 0.3 AS web_ok, round(CASE WHEN is_technical_code OR is_error_related THEN least(1.0, score + 0.1) ELSE score END, 6) AS improved_relevance,
 concat_ws(' ', CASE WHEN is_very_short THEN 'Very short term, possibly an acronym or abbreviation.' END, CASE WHEN is_filename THEN 'Appears to be a filename or system file reference.' END,
  CASE WHEN is_error_related THEN 'Error-related term, likely used in system diagnostics.' END, CASE WHEN is_technical_code THEN 'Technical coding pattern detected.' END,
  CASE WHEN {N_CTX} > 0 THEN 'Term context available from ' || {N_CTX} || ' source texts.' ELSE 'No original context texts provided.' END) AS note FROM s
""")
def fallback_review(spark, d):
    r = _contexts(spark, d).select("term", scoring.fallback_review(F.col("term"), F.col("contexts")).alias("r"))
    return r.select("term", "r.score", "r.status", "r.strategy", "r.web_ok", "r.improved_relevance", "r.note")


DOMAIN_COLS = ", ".join(f"round({_count('x', w)} / {len(w)}.0, 6) AS {k}" for k, w in L.DOMAINS.items())


@query(f"WITH t AS (SELECT term, contexts, lower(concat_ws(' ', term, array_to_string(contexts, ' '))) AS x FROM ({X.CONTEXTS}) AS t) SELECT term, {DOMAIN_COLS} FROM t".replace("/ 7.0", "/ 7::DOUBLE").replace("/ 6.0", "/ 6::DOUBLE"))
def domain_classify(spark, d):
    return _contexts(spark, d).select("term", scoring.domains(F.col("term"), F.col("contexts")).alias("x")).select("term", "x.*")


@query(rf"""
WITH t AS (SELECT term, contexts, {JOINED} AS x, list_filter(string_split_regex({JOINED}, '\s+'), lambda w: w <> '') AS w FROM ({X.CONTEXTS}) AS t)
SELECT term, round(CASE WHEN {N_CTX} = 0 THEN 0.0 ELSE least(1.0::DOUBLE, (least(1.0::DOUBLE, list_sum(list_transform(contexts, lambda c: length(c))) / {N_CTX} / 100::DOUBLE) + len(list_distinct(w)) / greatest(1, len(w))) / 2) END, 6) AS quality,
 round(CASE WHEN {N_CTX} = 0 THEN 0.1 ELSE least(1.0::DOUBLE, ((length(x) - length(replace(x, lower(term), ''))) / greatest(1, length(term)) + {_count("x", L.RICHNESS)}) / 10::DOUBLE) END, 6) AS richness,
 concat_ws(',', {", ".join(f"CASE WHEN {_any('x', w)} THEN '{k}' END" for k, w in L.USAGE.items())}) AS usage FROM t
""")
def context_analysis(spark, d):
    t, c = F.col("term"), F.col("contexts")
    return _contexts(spark, d).select("term", scoring.context_quality(c).alias("quality"), scoring.semantic_richness(t, c).alias("richness"), F.array_join(scoring.usage_patterns(c), ",").alias("usage"))


W = _words("lower(term)")
M2 = [
    (f"n = 1 AND length(low) <= 4 AND {_in('low', L.SHORT_COMMON)}", 0.85), (f"n = 1 AND {_in('low', L.ACTIONS)}", 0.80), (f"n = 1 AND {_in('low', L.ADJECTIVES)}", 0.75), (f"n = 1 AND {_in('low', L.UI_NOUNS)}", 0.70),
    (f"n = 1 AND {_in('low', L.COLORS)}", 0.85), (f"n = 1 AND {_in('low', L.DIRECTIONS)}", 0.80), (f"n >= 2 AND {_in('w[1]', [*L.ACTIONS, 'new', 'old'])}", 0.75), (f"n >= 2 AND {_in('w[n]', L.UI_NOUNS)}", 0.70),
]
KNOWN = "[" + ", ".join(f"'{x}'" for x in L.generic_words()) + "]"
M5 = [
    (f"n = 1 AND list_contains({KNOWN}, low)", 0.75), (f"n = 2 AND list_contains({KNOWN}, w[1]) AND ({_in('w[1]', L.PAIR_ACTIONS)} OR {_in('w[2]', L.PAIR_UI)})", 0.70),
    (f"n > 1 AND len(list_filter(w, lambda x: list_contains({KNOWN}, x))) >= n * 0.5", 0.60),
]
TYPE = _first([(_any("lower(c)", words), f"'{name}'") for name, words in L.CONTEXT_TYPES], "'General'")
GENERIC = f"""
WITH a AS (SELECT term, frequency, contexts, lower(term) AS low, {W} AS w, len({W}) AS n FROM ({X.CONTEXTS}) AS t),
ty AS (SELECT term, {TYPE} AS ty FROM (SELECT term, unnest(contexts) AS c FROM a) AS u), tc AS (SELECT term, ty, count(*) AS k FROM ty GROUP BY 1, 2),
en AS (SELECT term, sum(k) AS total, count(*) AS types, -sum((k / s) * ln(k / s)) AS h FROM (SELECT *, sum(k) OVER (PARTITION BY term) AS s FROM tc) AS q GROUP BY term),
v AS (SELECT a.*, coalesce(total >= 3 AND h < 1.0 AND types >= 4, FALSE) AS m1, CASE WHEN coalesce(total, 0) < 3 THEN 0.0 WHEN h < 1.0 AND types >= 4 THEN 0.7 ELSE 0.3 END::DOUBLE AS c1,
 {_first([(c, "TRUE") for c, _ in M2], "FALSE")} AS m2, {_first([(c, str(x)) for c, x in M2], "0.3")}::DOUBLE AS c2, {_first([(c, "TRUE") for c, _ in M5], "FALSE")} AS m5, {_first([(c, str(x)) for c, x in M5], "0.4")}::DOUBLE AS c5,
 {_first([(f"len(list_filter(w, lambda x: ends_with(x, '{s}') AND length(x) > {len(s) + 2})) > 0", "'Has technical suffix ''-" + s + "'''") for s in sorted(L.TECHNICAL_SUFFIXES)] + [(f"len(list_filter(w, lambda x: contains(x, '{r}'))) > 0", "'Contains domain root ''" + r + "'''") for r in sorted(L.DOMAIN_ROOTS)] + [("n >= 3", "'Multi-word compound term'")], "NULL")} AS protection
 FROM a LEFT JOIN en ON en.term = a.term),
g AS (SELECT term, frequency, m1, m2, m5, CAST(m1 AS INT) + CAST(m2 AS INT) + CAST(m5 AS INT) AS votes, round((c1 + c2 + c5) / 3, 6) AS confidence, protection FROM v)
"""
PENALTY = "round(CASE votes WHEN 3 THEN -0.15 WHEN 2 THEN -0.07 WHEN 1 THEN -0.03 ELSE 0.0 END::DOUBLE * CASE WHEN protection IS NOT NULL THEN 0.5 ELSE 1.0 END::DOUBLE, 6)"


@query(f"{GENERIC} SELECT term, m1, m2, m5, CAST(votes AS BIGINT) AS votes, confidence, votes >= 2 AS is_generic, replace(protection, '''''', '''') AS protection, {PENALTY} AS penalty FROM g")
def generic_detect(spark, d):
    return _contexts(spark, d).select("term", generic.detect(F.col("term"), F.col("contexts")).alias("g")).select("term", "g.*")


_C = lambda c, v, e="0.0": f"CASE WHEN {c} THEN {v} ELSE {e} END::DOUBLE"
SINGLE = f"""CASE WHEN {_in("low", L.VERY_COMMON)} THEN 0.20 ELSE least(0.20::DOUBLE, CASE WHEN frequency >= 30 THEN aff * 0.6 WHEN frequency < 3 THEN aff + 0.05 ELSE aff END) END::DOUBLE"""
PAIR = f"""{_C("cm = 2", "0.15", "CASE WHEN cm = 1 THEN 0.08 ELSE 0.0 END")} + br * 0.06::DOUBLE - dm * 0.08::DOUBLE + {_C("frequency < 5", "0.05", "CASE WHEN frequency >= 20 THEN -0.03 ELSE 0.0 END")}
 - {_C(f"dm = 2 OR {_in('w[1]', L.PAIR_ADJECTIVES)} OR {_in('w[1]', L.PAIR_VERBS)}", "0.05")} + {_C(f"{_in('w[1]', L.PAIR_GENERIC_VERBS)} AND {_in('w[2]', L.PAIR_GENERIC_NOUNS)}", "0.12")}"""
PENALTIES = f"""
WITH a AS (SELECT term, frequency, contexts, lower(term) AS low, {W} AS w, len({W}) AS n FROM ({X.CONTEXTS}) AS t),
b AS (SELECT *, CASE WHEN {_in("low", L.SINGLE_DOMAIN)} THEN 0.0::DOUBLE ELSE {_C(_in("low", L.UI_VERBS), "0.18")} + {_C(_in("low", L.SINGLE_UI_NOUNS), "0.16")} + {_C(_in("low", L.BROAD), "0.14")} END AS p0,
 CAST({_in("w[1]", [*L.VERY_COMMON, *L.UI_COMMON])} AS INT) + CAST({_in("w[2]", [*L.VERY_COMMON, *L.UI_COMMON])} AS INT) AS cm, CAST({_in("w[1]", L.PAIR_BROAD)} AS INT) + CAST({_in("w[2]", L.PAIR_BROAD)} AS INT) AS br,
 CAST({_in("w[1]", L.PAIR_DOMAIN)} AS INT) + CAST({_in("w[2]", L.PAIR_DOMAIN)} AS INT) AS dm FROM a),
c AS (SELECT *, CASE WHEN length(low) >= 8 AND regexp_matches(low, '({"|".join(L.AFFIX_SUFFIXES)})$|^({"|".join(L.AFFIX_PREFIXES)})') THEN p0 * 0.7 ELSE p0 END AS aff, round(greatest(0.0::DOUBLE, least(0.25::DOUBLE, {PAIR})), 6) AS smart,
 CASE WHEN frequency >= 50 THEN 0.5 ELSE 1.0 END::DOUBLE AS m FROM b),
e AS (SELECT *, {SINGLE} * m + {_C("frequency < 10", "m * 0.15")} + {_C(f"length(term) < 4 AND NOT {_upper('term')}", "m * 0.10")} + {_C(_in("low", L.ULTRA_GENERIC), "0.25")} AS one,
 greatest(CASE WHEN {_in("low", L.ULTRA_PHRASES)} THEN greatest(smart, 0.20) ELSE smart END, CASE WHEN w[1] IN ('click', 'press', 'toggle') AND w[2] NOT IN ('machine', 'tool', 'fixture') THEN 0.12 ELSE 0.0 END) AS more FROM c),
p AS (SELECT *, round(CASE WHEN n > 2 THEN 0.0 WHEN n = 2 AND smart >= 0.10 THEN smart WHEN n = 2 THEN least(0.25::DOUBLE, more) WHEN {_in("low", L.ACRONYMS)} OR ({_upper("term")} AND length(term) <= 5) THEN 0.05 ELSE least(0.50::DOUBLE, one) END, 6) AS penalty FROM e)
"""


@query(f"{PENALTIES} SELECT term, frequency, penalty FROM p")
def word_penalty(spark, d):
    return _terms(spark, d).select("term", "frequency", scoring.word_penalty(F.col("term"), F.col("frequency")).alias("penalty"))


QUALITY = f"""round(round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, least(1.0::DOUBLE, length(term) / 20) * 0.1 + least(1.0::DOUBLE, frequency / 100) * 0.2 + rel * 0.3 + {_C("rel > 0.3", "0.25")} + {N_CTX} / 10 * 0.15
 + CASE WHEN {_any("low", L.TECH_TOKENS)} THEN 0.1 WHEN {_in("low", L.STOP_LOAD)} THEN -0.3 ELSE 0.0 END::DOUBLE) - penalty), 9), 3)"""


@query(f"{PENALTIES}, r AS (SELECT *, CAST(frequency % 10 AS DOUBLE) / 10 AS rel FROM p) SELECT term, {QUALITY} AS quality FROM r")
def quality_score(spark, d):
    rel = F.col("frequency") % 10 / F.lit(10.0)
    return _contexts(spark, d).select("term", scoring.quality_score(F.col("term"), F.col("frequency"), rel, rel > 0.3, F.size("contexts")).alias("quality"))


IND = [
    ("contains_numbers", "regexp_matches(term, '[0-9]')"), ("contains_special_chars", _special("term")), ("very_short", "length(term) <= 2"), ("very_long", "length(term) >= 20"), ("all_uppercase", f"{_upper('term')} AND length(term) > 3"),
    ("contains_dot", "contains(term, '.')"), ("file_extension", _any(_LOW, L.FILE_EXTENSIONS)), ("error_related", _any(_LOW, L.ERROR_TERMS)), ("common_stopword", _in(_LOW, L.STOPWORDS)),
    ("identifier_prefix", "(" + " OR ".join(f"starts_with(lower(term), '{p}')" for p in L.ID_PREFIXES) + ")"), ("web_related", _any(_LOW, L.WEB_PATTERNS)), ("version_pattern", _any(_LOW, L.VERSION_PATTERNS)),
]
_HAS = lambda *n: "(" + " OR ".join(f"list_contains(ind, '{x}')" for x in n) + ")"
TECH = _first(
    [
        (_HAS("common_stopword", "error_related", "very_short"), "FALSE"), (_HAS("file_extension", "version_pattern", "web_related", "contains_numbers"), "TRUE"),
        (f"({_HAS('all_uppercase')} AND length(term) >= 3) OR ({_HAS('contains_special_chars')} AND length(term) >= 3 AND regexp_matches(term, '[\\p{{L}}\\p{{N}}]')) OR {_HAS('contains_dot')}", "TRUE"),
        (_any(_LOW, L.TECH_DOMAINS), "TRUE"),
    ],
    r"length(term) >= 4 AND (regexp_matches(term, '^[A-Za-z]+\d+') OR regexp_matches(term, '^\d+[A-Za-z]+') OR (regexp_matches(term, '^[A-Za-z0-9._-]+$') AND regexp_matches(term, '\d') AND regexp_matches(term, '[A-Za-z]')))",
)
RATES = "SELECT term, frequency, contexts, CAST(frequency % 11 AS DOUBLE) / 10 AS score, CAST(frequency % 7 AS DOUBLE) / 6 AS coverage, CAST(length(term) % 5 AS DOUBLE) / 4 AS same FROM (" + X.CONTEXTS + ") AS t"
TRANSLATABLE = f"""
i AS (SELECT *, list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in IND)}], lambda x: x IS NOT NULL) AS ind FROM ({RATES}) AS r),
h AS (SELECT *, {TECH} AS tech, CASE WHEN score = 0 OR coverage = 0 THEN 'UNTRANSLATABLE' WHEN score < 0.5 OR coverage < 0.5 OR len(ind) >= 3 THEN 'PARTIALLY_TRANSLATABLE' ELSE 'FULLY_TRANSLATABLE' END AS category FROM i),
tr AS (SELECT *, CASE category WHEN 'UNTRANSLATABLE' THEN CASE WHEN same > 0.8 AND tech THEN 'APPROVE_AS_NEW_TERM' WHEN tech THEN 'CONDITIONAL_APPROVAL_AS_NEW_TERM' WHEN {_HAS("common_stopword", "error_related")} THEN 'REJECT' ELSE 'NEEDS_REVIEW_FOR_NEW_TERM' END
 WHEN 'PARTIALLY_TRANSLATABLE' THEN CASE WHEN coverage >= 0.3 AND score >= 0.3 THEN 'CONDITIONAL_APPROVAL' ELSE 'NEEDS_REVIEW' END
 ELSE CASE WHEN coverage >= 0.8 AND score >= 0.8 THEN 'APPROVE' WHEN coverage >= 0.6 AND score >= 0.6 THEN 'CONDITIONAL_APPROVAL' ELSE 'NEEDS_REVIEW' END END AS action FROM h)
"""


def _rates(spark, d):
    return _contexts(spark, d).withColumns({"score": F.col("frequency") % 11 / F.lit(10.0), "coverage": F.col("frequency") % 7 / F.lit(6.0), "same": F.length("term") % 5 / F.lit(4.0)})


@query(f"""WITH {TRANSLATABLE} SELECT term, category, category <> 'UNTRANSLATABLE' AS is_translatable, tech AS has_technical_value, array_to_string(ind, ',') AS indicators, action,
 CASE WHEN category = 'UNTRANSLATABLE' AND tech THEN CASE WHEN same > 0.8 THEN 'high' ELSE 'medium' END ELSE 'low' END AS new_term FROM tr""")
def translatability(spark, d):
    t = _rates(spark, d).select("term", decide.translatability(F.col("term"), F.col("score"), F.col("coverage"), F.col("same")).alias("x"))
    return t.select("term", "x.category", "x.is_translatable", "x.has_technical_value", F.array_join("x.indicators", ",").alias("indicators"), "x.action", "x.new_term")


FINAL = f"""round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN frequency % 5 = 0 THEN 0.4 ELSE ml * 0.25 END::DOUBLE + CASE WHEN frequency % 3 = 0 THEN 0.0 ELSE ml * 0.2 END::DOUBLE
 + CASE category WHEN 'UNTRANSLATABLE' THEN CASE WHEN tech AND same > 0.8 THEN 0.08 WHEN tech THEN 0.06 ELSE -0.05 END WHEN 'PARTIALLY_TRANSLATABLE' THEN CASE WHEN coverage >= 0.3 THEN 0.04 ELSE -0.02 END ELSE 0.08 END::DOUBLE
 - least(0.05::DOUBLE, len(ind) * 0.01::DOUBLE)
 + CASE WHEN frequency % 9 = 0 THEN -0.05 WHEN coverage >= 0.95 THEN 0.15 WHEN coverage >= 0.85 THEN 0.12 WHEN coverage >= 0.70 THEN 0.09 WHEN coverage >= 0.50 THEN 0.06 WHEN coverage >= 0.30 THEN 0.03 ELSE 0.0 END::DOUBLE
 + CASE WHEN frequency % 8 = 0 THEN -0.03 WHEN iss = 0 AND frequency % 4 = 1 THEN CASE WHEN ver >= 10 THEN 0.10 WHEN ver >= 5 THEN 0.09 ELSE 0.08 END WHEN iss = 0 THEN -0.02 WHEN iss <= 2 THEN -0.01 WHEN iss <= 5 THEN -0.03 ELSE -least(0.08::DOUBLE, iss * 0.015::DOUBLE) END::DOUBLE
 + CASE WHEN frequency % 6 <> 0 THEN ml * 0.08 + same * 0.07 + 0.02 WHEN frequency % 9 <> 0 AND frequency % 8 <> 0 THEN 0.03 ELSE 0.0 END::DOUBLE - 0.03::DOUBLE)), 6)"""
DECIDE = """CASE WHEN contains(action, 'NEW_TERM') THEN CASE WHEN final_score >= CASE WHEN n = 1 THEN 0.7 ELSE 0.6 END THEN 'approved_as_new_term' WHEN final_score >= CASE WHEN n = 1 THEN 0.5 ELSE 0.4 END THEN 'conditionally_approved_as_new_term' ELSE 'needs_review_for_new_term' END
 ELSE CASE WHEN final_score >= CASE WHEN n = 1 THEN 0.55 ELSE 0.48 END THEN 'approved' WHEN final_score >= CASE WHEN n = 1 THEN 0.45 ELSE 0.38 END THEN 'conditionally_approved' WHEN final_score >= CASE WHEN n = 1 THEN 0.38 ELSE 0.32 END THEN 'needs_review' ELSE 'rejected' END END"""
TIER = "CASE WHEN final_score >= 0.85 THEN 'Exceptional' WHEN final_score >= 0.70 THEN 'High Quality' WHEN final_score >= 0.55 THEN 'Good Quality' WHEN final_score >= 0.40 THEN 'Standard Quality' WHEN final_score >= 0.25 THEN 'Below Standard' ELSE 'Poor Quality' END"
DECISIONS = f"WITH {TRANSLATABLE}, z AS (SELECT *, score AS ml, frequency % 13 AS iss, frequency % 12 AS ver, len({_words('term')}) AS n FROM tr), f AS (SELECT *, {FINAL} AS final_score FROM z), dd AS (SELECT *, {DECIDE} AS status, {TIER} AS quality_tier FROM f)"


def _decisions(spark, d):
    f, ml = F.col("frequency"), F.col("score")
    x = _rates(spark, d).withColumn("tr", decide.translatability(F.col("term"), ml, F.col("coverage"), F.col("same")))
    n_issues = f % 13
    passed = F.when(f % 8 != 0, (n_issues == 0) & (f % 4 == 1))
    score = decide.final_score(F.when(f % 5 != 0, ml), F.when(f % 3 != 0, ml), F.col("tr"), F.col("coverage"), F.col("same"), f % 9 != 0, passed, n_issues, f % 12, F.when(f % 6 != 0, ml), F.col("same"), F.lit(-0.03))
    y = x.withColumn("final_score", score)
    return y.withColumn("status", decide.decision(F.col("final_score"), F.col("tr")["action"], F.col("term"))).withColumn("quality_tier", decide.quality_tier(F.col("final_score")))


@query(f"{DECISIONS} SELECT term, final_score, status, quality_tier FROM dd")
def final_decision(spark, d):
    return _decisions(spark, d).select("term", "final_score", "status", "quality_tier")


@query(DECISIONS + " SELECT count(*) AS total_decisions, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}, round(count(*) FILTER (WHERE status = '{s}') / count(*) * 100, 1) AS {s}_rate" for s in decide.STATUSES) + ", round(avg(final_score), 3) AS average_score FROM dd")
def decision_summary(spark, d):
    return decide.decision_summary(_decisions(spark, d))


@query(f"{DECISIONS} SELECT status, count(*) AS n, round(count(*) / (SELECT count(*) FROM dd) * 100, 1) AS percent FROM dd GROUP BY status")
def run_statistics(spark, d):
    return export.breakdown(_decisions(spark, d))


REVIEW = f"""
WITH t AS (SELECT term, frequency, contexts, {JOINED} AS x, string_split({JOINED}, ' ') AS w FROM ({X.CONTEXTS}) AS t),
k AS (SELECT *, list_filter([{", ".join(f"CASE WHEN contains(x, '{k}') THEN '{k}' END" for k in L.REVIEW_KEYWORDS)}], lambda z: z IS NOT NULL) AS ind FROM t),
h AS (SELECT *, len(list_filter(w, lambda v: len(list_filter(ind[1:3], lambda q: contains(v, q))) > 0)) AS hits FROM k),
s AS (SELECT *, CASE WHEN frequency % 4 = 0 THEN 0.0 ELSE round(least(0.5::DOUBLE, len(ind) * 0.1::DOUBLE + hits * 0.05::DOUBLE), 6) END AS ctx,
 round(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN frequency % 6 = 0 THEN -0.3 ELSE 0.0 END::DOUBLE + least(0.4::DOUBLE, (frequency % 5) * 0.1::DOUBLE) + CASE WHEN {_any("lower(term)", L.INDUSTRY_KEYWORDS)} THEN 0.2 ELSE 0.0 END::DOUBLE)), 6) AS dom FROM h),
r AS (SELECT *, round(ctx * 0.8 + greatest(0.0::DOUBLE, dom) * 0.3 + least(0.25::DOUBLE, (frequency % 4) * 0.08::DOUBLE) + 0.1::DOUBLE - CASE WHEN frequency % 6 = 0 THEN 0.25 ELSE 0.0 END::DOUBLE, 6) AS score FROM s)
"""


@query(f"{REVIEW} SELECT term, array_to_string(ind, ',') AS indicators, hits, ctx, dom, score, CASE WHEN score >= 0.8 THEN 'recommended' WHEN score >= 0.5 THEN 'needs_review' WHEN score >= 0.3 THEN 'low_priority' WHEN frequency % 6 = 0 THEN 'unexpected_duplicate' ELSE 'not_recommended' END AS status FROM r")
def review_score(spark, d):
    f = F.col("frequency")
    t = _contexts(spark, d).withColumn("e", scoring.text_evidence(F.col("contexts"))).withColumn("dom", scoring.domain_relevance(f % 6 == 0, f % 5, F.col("term")))
    t = t.withColumn("score", scoring.review_score(F.col("e.score"), F.col("dom"), f % 4, F.lit(0.1), f % 6 == 0))
    return t.select("term", F.array_join("e.indicators", ",").alias("indicators"), F.col("e.n_hits").alias("hits"), F.col("e.score").alias("ctx"), "dom", "score", scoring.review_status(F.col("score"), f % 6 == 0).alias("status"))


@query(f"""
WITH w AS (SELECT conv_id, turn, string_split_regex({_strip("lower(text)")}, '\\s+') AS w FROM conversations),
h AS (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS i FROM w)
SELECT conv_id, turn, i - 1 AS place, array_to_string(w[greatest(i - 3, 1) : i + 3], ' ') AS around FROM h WHERE contains(w[i], 'thing')
""")
def kwic(spark, d):
    c = X.table(spark, d, "conversations").select("conv_id", "turn", T.words(F.lower("text")).alias("w"))
    at = F.filter(F.transform("w", lambda x, i: F.when(x.contains("thing"), i)), lambda i: i.isNotNull())
    both = F.arrays_zip(at.alias("place"), scoring.kwic(F.col("w"), lambda x: x.contains("thing")).alias("around"))
    return c.select("conv_id", "turn", F.inline(both)).toDF("conv_id", "turn", "place", "around")


ANSWERS = "SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN 'Term found in glossary' WHEN 1 THEN 'No terms found here' WHEN 2 THEN 'Error code: 429 rate limit' WHEN 3 THEN '502 Bad Gateway' ELSE 'it exists; access token Expired' END || ' ' || text AS answer FROM {conversations}"
_ERRORS = _first([(_any("lower(answer)", signs), f"'{name}'") for name, signs in glossary.ERRORS], "NULL")
_NO = glossary.NOT_FOUND


@query(f"WITH a AS ({ANSWERS}) SELECT conv_id, turn, NOT ({_any('lower(answer)', _NO)} OR (contains(lower(answer), 'error') AND contains(lower(answer), 'failed'))) AND (contains(lower(answer), 'found') OR contains(lower(answer), 'exists')) AS hit, {_ERRORS} AS error_class FROM a")
def answer_classes(spark, d):
    """Answers that hold the whole text of each turn."""
    a = X.fixture(spark, d, ANSWERS)
    return a.select("conv_id", "turn", glossary.answer_found(F.col("answer")).alias("hit"), glossary.error_class(F.col("answer")).alias("error_class"))


# store ----------------------------------------------------------------------------------------
STORE_SQL = f"""
WITH a AS ({X.ARRIVALS}), r AS (SELECT *, left(md5(lower(term)), 16) AS term_id, row_number() OVER (PARTITION BY lower(term) ORDER BY seq) AS rn FROM a),
s AS (SELECT term_id, arg_min(term, seq) AS term, min(seen_at) AS first_seen, arg_max(seen_at, rn) FILTER (WHERE rn <= 2) AS last_seen, least(count(*), 2) AS occurrence_count,
 count(DISTINCT source_file) FILTER (WHERE rn <= 2) AS n_sources, count(*) >= 2 AS promoted FROM r GROUP BY term_id)
"""


def _store(spark, d):
    return store.upsert(store.empty(spark), X.fixture(spark, d, X.ARRIVALS))


@query(f"{STORE_SQL} SELECT term_id, term, occurrence_count, n_sources, promoted, CASE WHEN promoted THEN 'promoted' ELSE 'stored' END AS status, epoch_us(last_seen) AS last_seen_us FROM s")
def store_replay(spark, d):
    s = _store(spark, d)
    return s.select("term_id", "term", "occurrence_count", F.size("source_files").alias("n_sources"), F.col("promoted_to_processing").alias("promoted"), "status", F.unix_micros(F.col("last_seen").cast("timestamp")).alias("last_seen_us"))


@query(f"""
{STORE_SQL}, x AS (SELECT max(ts) AS as_of FROM events)
SELECT 'total_terms' AS measure, NULL AS key, count(*) AS n FROM s UNION ALL SELECT 'ready_for_processing', NULL, count(*) FROM s WHERE promoted UNION ALL SELECT 'recent_activity', NULL, count(*) FROM s, x WHERE last_seen > as_of - INTERVAL 1 DAY
UNION ALL SELECT 'by_status', CASE WHEN promoted THEN 'promoted' ELSE 'stored' END, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'by_frequency', CAST(occurrence_count AS VARCHAR), count(*) FROM s GROUP BY 2
""")
def store_stats(spark, d):
    as_of = X.table(spark, d, "events").agg(F.max("ts").alias("t")).first()[0]
    return store.statistics(_store(spark, d), F.lit(as_of))


@query(f"{STORE_SQL} SELECT term_id, term FROM s WHERE contains(lower(term), 'click') AND occurrence_count >= 2")
def store_search(spark, d):
    return store.search(_store(spark, d), pattern="CLICK", least=2, status="promoted").select("term_id", "term")


@query(f"{STORE_SQL}, x AS (SELECT max(ts) AS as_of FROM events) SELECT term_id FROM s, x WHERE NOT (NOT promoted AND last_seen < as_of - INTERVAL 3 DAY)")
def store_cleanup(spark, d):
    as_of = X.table(spark, d, "events").agg(F.max("ts").alias("t")).first()[0]
    return store.cleanup(_store(spark, d), F.lit(as_of), 3).select("term_id")


@query(f"WITH a AS ({X.ARRIVALS}) SELECT seq, row_number() OVER (PARTITION BY lower(term) ORDER BY seq) <= 2 AS accepted FROM a")
def store_accepted(spark, d):
    return store.accepted(store.empty(spark), X.fixture(spark, d, X.ARRIVALS)).select("seq", "accepted")


CACHE = "SELECT 'k' || CAST(user_id % 200 AS VARCHAR(20)) AS cache_key, event_type AS result, ts AS created_at, event_id FROM {events}"


@query(f"""
WITH c AS ({CACHE}), x AS (SELECT max(ts) AS as_of FROM events), l AS (SELECT cache_key, max(created_at) AS last FROM c, x WHERE created_at >= as_of - INTERVAL 2 DAY GROUP BY cache_key)
SELECT 'k' || CAST(i AS VARCHAR) AS cache_key, last IS NOT NULL AS hit FROM (SELECT unnest(range(0, 250)) AS i) AS r LEFT JOIN l ON l.cache_key = 'k' || CAST(i AS VARCHAR)
""")
def cache_hits(spark, d):
    """Which requests a cache with a limited age answers."""
    cache = X.fixture(spark, d, CACHE)
    as_of = X.table(spark, d, "events").agg(F.max("ts").alias("t")).first()[0]
    requests = spark.range(250).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("cache_key"))
    return store.cached(cache, requests, F.lit(as_of), 2).select("cache_key", F.col("result").isNotNull().alias("hit"))


# batches --------------------------------------------------------------------------------------
@query("SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 7) + 5 AS BIGINT) AS batch_id FROM orders")
def batch_assign(spark, d):
    return batches.assign(X.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7, 5)


_MISSING = f"WITH b AS ({X.BATCHES}), m AS (SELECT batch_id FROM (SELECT unnest(range((SELECT min(batch_id) FROM b), (SELECT max(batch_id) + 1 FROM b))) AS batch_id) AS u WHERE batch_id NOT IN (SELECT batch_id FROM b))"


@query(f"{_MISSING} SELECT batch_id FROM m")
def missing_batches(spark, d):
    return batches.missing_numbers(X.fixture(spark, d, X.BATCHES))


@query(f"{_MISSING} SELECT min(batch_id) AS first, max(batch_id) AS last, count(*) AS n, CASE WHEN count(*) = 1 THEN CAST(min(batch_id) AS VARCHAR) ELSE min(batch_id) || '-' || max(batch_id) END AS label FROM (SELECT batch_id, batch_id - row_number() OVER (ORDER BY batch_id) AS g FROM m) AS x GROUP BY g")
def missing_ranges(spark, d):
    return batches.ranges(batches.missing_numbers(X.fixture(spark, d, X.BATCHES)))


@query(f"WITH b AS ({X.BATCHES}) SELECT coalesce(max(batch_id), 0) + 1 AS next_batch FROM b")
def next_batch(spark, d):
    return batches.next_number(X.fixture(spark, d, X.BATCHES))


@query("WITH b AS (SELECT o_orderkey, floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 100) + 1 AS batch_id FROM orders) SELECT o_orderkey, CAST(batch_id AS BIGINT) AS batch_id FROM b WHERE batch_id IN (2, 3, 5)")
def gap_slice(spark, d):
    targets = spark.createDataFrame([(2,), (3,), (5,)], "batch_id long")
    return batches.refill(X.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100, targets)


RESULTS = "SELECT l_orderkey % 50 AS batch_id, l_returnflag <> 'R' AS ok FROM {lineitem}"


@query(f"SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok, round(count(*) FILTER (WHERE ok) / count(*) * 100, 6) AS success_rate FROM ({RESULTS}) AS r GROUP BY batch_id")
def consolidate(spark, d):
    return batches.consolidate(X.fixture(spark, d, RESULTS))


@query(f"SELECT count(DISTINCT batch_id) AS batches, count(*) AS results, count(*) FILTER (WHERE ok) AS successes, round(count(*) FILTER (WHERE ok) / count(*) * 100, 6) AS success_rate FROM ({RESULTS}) AS r")
def batch_totals(spark, d):
    return batches.batch_totals(batches.consolidate(X.fixture(spark, d, RESULTS)))


@query(f"{REVIEW}, s2 AS (SELECT CASE WHEN score >= 0.8 THEN 'recommended' WHEN score >= 0.5 THEN 'needs_review' WHEN score >= 0.3 THEN 'low_priority' WHEN frequency % 6 = 0 THEN 'unexpected_duplicate' ELSE 'not_recommended' END AS status FROM r) SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("recommended", "needs_review", "low_priority", "unexpected_duplicate", "not_recommended")) + " FROM s2")
def review_summary(spark, d):
    return batches.status_summary(review_score(spark, d))


@query("SELECT event_id, json_valid(CASE WHEN event_id % 3 = 0 THEN left(props, 3) ELSE props END) AS valid FROM events")
def json_integrity(spark, d):
    from ..sources import readers

    e = X.table(spark, d, "events")
    return e.select("event_id", readers.json_ok(F.when(F.col("event_id") % 3 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))).alias("valid"))


@query(f"{DECISIONS} SELECT term, 'needs_review' AS status, 0.5::DOUBLE AS final_score FROM dd ORDER BY frequency, term LIMIT 100")
def fallback_decisions(spark, d):
    return decide.fallback_decisions(_decisions(spark, d).withColumn("index", F.col("frequency")))


@query(r"""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '\[/?[a-zA-Z0-9_-]+\]', '', 'g'), '[\[\]]', '', 'g'), '<[^>]*>', '', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g'), '\s+', ' ', 'g') AS cleaned FROM pages
""")
def json_text_clean(spark, d):
    return X.table(spark, d, "pages").select("page_id", T.json_text_clean(F.col("html")).alias("cleaned"))


# export ---------------------------------------------------------------------------------------
_P3 = "lower(array_to_string(contexts[1:3], ' '))"
_FIRST = "lower(contexts[1])"
_PATTERN_SCORES = ", ".join(f"{_count(_P3, words)} AS s_{name}" for name, words in L.CONTEXT_PATTERNS)
_TOP = "greatest(" + ", ".join(f"s_{n}" for n, _ in L.CONTEXT_PATTERNS) + ")"
_PATTERN = _first([(f"{_TOP} = 0", "NULL")] + [(f"s_{n} = {_TOP}", f"'{n}'") for n, _ in L.CONTEXT_PATTERNS], "NULL")
_DESCRIBE = f"""CASE WHEN {N_CTX} = 0 THEN CASE WHEN contains(decision, 'CONDITIONALLY') THEN '{context.CONDITIONAL}' ELSE '{context.APPROVED}' END
 WHEN pattern = 'command' THEN 'Command used in CAD software to ' || {_first([(f"contains({_FIRST}, '{a}')", f"'{a} objects or elements'") for a in L.CONTEXT_ACTIONS], "'perform operations'")}
 WHEN pattern = 'feature' THEN 'Feature that ' || {_first([(f"contains({_FIRST}, 'convert')", "'converts or transforms data'"), (f"contains({_FIRST}, 'manage')", "'manages system resources'"), (f"contains({_FIRST}, 'display')", "'displays information or graphics'")], "'provides functionality'")} || ' in design applications'
 WHEN pattern = 'process' THEN 'Process of ' || {_first([(f"contains({_FIRST}, 'render')", "'rendering graphics or models'"), (f"contains({_FIRST}, 'export')", "'exporting data or files'"), (f"contains({_FIRST}, 'import')", "'importing external data'")], "'processing data or operations'")} || ' in engineering workflows'
 WHEN pattern = 'object' THEN 'Design element used for design and modeling purposes in 3D modeling' WHEN pattern = 'interface' THEN 'Interface element for user interaction and control in software applications'
 WHEN pattern = 'file' THEN 'File operation for ' || {_first([(f"contains({_FIRST}, 'save')", "'saving project data'"), (f"contains({_FIRST}, 'load')", "'loading external files'")], "'managing project files'")} || ' in CAD systems'
 WHEN pattern = 'modeling' THEN '3D modeling tool for creating and manipulating 3D geometry' WHEN pattern = 'cad' THEN 'CAD function for technical design and documentation in technical drawings'
 WHEN pattern = 'graphics' THEN 'Graphics feature for visual representation and rendering in visual design' WHEN length(contexts[1]) < 10 THEN '{context.APPROVED}' WHEN length(contexts[1]) <= 150 THEN trim(contexts[1])
 WHEN length(split_part(contexts[1], '.', 1)) <= 150 THEN trim(split_part(contexts[1], '.', 1)) || '.' ELSE left(contexts[1], 147) || '...' END"""
_EXPORT = f"SELECT *, CASE WHEN frequency % 3 = 0 THEN 'APPROVED' WHEN frequency % 3 = 1 THEN 'CONDITIONALLY_APPROVED' ELSE 'REJECTED' END AS decision, {_PATTERN_SCORES} FROM ({X.CONTEXTS}) AS t"


def _export(spark, d):
    f = F.col("frequency")
    return _contexts(spark, d).withColumn("decision", F.when(f % 3 == 0, "APPROVED").when(f % 3 == 1, "CONDITIONALLY_APPROVED").otherwise("REJECTED"))


@query(f"WITH t AS ({_EXPORT}), p AS (SELECT *, {_PATTERN} AS pattern FROM t) SELECT term, pattern, {_DESCRIBE} AS description FROM p")
def pattern_context(spark, d):
    c = F.col("contexts")
    return _export(spark, d).select("term", context.pattern(c).alias("pattern"), context.describe(c, F.col("decision")).alias("description"))


@query(f"WITH t AS ({_EXPORT}), p AS (SELECT *, {_PATTERN} AS pattern FROM t) SELECT term AS source, term AS target, {_DESCRIBE} AS description, array_to_string(contexts, '; ') AS context FROM p WHERE contains(decision, 'APPROVED')")
def approved_export(spark, d):
    return export.approved_export(_export(spark, d).withColumnRenamed("contexts", "texts"))


@query(f"SELECT 't' || event_id AS term, 'completed' AS status FROM events")
def salvage_json(spark, d):
    from ..sources import readers

    damaged = F.concat(F.lit('[{"term": "t'), F.col("event_id").cast("string"), F.lit('", "status": "completed", "n": 1}, {"term": "broken'))
    return readers.salvage(X.table(spark, d, "events").select(damaged.alias("text")), "term string, status string")


CURATED = rf"""SELECT term, frequency, CAST([] AS VARCHAR[]) AS contexts FROM (
  SELECT term, count(DISTINCT doc_id) AS frequency FROM (SELECT doc_id, {_clean("w")} AS term FROM (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents) AS x) AS y WHERE term IS NOT NULL GROUP BY term HAVING count(DISTINCT doc_id) >= 2) AS z"""


def _over(sql: str) -> str:
    """A query on terms and contexts, on the terms of all documents."""
    return sql.replace(X.CONTEXTS, "SELECT * FROM curated")


@query(f"""
WITH curated AS MATERIALIZED ({CURATED}), dic AS (SELECT term, {_dict("term")} AS rule FROM curated),
gen AS ({_over(GENERIC)} SELECT term, votes, {PENALTY} AS penalty FROM g),
rev AS (WITH c AS ({_over(CTX_BASE)}) SELECT term, {CTX_SCORE} AS rel FROM c),
qual AS ({_over(PENALTIES)}, r AS (SELECT p.*, rev.rel FROM p JOIN rev ON rev.term = p.term) SELECT term, frequency, rel, n, {QUALITY} AS quality FROM r),
f AS (SELECT qual.term, frequency, n, rule, votes, gen.penalty AS penalty, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, quality * 0.25 + rel * 0.2 + gen.penalty + 0.25)), 6) AS final_score, '' AS action
  FROM qual JOIN gen ON gen.term = qual.term JOIN dic ON dic.term = qual.term)
SELECT term, frequency, CASE WHEN rule <> 'uncertain' THEN rule IN ('common_word', 'technical_term') END AS in_dictionary, rule AS method, CAST(votes AS BIGINT) AS votes, penalty, final_score,
 {DECIDE} AS status, {TIER} AS quality_tier FROM f
""")
def curated_terms(spark, d):
    """Every term of at least two documents with its dictionary rule, genericness, score and decision."""
    return curate(X.table(spark, d, "documents"))
