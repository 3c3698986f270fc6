"""Glossaries: pair resolution, substring matches, verdicts, replacement and quality checks.

A glossary is a table (pair, source, target, load_order); later load orders win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions import text as T

#: Glossaries up to so many terms are broadcast for the substring join; larger ones go by q-grams.
BROADCAST_TERMS = 500
#: The longest substring that a term is looked up by.
GRAM = 4
#: Terms that are replaced in one pass.
PASS = 20_000


def with_aliases(g: DataFrame) -> DataFrame:
    """Every pair also under its standard codes and in lower case; explicit pairs win over aliases."""
    src, tgt = F.split("pair", "-")[0], F.split("pair", "-")[1]
    std = F.when(T.standard_code(src).isNotNull() & T.standard_code(tgt).isNotNull(), F.concat_ws("-", T.standard_code(src), T.standard_code(tgt)))
    names = F.array_distinct(F.array_compact(F.array("pair", std, F.lower("pair"))))
    rows = g.where("pair <> 'DNT'").select(F.col("pair").alias("own"), F.explode(names).alias("pair"), "source", "target", "load_order")
    best = F.max_by(F.struct("target", "load_order"), F.struct((F.col("own") == F.col("pair")).cast("int"), "load_order", "target"))
    merged = rows.groupBy("pair", "source").agg(best.alias("b")).select("pair", "source", "b.target", "b.load_order")
    return merged.unionByName(g.where("pair = 'DNT'").select("pair", "source", "target", "load_order"))


def with_default(g: DataFrame) -> DataFrame:
    """The built-in small EN-CS glossary where no EN-CS pair is loaded."""
    spark = g.sparkSession
    default = spark.createDataFrame([(p, s, t, i) for p in ("EN-CS", "en-cs") for i, (s, t) in enumerate(L.DEFAULT_GLOSSARY.items())], "pair string, source string, target string, load_order long")
    have = g.where("pair in ('EN-CS', 'en-cs')").select("pair").distinct()
    return g.select("pair", "source", "target", F.col("load_order").cast("long").alias("load_order")).unionByName(default.join(have, "pair", "left_anti").select("pair", "source", "target", "load_order"))


def last_wins(g: DataFrame) -> DataFrame:
    return g.groupBy("pair", "source").agg(F.max_by("target", F.struct("load_order", "target")).alias("target"))


def pair_candidates(src: Column, tgt: Column) -> Column:
    """Spellings of a pair in the order in which they are tried."""
    s, t = T.language(src), T.language(tgt)
    english = F.when(F.upper(src).isin("EN", "ENG"), "ENG-CSY")
    return F.array_compact(F.array(F.concat_ws("-", F.upper(src), F.upper(tgt)), F.concat_ws("-", F.lower(src), F.lower(tgt)), F.concat_ws("-", s, t), english))


def resolve_pairs(requests: DataFrame, g: DataFrame) -> DataFrame:
    """(src, tgt, pair): the first spelling that has terms."""
    have = g.where("source is not null and source <> ''").select("pair").distinct()
    tried = requests.select("src", "tgt", F.posexplode(pair_candidates(F.col("src"), F.col("tgt"))).alias("rank", "pair"))
    return tried.join(have, "pair").groupBy("src", "tgt").agg(F.min_by("pair", "rank").alias("pair"))


def contained(texts: DataFrame, terms: DataFrame, *, text: str = "text", term: str = "source", limit: int | None = None) -> DataFrame:
    """texts joined to the terms that are substrings of them (case matters, no word bounds).

    Up to limit terms, each of a bounded length, are broadcast to a nested loop; more are found
    by a shared q-gram. Both give the same rows.
    """
    limit = BROADCAST_TERMS if limit is None else limit
    terms = terms.where(F.col(term).isNotNull() & (F.col(term) != ""))
    n, longest = terms.select(F.length(term).alias("n")).limit(limit + 1).agg(F.count("*"), F.max("n")).first()
    if n <= limit and (longest or 0) <= 1000:
        return texts.join(F.broadcast(terms), F.col(text).contains(F.col(term)))
    return contained_by_grams(texts, terms, text=text, term=term)


def _grams(value: Column, q: int) -> Column:
    """The distinct substrings of q characters; none of a shorter text."""
    n = F.length(value) - q + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(value, i, F.lit(q)))))


def contained_by_grams(texts: DataFrame, terms: DataFrame, *, text: str = "text", term: str = "source") -> DataFrame:
    """Texts and terms joined on the term's rarest gram, then checked.

    Only (hash of the text, gram) is exploded and shuffled, and of it only grams that a term has;
    the texts themselves are joined once, to the pairs found.
    """
    body = texts.select(text).where(F.col(text).isNotNull()).distinct().select(F.xxhash64(text).alias("h"), F.col(text).alias("body"))
    names = terms.select(F.col(term).alias("name")).distinct()
    own = in_texts = None
    for q in range(1, GRAM + 1):
        mine = names.where(F.length("name") == q if q < GRAM else F.length("name") >= q).select("name", F.explode(_grams(F.col("name"), q)).alias("gram"))
        found = body.select("h", F.explode(_grams(F.col("body"), q)).alias("gram"))
        found = found.join(mine.select("gram").distinct(), "gram", "left_semi")
        own = mine if own is None else own.unionByName(mine)
        in_texts = found if in_texts is None else in_texts.unionByName(found)
    common = in_texts.groupBy("gram").agg(F.count("*").alias("n"))
    key = own.join(common, "gram").groupBy("name").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    pairs = in_texts.join(key, "gram").select("h", "name").distinct()
    every = lambda df: F.struct(*(F.col(f"`{c}`") for c in df.columns))
    left = texts.select(every(texts).alias("left"), F.col(text).alias("body"), F.xxhash64(text).alias("h"))
    right = terms.select(every(terms).alias("right"), F.col(term).alias("name"))
    hits = left.join(pairs, "h").where(F.contains("body", "name"))
    return hits.join(right, "name").select("left.*", "right.*")


def used_terms(texts: DataFrame, g: DataFrame, pair: str, *, key: str = "doc_id") -> DataFrame:
    """(key, term, kind): glossary terms in a text, and do-not-translate terms not already found."""
    found = contained(texts, g.where(F.col("pair") == pair).select("source").distinct()).select(key, F.col("source").alias("term"), F.lit("glossary").alias("kind"))
    dnt = contained(texts, g.where("pair = 'DNT'").select("source").distinct()).select(key, F.col("source").alias("term"), F.lit("dnt").alias("kind"))
    return found.unionByName(dnt.join(found.select(key, "term"), [key, "term"], "left_anti").select(key, "term", "kind"))


def term_details(used: DataFrame, g: DataFrame, pair: str) -> DataFrame:
    """used with the translation of glossary terms; do-not-translate terms stay as they are."""
    targets = last_wins(g.where(F.col("pair") == pair)).select(F.col("source").alias("term"), "target")
    return used.join(targets, "term", "left").withColumn("translation", F.when(F.col("kind") == "dnt", F.col("term")).otherwise(F.col("target"))).drop("target")


def verdict(terms: DataFrame, g: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(existing, new): terms that contain a glossary term, and the others."""
    known = contained(terms.select("term").distinct(), g.select("source").distinct(), text="term").select("term").distinct()
    return terms.join(known, "term", "left_semi"), terms.join(known, "term", "left_anti")


def related(terms: DataFrame, g: DataFrame, each: int = 5) -> DataFrame:
    """(term, duplicates, related): equal sources, and sources that hold or are held by the term, up to each for a pair."""
    low_t, low_s = F.lower("term"), F.lower("source")
    s = g.select("pair", "source").distinct().withColumn("low_s", low_s)
    t = terms.select("term").distinct().withColumn("low_t", low_t)
    # either way by contained(), which checks the size of the side it broadcasts
    inside, around = contained(t, s, text="low_t", term="low_s"), contained(s, t, text="low_s", term="low_t")
    hits = inside.unionByName(around).select("term", "pair", "source").distinct()
    rank = F.row_number().over(Window.partitionBy("term", "pair").orderBy("source"))
    ranked = hits.withColumn("rank", rank)
    return ranked.groupBy("term").agg(F.count_if(low_t == low_s).alias("duplicates"), F.array_sort(F.collect_set(F.when(F.col("rank") <= each, F.col("source")))).alias("related"))


def replace_terms(text: Column, pairs: Column, dnt: Column) -> Column:
    """Replace sources by targets, longest first, each on the result so far; dnt terms are kept.

    pairs: array of struct(source, target); dnt: array of strings. Order: length, then text.
    """
    longest = F.array_sort(pairs, lambda a, b: F.coalesce(F.nullif(F.length(b["source"]) - F.length(a["source"]), F.lit(0)), F.when(a["source"] < b["source"], -1).when(a["source"] > b["source"], 1).otherwise(0)))
    keep = F.array_sort(dnt, lambda a, b: F.coalesce(F.nullif(F.length(b) - F.length(a), F.lit(0)), F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    marked = F.transform(keep, lambda t, i: F.struct(t.alias("term"), F.concat(F.lit("__DNT_PLACEHOLDER_"), i.cast("string"), F.lit("__")).alias("mark")))
    out = F.aggregate(marked, text, lambda acc, m: F.replace(acc, m["term"], m["mark"]))
    out = F.aggregate(longest, out, lambda acc, p: F.replace(acc, p["source"], p["target"]))
    return F.aggregate(marked, out, lambda acc, m: F.replace(acc, m["mark"], m["term"]))


def _blocks(rows: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """(block, items): the rows' structs, longest key first, then by text, in blocks of size; block 0 comes first."""
    from . import batches

    order = F.concat(F.lpad((F.lit(1 << 30) - F.length(key)).cast("string"), 10, "0"), F.lit("/"), key)
    placed = batches.numbered(rows.withColumn("place", order), "place")
    item = F.struct("rn", F.col(key).alias("source"), F.col(value).alias("target"))
    return placed.groupBy(F.floor((F.col("rn") - 1) / size).cast("long").alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items"))


def replaced(texts: DataFrame, g: DataFrame, pair: str, *, text: str = "text", out: str = "replaced", size: int | None = None) -> DataFrame:
    """texts with the column out: sources replaced by targets as in replace_terms(), for a glossary of any size.

    The ordered list is applied in passes over blocks of size terms, and only one block is
    broadcast at a time.
    """
    size = PASS if size is None else size
    own = last_wins(g.where(F.col("pair") == pair).where("source <> ''")).select("source", "target")
    dnt = g.where("pair = 'DNT' and source <> ''").select("source").distinct()
    marks = _blocks(dnt.withColumn("target", F.lit("")), "source", "target", size)
    pairs = _blocks(own, "source", "target", size)
    done = texts.withColumn(out, F.col(text))
    mark = lambda m: F.concat(F.lit("__DNT_PLACEHOLDER_"), (m["rn"] - 1).cast("string"), F.lit("__"))

    def each(df: DataFrame, blocks: DataFrame, step) -> DataFrame:
        for r in blocks.select("block").orderBy("block").collect():
            one = blocks.where(F.col("block") == r["block"]).select("items")
            df = df.crossJoin(F.broadcast(one)).withColumn(out, F.aggregate("items", F.col(out), step)).drop("items")
        return df

    done = each(done, marks, lambda acc, m: F.replace(acc, m["source"], mark(m)))
    done = each(done, pairs, lambda acc, m: F.replace(acc, m["source"], m["target"]))
    return each(done, marks, lambda acc, m: F.replace(acc, mark(m), m["source"]))


def statistics(g: DataFrame) -> DataFrame:
    """(pair, source_language, target_language, n_terms)."""
    return last_wins(g).groupBy("pair").agg(F.count("*").alias("n_terms")).select("pair", F.split("pair", "-")[0].alias("source_language"), F.try_element_at(F.split("pair", "-"), F.lit(2)).alias("target_language"), "n_terms")


def content_issues(g: DataFrame, *, file: str = "file") -> DataFrame:
    """(file, line columns, issue flags): rows of glossary files that break a rule."""
    def bad(c: str) -> list[Column]:
        v = F.col(c)
        return [
            (T.strip(v) == "").alias(f"empty_{c}"), (v != T.strip(v)).alias(f"space_{c}"), v.contains(" ").alias(f"nbsp_{c}"), v.contains('"').alias(f"quote_{c}"),
        ]

    copies = g.groupBy(file, "source").agg((F.count("*") > 1).alias("duplicate"))
    return g.join(copies, [file, "source"], "left").select(file, "source", "target", F.coalesce("duplicate", F.lit(False)).alias("duplicate"), (F.col("source").isNull() & F.col("target").isNull()).alias("empty_line"), *bad("source"), *bad("target"))


def header_ok(first_line: Column) -> Column:
    """The first line of a glossary file is exactly source,target (a byte order mark may precede it)."""
    return F.regexp_replace(F.regexp_replace(first_line, "^﻿", ""), "\r$", "") == "source,target"


#: What a free-text answer says when a term isn't known; the batch form has a list of its own.
_NONE = ("no recognized glossary terminology terms were found", "no glossary terms", "no terms found")
_FAILED = ("analysis failed", "authentication issues", "requires manual review", "rate limit", "error code: 429")
NOT_FOUND = (*_NONE, "not found", *_FAILED)
NOT_FOUND_BATCH = (*_NONE, "no task provided", "no task was provided", *_FAILED)


def _denied(low: Column, phrases: tuple) -> Column:
    return T.contains_any(low, phrases) | (low.contains("error") & low.contains("failed"))


def answer_found(answer: Column) -> Column:
    """Whether a free-text answer says that a term is known."""
    low = F.lower(answer)
    return ~_denied(low, NOT_FOUND) & T.contains_any(low, ("found", "exists"))


def answer_found_batch(answer: Column) -> Column:
    """The batch variant: known unless the answer says that there are no terms, no task or an error."""
    return ~_denied(F.lower(answer), NOT_FOUND_BATCH)


#: What marks each class of error, in the order in which the classes are tried.
ERRORS = (
    ("token_expired", ("401", "unauthorized", "access token", "expired", "invalid audience", "token is missing", "authentication failed", "credential")),
    ("server", ("500", "502", "503", "504", "internal server error", "bad gateway", "service unavailable", "gateway timeout")),
    ("content_filter", ("content_filter", "content filter", "content policy", "filtered", "inappropriate content", "policy violation", "responsibleaipolicyviolation", "jailbreak")),
    ("xml", ("closing tag", "doesn't match any open tag", "xml", "parsing error", "malformed", "invalid xml", "tag mismatch")),
)


def error_class(message: Column) -> Column:
    """token_expired, server, content_filter, xml or null."""
    return T.first_of(((T.contains_any(F.lower(message), signs), name) for name, signs in ERRORS), F.lit(None).cast("string"))
