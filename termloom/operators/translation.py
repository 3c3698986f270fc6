"""Translations: providers, categories and language tiers, summaries and verification."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions import text as T


class Translator(Protocol):
    """Adds translation to rows (term, language); model-backed ones use an iterator pandas UDF in the last projection."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def glossary_translator(g: DataFrame) -> Translator:
    """The offline translator: a term's glossary target for the language, else the term itself."""

    def run(rows: DataFrame) -> DataFrame:
        targets = g.groupBy(F.col("language"), F.col("source").alias("term")).agg(F.max_by("target", F.struct("load_order", "target")).alias("target"))
        return rows.join(targets, ["language", "term"], "left").withColumn("translation", F.coalesce("target", "term")).drop("target")

    return run


def guarded(rows: DataFrame, valid: DataFrame, translate: Translator) -> DataFrame:
    """rows (term, language) with translation, is_same and error: blank texts and unknown languages pass through."""
    known = valid.select(F.col("language"), F.lit(True).alias("known")).distinct()
    checked = rows.join(known, "language", "left").withColumn("error", F.when(T.strip(F.col("term")) == "", "empty text").when(F.col("known").isNull(), F.concat(F.lit("unsupported language: "), "language"))).drop("known")
    done = translate(checked.where("error is null"))
    passed = checked.where("error is not null").withColumn("translation", F.col("term"))
    out = done.unionByName(passed, allowMissingColumns=True)
    return out.withColumn("is_same", F.lower("translation") == F.lower("term"))


def category(term: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    low = F.lower(term)
    return (
        F.when(T.contains_any(low, L.CATEGORY_TECH), "ultra_technical")
        .when(term.rlike(r"\p{Nd}") & T.contains_any(low, L.CATEGORY_VERSION), "version")
        .when(T.is_upper(term) | T.contains_any(low, lexicon.brand_names), "brand")
        .when(T.contains_any(low, L.CATEGORY_TECHNICAL), "technical")
        .when(T.contains_any(low, L.CATEGORY_BUSINESS), "business")
        .when(T.contains_any(low, L.CATEGORY_COMMON), "common")
        .otherwise("general")
    )


def tier(cat: Column, recent: Column | None = None) -> Column:
    """ultra_minimal, minimal, core or extended; general terms are extended after a recent mean above 0.85."""
    extended = F.lit(False) if recent is None else F.coalesce(recent > 0.85, F.lit(False))
    return F.when(cat.isin("ultra_technical", "version"), "ultra_minimal").when(cat.isin("brand", "technical"), "minimal").when(cat.isin("business", "common"), "core").when(extended, "extended").otherwise("core")


def tier_languages(t: Column) -> Column:
    arrays = {"ultra_minimal": L.MINIMAL_LANGUAGES[:15], "minimal": L.MINIMAL_LANGUAGES, "core": L.CORE_LANGUAGES, "extended": L.EXTENDED_LANGUAGES}
    lit = lambda words: F.array(*(F.lit(w) for w in words))
    return F.when(t == "ultra_minimal", lit(arrays["ultra_minimal"])).when(t == "minimal", lit(arrays["minimal"])).when(t == "extended", lit(arrays["extended"])).otherwise(lit(arrays["core"]))


def recent_average(df: DataFrame, order: str, score: str = "score", n: int = 10, out: str = "recent", by: tuple = (), block: int = 4096) -> DataFrame:
    """df with the mean score of the n rows before each row; null where there are fewer than n.

    Without by the rows of the whole table, in the order of a unique key, are taken in blocks,
    each with the last n rows of the one before it.
    """
    if by:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(-n, -1)
        return df.withColumn(out, F.when(F.count(score).over(w) >= n, F.round(F.avg(score).over(w), 6)))
    from . import batches

    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    rows = batches.numbered(df.select(row.alias("row"), F.col(order).alias("key"), F.col(score).alias("score")), "key", "rn")
    own = F.floor((F.col("rn") - 1) / block)
    rows = rows.withColumn("own", own).withColumn("block", F.explode(F.when((F.col("rn") - 1) % block >= block - n, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy("block").orderBy("rn").rowsBetween(-n, -1)
    rows = rows.withColumn("mean", F.when(F.count("score").over(w) >= n, F.round(F.avg("score").over(w), 6)))
    return rows.where(F.col("own") == F.col("block")).select("row.*", F.col("mean").alias(out))


def expansion(score: Column, done: Column, n: int = 20) -> Column:
    """Up to n extended languages still missing, for nearly perfect scores."""
    extended = F.array(*(F.lit(x) for x in L.EXTENDED_LANGUAGES))
    return F.when(score > 0.98, F.slice(F.array_except(extended, done), 1, n)).otherwise(F.array().cast("array<string>"))


def summary(rows: DataFrame) -> DataFrame:
    """One row for each term of (term, language, translation): counts, code lists and the translatability score."""
    error = F.col("translation").startswith("ERROR:")
    same = ~error & (F.lower("translation") == F.lower("term"))
    kind = F.when(error, "error").when(same, "same").otherwise("translated")
    r = rows.withColumn("kind", kind)
    codes = lambda k: F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("language"))))
    grouped = r.groupBy("term").agg(
        F.count("*").alias("total_languages"), F.count_if(F.col("kind") == "same").alias("same_languages"), F.count_if(F.col("kind") == "translated").alias("translated_languages"),
        F.count_if(F.col("kind") == "error").alias("error_languages"), codes("same").alias("same_language_codes"), codes("translated").alias("translated_language_codes"),
        codes("error").alias("error_language_codes"), F.map_from_entries(F.collect_set(F.struct("language", "translation"))).alias("all_translations"),
    )
    tried = F.col("same_languages") + F.col("translated_languages")
    return grouped.withColumn("translatability_score", F.round(F.when(tried > 0, F.col("translated_languages") / tried).otherwise(0.0), 6)).withColumn(
        "sample_translations", F.transform(F.slice("translated_language_codes", 1, 5), lambda c: F.concat_ws("=", c, F.try_element_at(F.col("all_translations"), c)))
    )


def totals(s: DataFrame) -> DataFrame:
    return s.agg(
        F.count("*").alias("terms"), F.sum("total_languages").alias("translations"), F.sum("translated_languages").alias("translated"), F.sum("same_languages").alias("same"),
        F.sum("error_languages").alias("errors"), F.round(F.avg("translatability_score"), 6).alias("mean_score"), F.array_sort(F.collect_set(tier(category(F.col("term"))))).alias("tiers"),
    )


def efficiency(s: DataFrame, full: int = 202) -> DataFrame:
    """The share of language translations saved against translating every term to all languages, in percent."""
    every = F.count("*") * full
    return s.agg(F.sum("total_languages").alias("processed"), F.round((every - F.sum("total_languages")) / F.greatest(every, F.lit(1)) * 100, 6).alias("saved_percent"))


def issue(term: Column, translation: Column) -> Column:
    """translation_error, empty_translation, suspicious_length or null."""
    return (
        F.when(translation.startswith("ERROR:"), "translation_error").when(translation.isNull() | (T.strip(translation) == ""), "empty_translation")
        .when(F.length(translation) > F.length(term) * 5, "suspicious_length")
    )


def issues(rows: DataFrame) -> DataFrame:
    """(term, language, issue) of the translations that have one."""
    return rows.select("term", "language", issue(F.col("term"), F.col("translation")).alias("issue")).where("issue is not null")


def verified(rows: DataFrame) -> DataFrame:
    """One row for each term: verified languages, issue count, passed. Over-long translations are kept."""
    i = issue(F.col("term"), F.col("translation"))
    kept = i.isNull() | (i == "suspicious_length")
    return rows.groupBy("term").agg(
        F.count_if(i.isNotNull()).alias("verification_issues_count"), (F.count_if(i.isNotNull()) == 0).alias("verification_passed"),
        F.array_sort(F.collect_set(F.when(kept, F.col("language")))).alias("verified_languages"), F.count_if(kept).alias("verified_count"),
    )


def by_index(rows: DataFrame) -> DataFrame:
    """Verified rows in their original order."""
    return rows.orderBy("index", "term")


def consistency(step5: Column, step6: Column) -> Column:
    """The share of the languages of one list that are in the other; 0 where either is empty."""
    n = F.coalesce(F.size(step5), F.lit(0))
    return F.round(F.when((n > 0) & (F.coalesce(F.size(step6), F.lit(0)) > 0), F.size(F.array_intersect(step5, step6)) / n).otherwise(0.0), 6)
