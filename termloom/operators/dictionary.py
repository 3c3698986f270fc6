"""Dictionary classification: cheap rules first, the word list only for undecided terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T


def classify(term: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """struct(in_dictionary, method, confidence); in_dictionary is null where the word list must decide."""
    w = T.strip(term)
    low = F.lower(w)

    def out(found, method, confidence):
        return F.struct(F.lit(found).cast("boolean").alias("in_dictionary"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))

    return (
        F.when(F.length(w) < 2, out(False, "too_short", "high"))
        .when(~w.rlike(r"^[a-zA-Z'-]+$"), out(False, "non_alphabetic", "high"))
        .when(low.isin(list(lexicon.common_words)), out(True, "common_word", "high"))
        .when(low.isin(list(lexicon.technical_terms)), out(True, "technical_term", "medium"))
        .when(F.length(w) > 25, out(False, "too_long", "medium"))
        .when(low.rlike(r"(.{3,})\1"), out(False, "repeating_pattern", "high"))
        .when(low.rlike(r"([a-z])\1{2,}"), out(False, "consecutive_letters", "medium"))
        .otherwise(out(None, "uncertain", "unknown"))
    )


def variations(word: Column) -> Column:
    """Forms of a lower-case word with a plain suffix taken off."""

    def cut(suffix: str, longer: int) -> Column:
        return F.when(word.endswith(suffix) & (F.length(word) > longer), F.substring(word, F.lit(1), F.length(word) - len(suffix)))

    return F.array_distinct(F.array_compact(F.array(cut("s", 3), cut("ed", 4), cut("ing", 5), cut("ly", 4))))


def classify_terms(df: DataFrame, words: DataFrame, lexicon: L.Lexicon = L.DEFAULT, lemmas: DataFrame | None = None) -> DataFrame:
    """df with in_dictionary, method, confidence and found_as; words: a table with the column word.

    lemmas: a table (word, lemma); its lemmas are tried before the forms without a plain suffix,
    the first in their order. Only undecided terms have a key for the joins, so decided ones never reach the word list.
    """
    c = df.withColumn("c", classify(F.col("term"), lexicon))
    key = F.when(F.col("c.in_dictionary").isNull(), F.lower(T.strip(F.col("term"))))
    vocabulary = words.select(F.lower("word").alias("word")).distinct()
    asked = c.select(key.alias("key")).where("key is not null").distinct()
    direct = asked.join(vocabulary, asked["key"] == vocabulary["word"], "left_semi").select("key", F.lit("nltk_direct").alias("how"), F.col("key").alias("found_as"))
    forms = asked.select("key", F.posexplode(variations(F.col("key"))).alias("at", "word"))
    if lemmas is not None:
        base = lemmas.select(F.lower("word").alias("key"), F.lower("lemma").alias("word")).where("word <> key").distinct()
        forms = forms.unionByName(asked.join(base, "key").select("key", F.lit(-1).alias("at"), "word"))
    forms = forms.join(vocabulary, "word")
    varied = forms.groupBy("key").agg(F.min_by("word", F.struct("at", "word")).alias("found_as")).select("key", F.lit("nltk_variation").alias("how"), "found_as")
    found = direct.union(varied.join(direct, "key", "left_anti"))
    joined = c.withColumn("key", key).join(found, "key", "left")
    undecided = F.col("c.in_dictionary").isNull()
    return joined.select(
        *df.columns,
        F.when(undecided, F.col("how").isNotNull()).otherwise(F.col("c.in_dictionary")).alias("in_dictionary"),
        F.when(undecided, F.coalesce("how", F.lit("nltk_not_found"))).otherwise(F.col("c.method")).alias("method"),
        F.when(undecided, F.when(F.col("how").isNotNull(), "high").otherwise("medium")).otherwise(F.col("c.confidence")).alias("confidence"),
        F.when(undecided & (F.col("how") == "nltk_variation"), F.col("found_as")).alias("found_as"),
    )


def split_by_dictionary(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("in_dictionary"), df.where("not in_dictionary or in_dictionary is null")
