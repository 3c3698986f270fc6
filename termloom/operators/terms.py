"""Terms: extraction from rows, aggregation, frequency filters, order and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import lexicon as L
from ..functions import text as T


def row_terms(df: DataFrame, columns: list[str], texts: list[str], row: str) -> DataFrame:
    """(term, frequency, original_text, source_row, pos_tag): the union of a row's terms over its columns."""
    found = [F.coalesce(T.parse_term_field(F.col(c)), F.array().cast("array<string>")) for c in columns if c in df.columns]
    if not found:
        raise ValueError(f"none of the columns {columns} is there")
    union = found[0] if len(found) == 1 else F.array_distinct(F.concat(*found))
    text = T.pick_text(*(F.col(c) for c in texts if c in df.columns)) if any(c in df.columns for c in texts) else F.lit(None).cast("string")
    return df.select(F.explode(F.array_distinct(union)).alias("term"), F.lit(1).alias("frequency"), text.alias("original_text"), F.col(row).alias("source_row"), F.lit("UNKNOWN").alias("pos_tag"))


def aggregate(combined: DataFrame) -> DataFrame:
    """One row for each exact term: summed frequency, longest text (the first of equals), first row."""
    longest = F.max_by("original_text", F.struct(F.length("original_text"), -F.col("source_row")))
    return combined.groupBy("term").agg(F.sum("frequency").cast("long").alias("frequency"), longest.alias("original_text"), F.min("source_row").alias("source_row"))


def with_contexts(new: DataFrame, cleaned: DataFrame, keep: int = 10) -> DataFrame:
    """new terms with the first frequency, the first keep texts by row, the number of texts and the distinct tags of their cleaned rows; 1 and none without any.

    Rows of a term are ranked with a limit, which Spark applies before it shuffles them.
    """
    rank = F.row_number().over(Window.partitionBy("term").orderBy("source_row", "original_text"))
    some = cleaned.where("original_text is not null").select("term", "source_row", "original_text", rank.alias("rank")).where(F.col("rank") <= keep)
    texts = some.groupBy("term").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "original_text"))), lambda s: s["original_text"]).alias("contexts"))
    known = cleaned.groupBy("term").agg(F.min_by("frequency", "source_row").alias("known"), F.count("original_text").alias("n_texts"), F.array_sort(F.collect_set("pos_tag")).alias("pos_tags"))
    none = F.array().cast("array<string>")
    joined = new.select("term").distinct().join(known, "term", "left").join(texts, "term", "left")
    return joined.select("term", F.coalesce("known", F.lit(1)).alias("frequency"), F.coalesce("contexts", none).alias("contexts"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("pos_tags", none).alias("pos_tags"))


def unique_terms(df: DataFrame) -> DataFrame:
    return df.select("term").distinct()


def split_by_frequency(df: DataFrame, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Terms to go on with, and rare terms for the store."""
    often = F.coalesce(F.col("frequency") >= least, F.lit(False))
    return df.where(often), df.where(~often)


def loadable(df: DataFrame, least: int = 2, contexts: str = "contexts") -> DataFrame:
    """frequency of at least least, more than one character, and stop words only with three contexts."""
    stop = F.lower("term").isin(L.STOP_LOAD) & (F.coalesce(F.size(contexts), F.lit(0)) < 3)
    return df.where((F.col("frequency") >= least) & (F.length("term") > 1) & ~stop)


def with_priority(df: DataFrame, contexts: str = "contexts") -> DataFrame:
    """priority: 0.7 of the frequency and 3 for each context."""
    return df.withColumn("priority", F.round(F.col("frequency") * 0.7 + F.coalesce(F.size(contexts), F.lit(0)) / F.lit(10.0) * 30, 6))


def by_priority(df: DataFrame) -> DataFrame:
    return with_priority(df).orderBy(F.desc("priority"), "term")


def most_frequent(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc("frequency"), "term").limit(n)


def summary_head(df: DataFrame, n: int = 100) -> DataFrame:
    """The first n terms in the order of their first row."""
    return df.orderBy("source_row", "term").limit(n)


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("term").intersect(b.select("term"))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, repeats included."""
    return a.unionByName(b)


def missing(required: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of required without a row of done: what is still to do."""
    return required.join(done.select("term").distinct(), "term", "left_anti")


def merge_new(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and those rows of new whose term isn't there yet."""
    return old.unionByName(missing(new, old))


def resolve_overlap(rest: DataFrame, translated: DataFrame, limit: float = 0.9) -> DataFrame:
    """Drop from rest what is translated; where more than limit of rest is, drop all of it."""
    r, t = rest.select("term").distinct(), translated.select("term").distinct()
    share = r.join(t.withColumn("hit", F.lit(1)), "term", "left").agg((F.count("hit") / F.greatest(F.count("*"), F.lit(1))).alias("share"))
    return missing(rest, translated).join(F.broadcast(share), F.col("share") <= limit).drop("share")
