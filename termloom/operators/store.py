"""The store of rare terms, keyed by a hash of the lower-case term.

A store is a table; an update is a join of the store with the arrivals' own aggregation, so a
batch of any size is one pass. A term counts up to its promotion at two arrivals; later arrivals
change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

SCHEMA = (
    "term_id string, term string, first_seen timestamp, last_seen timestamp, occurrence_count long, source_files array<string>, original_contexts array<string>, "
    "pos_tags array<string>, promoted_to_processing boolean, promoted_at timestamp, status string, metadata string"
)


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _first_two(arrivals: DataFrame) -> DataFrame:
    """arrivals: term, source_file, contexts, pos_tags, metadata, seen_at, seq (arrival order). Ranked within their id.

    Only the first two arrivals of an id can change the store, so the rest is cut off by a
    per-partition rank before the shuffle of the full rows.
    """
    a = arrivals.withColumn("term_id", T.term_id(F.col("term")))
    rank = F.row_number().over(Window.partitionBy("term_id").orderBy("seq", "term"))
    return a.withColumn("rank", rank).where("rank <= 2")


def _one(c: str, n: int) -> Column:
    return F.max(F.when(F.col("rank") == n, F.col(c)))


def _merged(*arrays: Column) -> Column:
    none = F.array().cast("array<string>")
    out = none
    for a in arrays:
        out = F.array_union(out, F.coalesce(a, none))
    return out


def upsert(store: DataFrame, arrivals: DataFrame) -> DataFrame:
    """The store after the arrivals, in their order."""
    two = _first_two(arrivals)
    per = two.groupBy("term_id").agg(
        F.count("*").alias("n"), *(_one(c, i).alias(f"{c}{i}") for c in ("term", "source_file", "contexts", "pos_tags", "metadata", "seen_at") for i in (1, 2))
    )
    s = store.withColumn("known", F.lit(True))
    j = s.join(per, "term_id", "full_outer")
    known, promoted = F.coalesce("known", F.lit(False)), F.coalesce("promoted_to_processing", F.lit(False))
    # arrivals that count: none after a promotion, at most as many as lead to it
    used = F.when(F.col("n").isNull() | promoted, 0).when(known & (F.col("occurrence_count") >= 1), F.least(F.col("n"), F.lit(1))).otherwise(F.col("n"))
    j = j.withColumn("used", used.cast("long")).withColumn("count", F.coalesce("occurrence_count", F.lit(0)) + F.col("used"))
    now = F.when(F.col("used") == 2, F.col("seen_at2")).when(F.col("used") == 1, F.col("seen_at1"))
    up = ~promoted & (F.col("count") >= 2)
    one, two_ = F.col("used") >= 1, F.col("used") >= 2
    arr = lambda c: F.when(F.col(c).isNotNull(), F.array(F.col(c)))
    return j.select(
        "term_id", F.coalesce("term", "term1").alias("term"), F.coalesce("first_seen", "seen_at1").alias("first_seen"), F.coalesce(now, "last_seen").alias("last_seen"), F.col("count").alias("occurrence_count"),
        _merged(F.col("source_files"), F.when(one, arr("source_file1")), F.when(two_, arr("source_file2"))).alias("source_files"),
        _merged(F.col("original_contexts"), F.when(one, F.col("contexts1")), F.when(two_, F.col("contexts2"))).alias("original_contexts"),
        _merged(F.col("pos_tags"), F.when(one, F.col("pos_tags1")), F.when(two_, F.col("pos_tags2"))).alias("pos_tags"),
        (promoted | up).alias("promoted_to_processing"), F.when(up, now).otherwise(F.col("promoted_at")).alias("promoted_at"),
        F.when(up, "promoted").otherwise(F.coalesce("status", F.lit("stored"))).alias("status"), F.when(two_, F.col("metadata2")).when(one, F.col("metadata1")).otherwise(F.col("metadata")).alias("metadata"),
    )


def accepted(store: DataFrame, arrivals: DataFrame) -> DataFrame:
    """(seq, term, accepted): whether each arrival changed the store: not once its term is promoted.

    Only the first two arrivals of an id can be accepted, so only they are ranked.
    """
    a = arrivals.withColumn("term_id", T.term_id(F.col("term")))
    have = store.select("term_id", F.col("occurrence_count").alias("have"), F.col("promoted_to_processing").alias("gone"))
    first = _first_two(arrivals.select("seq", "term")).join(have, "term_id", "left")
    taken = first.where(~F.coalesce("gone", F.lit(False)) & (F.col("rank") + F.coalesce("have", F.lit(0)) <= 2)).select("term_id", "seq", "term", F.lit(True).alias("taken")).distinct()
    return a.join(taken, ["term_id", "seq", "term"], "left").select("seq", "term", F.coalesce("taken", F.lit(False)).alias("accepted"))


def mark_processed(store: DataFrame, terms: DataFrame) -> DataFrame:
    """Status processed for the terms' ids."""
    ids = terms.select(T.term_id(F.col("term")).alias("term_id"), F.lit(True).alias("hit")).distinct()
    return store.join(ids, "term_id", "left").withColumn("status", F.when(F.col("hit"), "processed").otherwise(F.col("status"))).drop("hit")


def cleanup(store: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Without terms stored once and not seen for some days before as_of."""
    old = (F.col("status") == "stored") & (F.col("occurrence_count") == 1) & (F.col("last_seen") < as_of - F.make_dt_interval(F.lit(days)))
    return store.where(~old)


def search(store: DataFrame, *, pattern: str | None = None, least: int | None = None, status: str | None = None) -> DataFrame:
    """Terms that hold a pattern (in any case), by count and last sight, most first."""
    if pattern:
        store = store.where(F.lower("term").contains(pattern.lower()))
    if least:
        store = store.where(F.col("occurrence_count") >= least)
    if status:
        store = store.where(F.col("status") == status)
    return store.orderBy(F.desc("occurrence_count"), F.desc("last_seen"), "term_id")


def ready(store: DataFrame) -> DataFrame:
    return search(store.where("promoted_to_processing"), status="promoted")


def statistics(store: DataFrame, as_of: Column) -> DataFrame:
    """(measure, key, n): totals, by status, by count, ready, and active in the last day."""
    row = lambda m, k, n: F.struct(F.lit(m).alias("measure"), k.cast("string").alias("key"), n.cast("long").alias("n"))
    one = store.agg(
        F.count("*").alias("total"), F.count_if(F.col("promoted_to_processing") & (F.col("status") == "promoted")).alias("ready"),
        F.count_if(F.col("last_seen") > as_of - F.make_dt_interval(F.lit(1))).alias("recent"),
    )
    none = F.lit(None)
    flat = one.select(F.inline(F.array(row("total_terms", none, F.col("total")), row("ready_for_processing", none, F.col("ready")), row("recent_activity", none, F.col("recent")))))
    for m, c in (("by_status", "status"), ("by_frequency", "occurrence_count")):
        flat = flat.unionByName(store.groupBy(c).count().select(F.lit(m).alias("measure"), F.col(c).cast("string").alias("key"), F.col("count").alias("n")))
    return flat


def cached(cache: DataFrame, requests: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """requests with the cached result that is no older than days, or null."""
    fresh = cache.where(F.col("created_at") >= as_of - F.make_dt_interval(F.lit(days))).groupBy("cache_key").agg(F.max_by("result", "created_at").alias("result"))
    return requests.join(fresh, "cache_key", "left")


def cache_put(cache: DataFrame, results: DataFrame) -> DataFrame:
    """The cache with results replacing rows of the same key."""
    return cache.join(results.select("cache_key").distinct(), "cache_key", "left_anti").unionByName(results)


def cache_expire(cache: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return cache.where(F.col("created_at") >= as_of - F.make_dt_interval(F.lit(days)))


def arrivals_of(rows: DataFrame, source_name: str, seen_at: Column) -> DataFrame:
    """Arrivals for upsert() from rows (term, frequency, contexts, pos_tags): only terms seen once, in the order of their text."""
    once = rows.where((F.col("frequency") == 1) & (F.col("term") != ""))
    metadata = F.to_json(F.struct(F.lit(source_name).alias("imported_from")))
    return once.select(F.xxhash64("term").alias("seq"), "term", F.lit(source_name).alias("source_file"), "contexts", "pos_tags", metadata.alias("metadata"), seen_at.alias("seen_at"))
