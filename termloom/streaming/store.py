"""Streaming forms of the rare-term store and of the result collector."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import store
from ..sources.readers import first_existing

#: Parts of the store, by a hash of the term's id; versions of a part that are kept.
BUCKETS, KEPT = 64, 2


def _path(base: str, bucket: int, batch: int) -> str:
    return f"{base.rstrip('/')}/bucket={bucket}/v{batch:012d}"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("term_id"), F.lit(BUCKETS)).cast("int")


def _versions(spark: SparkSession, base: str, before: int | None = None) -> dict[int, list[int]]:
    """The versions of each part, newest first: at most KEPT + 1 rows a part are read."""
    pointer = f"{base.rstrip('/')}/versions"
    if first_existing(spark, pointer) is None:
        return {}
    rows = spark.read.schema("bucket int, batch long").json(pointer)
    rows = rows.where(F.col("batch") < before) if before is not None else rows
    newest = rows.groupBy("bucket").agg(F.slice(F.reverse(F.array_sort(F.collect_set("batch"))), 1, KEPT + 1).alias("batches"))
    return {r["bucket"]: list(r["batches"]) for r in newest.collect()}


def _read(spark: SparkSession, base: str, versions: dict[int, list[int]], buckets: list[int]) -> DataFrame:
    paths = [_path(base, b, versions[b][0]) for b in buckets if b in versions]
    return spark.read.schema(store.SCHEMA).parquet(*paths) if paths else store.empty(spark)


def latest(spark: SparkSession, base: str) -> DataFrame:
    """The store after the last finished batch."""
    versions = _versions(spark, base)
    return _read(spark, base, versions, sorted(versions))


def upsert_stream(arrivals: DataFrame, base: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Keep the store under base up to date with a stream of arrivals.

    The store is kept in BUCKETS parts. A micro-batch joins its arrivals to the parts they fall
    into, writes a new version of those parts only, and then records the versions; a batch that
    is run again starts from the versions before it, so it counts once. All but the last KEPT
    versions of a part are removed.
    """

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        pointer = f"{base.rstrip('/')}/versions"
        keyed = batch.withColumn("term_id", T.term_id(F.col("term")))
        touched = sorted(r["b"] for r in keyed.select(_bucket().alias("b")).distinct().collect())
        if not touched:
            return
        versions = _versions(spark, base, n)
        new = store.upsert(_read(spark, base, versions, touched), batch).withColumn("part", _bucket())
        staged = f"{base.rstrip('/')}/staged-{n:012d}"
        new.write.mode("overwrite").partitionBy("part").parquet(staged)
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        where = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fs = where(base).getFileSystem(conf)
        for b in touched:
            fs.delete(where(_path(base, b, n)), True)
            fs.mkdirs(where(_path(base, b, n)).getParent())
            fs.rename(where(f"{staged}/part={b}"), where(_path(base, b, n)))
        fs.delete(where(staged), True)
        spark.createDataFrame([(b, n) for b in touched], "bucket int, batch long").coalesce(1).write.mode("append").json(pointer)
        for b in touched:
            for old in versions.get(b, [])[KEPT - 1 :]:
                fs.delete(where(_path(base, b, old)), True)

    w = arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def counted_stream(arrivals: DataFrame, *, time: str = "seen_at", watermark: str = "90 days") -> DataFrame:
    """(term_id, window, n): arrivals by term over windows of a day, state dropped behind the watermark."""
    keyed = arrivals.withWatermark(time, watermark).withColumn("term_id", T.term_id(F.col("term")))
    return keyed.groupBy("term_id", F.window(time, "1 day")).agg(F.count("*").alias("n"))


def collect_stream(results: DataFrame, path: str, checkpoint: str, *, ok: Callable | None = None, dead_letters: str | None = None) -> StreamingQuery:
    """Append finished results whose term isn't in the table yet, each term once.

    A batch that runs again first sees its own rows as present and adds nothing. dead_letters: a
    folder for the rows that are not finished, one for each batch, which a run again replaces.
    """

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        done = F.coalesce(ok(batch) if ok else F.col("status") == "completed", F.lit(False))
        good = batch.where(done)
        one = good.groupBy("term").agg(F.min_by(F.struct(*[c for c in good.columns if c != "term"]), "seq").alias("r")).select("term", "r.*")
        if first_existing(spark, path):
            one = one.join(spark.read.parquet(path).select("term"), "term", "left_anti")
        one.write.mode("append").parquet(path)
        if dead_letters:
            batch.where(~done).write.mode("overwrite").parquet(f"{dead_letters.rstrip('/')}/batch={n}")

    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unprocessed(spark: SparkSession, dead_letters: str, done: DataFrame) -> DataFrame:
    """Rows of the dead letters whose term has no finished result since."""
    return spark.read.parquet(dead_letters).join(done.select("term").distinct(), "term", "left_anti")


def wait(query: StreamingQuery, *, limit: float = 7200.0, stalled: float = 600.0, poll: float = 1.0, report: Callable[[dict], None] | None = None) -> str:
    """Wait for a stream: finished, stalled (no new batch for so many seconds) or timeout; a failed stream raises.

    report is given the last progress of each new batch. The stream itself goes on in the latter two cases.
    """
    begun = moved = time.monotonic()
    seen = None
    while not query.awaitTermination(poll):
        progress, now = query.lastProgress, time.monotonic()
        batch = progress["batchId"] if progress else None
        if batch != seen:
            seen, moved = batch, now
            if report and progress:
                report(progress)
        if now - begun >= limit:
            return "timeout"
        if now - moved >= stalled:
            return "stalled"
    return "finished"
