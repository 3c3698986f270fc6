"""Numbered batches: assignment, gaps, refill and consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges of the global numbering, and keys that their bounds are taken from; numbers of a gap that one row stands for.
BLOCKS, BOUNDS, GAP = 64, 4096, 100_000


def numbered(df: DataFrame, order: str, out: str = "rn") -> DataFrame:
    """df with the row's place in the order of a unique key, from 1, without one task for all rows.

    Ranges of the key, whose bounds come from a bounded sample, are numbered within themselves
    and shifted by the sizes of earlier ranges. A row's range depends on its key alone, so it is
    the same whenever it is computed.
    """
    key = F.col(order)
    sample = sorted(r["k"] for r in df.select(key.alias("k")).where("k is not null").orderBy(F.xxhash64("k"), "k").limit(BOUNDS).collect())
    bounds = list(dict.fromkeys(sample[len(sample) * i // BLOCKS] for i in range(1, BLOCKS))) if len(sample) > BLOCKS else []
    part = F.coalesce(F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b <= key)), F.lit(0)) if bounds else F.lit(0)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    parts = df.select(row.alias("row"), key.alias("key"), part.alias("part"))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    # at most BLOCKS rows are broadcast
    return parts.withColumn("within", within).join(F.broadcast(before), "part").select("row.*", (F.col("before") + F.col("within")).cast("long").alias(out))


def assign(df: DataFrame, order: str, size: int, start: int = 1) -> DataFrame:
    """df with batch_id: start + the place divided by size."""
    return numbered(df, order).withColumn("batch_id", (F.floor((F.col("rn") - 1) / size) + start).cast("long")).drop("rn")


def next_number(batches: DataFrame) -> DataFrame:
    return batches.agg((F.coalesce(F.max("batch_id"), F.lit(0)) + 1).cast("long").alias("next_batch"))


def missing_numbers(batches: DataFrame) -> DataFrame:
    """(batch_id) between the smallest and the largest that aren't there.

    Each gap between neighbours is filled on its own, a wide one from many rows.
    """
    at = numbered(batches.where("batch_id is not null").select(F.col("batch_id").cast("long").alias("batch_id")).distinct(), "batch_id")
    after = at.select((F.col("rn") - 1).alias("rn"), F.col("batch_id").alias("next"))
    gaps = at.join(after, "rn").where(F.col("next") - F.col("batch_id") > 1).select((F.col("batch_id") + 1).alias("lo"), (F.col("next") - 1).alias("hi"))
    starts = gaps.select("hi", F.explode(F.sequence(F.col("lo"), F.col("hi"), F.lit(GAP).cast("long"))).alias("lo"))
    return starts.repartition("lo").select(F.explode(F.sequence("lo", F.least(F.col("lo") + GAP - 1, F.col("hi")))).alias("batch_id"))


def ranges(numbers: DataFrame) -> DataFrame:
    """(first, last, n, label) of runs of consecutive distinct numbers: number minus place is the same within a run."""
    islands = numbered(numbers, "batch_id").withColumn("run", F.col("batch_id") - F.col("rn")).groupBy("run").agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last"), F.count("*").alias("n"))
    label = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", "first", "last"))
    return islands.select("first", "last", "n", label.alias("label"))


def refill(df: DataFrame, order: str, size: int, targets: DataFrame) -> DataFrame:
    """The rows of the target batches: batch n has the places (n-1) * size + 1 to n * size."""
    return assign(df, order, size).join(targets.select("batch_id").distinct(), "batch_id", "left_semi")


def consolidate(results: DataFrame) -> DataFrame:
    """One row for each batch: results, successes and the success rate in percent."""
    ok = F.count_if(F.col("ok"))
    return results.groupBy("batch_id").agg(F.count("*").alias("n"), ok.alias("n_ok"), F.round(ok / F.greatest(F.count("*"), F.lit(1)) * 100, 6).alias("success_rate"))


def batch_totals(batches: DataFrame) -> DataFrame:
    return batches.agg(F.count("*").alias("batches"), F.sum("n").alias("results"), F.sum("n_ok").alias("successes"), F.round(F.sum("n_ok") / F.greatest(F.sum("n"), F.lit(1)) * 100, 6).alias("success_rate"))


def status_summary(results: DataFrame) -> DataFrame:
    """One row: reviewed terms by status."""
    return results.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("recommended", "needs_review", "low_priority", "unexpected_duplicate", "not_recommended")))


def as_batch_files(results: DataFrame, path: str) -> None:
    """One folder of JSON for each batch."""
    results.write.mode("overwrite").partitionBy("batch_id").json(path)
