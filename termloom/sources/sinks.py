"""Sinks: stage tables with a manifest, CSV and JSON at the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches, export, store, terms

MANIFEST = "step int, name string, path string, rows long, recorded_at timestamp, note string"


def one_csv(df: DataFrame, path: str) -> None:
    """A small, ordered result as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def combined_and_cleaned(combined: DataFrame, prefix: str) -> DataFrame:
    """Combined, cleaned, simple and summary tables; returns the cleaned terms."""
    combined.write.mode("overwrite").option("header", True).csv(f"{prefix}_combined")
    cleaned = terms.aggregate(combined)
    cleaned.write.mode("overwrite").option("header", True).csv(f"{prefix}_cleaned")
    cleaned.select("term", "frequency").write.mode("overwrite").option("header", True).csv(f"{prefix}_simple")
    one_csv(terms.summary_head(cleaned), f"{prefix}_summary")
    return cleaned


def step_json(df: DataFrame, path: str, **metadata) -> None:
    """A step's rows as JSON lines, and its metadata as one row beside them."""
    spark, schema = df.sparkSession, df.schema
    df.write.mode("overwrite").json(f"{path}/rows")
    n = spark.read.schema(schema).json(f"{path}/rows").count()
    spark.range(1).select(*(F.lit(v).alias(k) for k, v in metadata.items()), F.lit(n).alias("rows")).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def record_step(spark: SparkSession, manifest: str, step: int, name: str, path: str, note: str | None = None) -> None:
    """Append a finished step to the manifest; a step counts as finished only once its table is complete."""
    rows = spark.read.parquet(path).count()
    spark.range(1).select(F.lit(step).alias("step"), F.lit(name).alias("name"), F.lit(path).alias("path"), F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("recorded_at"), F.lit(note).cast("string").alias("note")).write.mode("append").parquet(manifest)


def finished_steps(spark: SparkSession, manifest: str) -> DataFrame:
    """(step, name, path, rows): the last record of each step; a step is recorded only once its table is complete."""
    last = spark.read.schema(MANIFEST).parquet(manifest).groupBy("step").agg(F.max_by(F.struct("name", "path", "rows"), "recorded_at").alias("r"))
    return last.select("step", "r.*")


def stage(spark: SparkSession, manifest: str, step: int, name: str, path: str, build) -> DataFrame:
    """A stage's table: read where the manifest has it, else built, written whole and recorded."""
    from .readers import first_existing

    if first_existing(spark, manifest) and finished_steps(spark, manifest).where(F.col("step") == step).limit(1).count():
        return spark.read.parquet(path)
    build().write.mode("overwrite").parquet(path)
    record_step(spark, manifest, step, name, path)
    return spark.read.parquet(path)


def by_dictionary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("in_dictionary").json(path)


def approved_csv(decisions: DataFrame, path: str) -> None:
    one_csv(export.approved_export(decisions), path)


def store_json(rows: DataFrame, path: str, as_of) -> None:
    """The store of rare terms as JSON lines, and its statistics beside them."""
    rows.write.mode("overwrite").json(f"{path}/terms")
    store.statistics(rows, as_of).write.mode("overwrite").json(f"{path}/statistics")


def consolidated(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(batches, totals) of the batch files under path."""
    per = batches.consolidate(spark.read.json(path))
    return per, batches.batch_totals(per)


def audit_json(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("overwrite").json(path)


def batch_json(results: DataFrame, path: str, as_of) -> None:
    """The results of each batch as JSON, and beside them each batch's counters: results, successes, failures, rate."""
    batches.as_batch_files(results, f"{path}/rows")
    counters = batches.consolidate(results).withColumns({"n_failed": F.col("n") - F.col("n_ok"), "recorded_at": as_of})
    counters.write.mode("overwrite").partitionBy("batch_id").json(f"{path}/metadata")
