"""Approved export, run statistics and the audit record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import context, decide


def approved(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("decision").contains("APPROVED"))


def last_texts(combined: DataFrame) -> DataFrame:
    """(term, texts): the texts of a term's last row."""
    return combined.where("original_text is not null and original_text <> ''").groupBy("term").agg(T.split_texts(F.max_by("original_text", "source_row")).alias("texts"))


def with_texts(decisions: DataFrame, *sources: DataFrame) -> DataFrame:
    """decisions with texts of the first source (term, texts) that isn't empty."""
    chosen = next((s for s in sources if s.limit(1).count()), sources[-1])
    return decisions.join(chosen.select("term", "texts"), "term", "left")


def approved_export(decisions: DataFrame) -> DataFrame:
    """(source, target, description, context) of approved terms, ordered by lower-case source; decisions: term, decision, texts."""
    texts = F.coalesce(F.col("texts"), F.array().cast("array<string>"))
    rows = approved(decisions).select(
        F.col("term").alias("source"), F.col("term").alias("target"), context.describe(texts, F.col("decision")).alias("description"), T.context_samples(texts).alias("context")
    )
    return rows.orderBy(F.lower("source"), "source")


def breakdown(decisions: DataFrame) -> DataFrame:
    """(status, n, percent): the share of each status; the total comes from one aggregate row."""
    counts = decisions.groupBy("status").agg(F.count("*").alias("n"))
    total = decisions.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("status", "n", F.round(F.col("n") / F.greatest("total", F.lit(1)) * 100, 1).alias("percent"))


def audit(decisions: DataFrame, files: dict[str, str], config: dict[str, str], as_of: Column) -> DataFrame:
    """The audit record: one row with statistics, configuration, step flags and files."""
    s = decide.decision_summary(decisions)
    pairs = lambda d: F.map_from_arrays(F.array(*(F.lit(k) for k in d)).cast("array<string>"), F.array(*(F.lit(v) for v in d.values())).cast("array<string>"))
    steps = F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.concat(F.lit("step_"), i.cast("string"))), F.array_repeat(F.lit(True), 9))
    return s.select(as_of.alias("recorded_at"), F.struct(*s.columns).alias("statistics"), pairs(config).alias("config"), pairs(files).alias("files"), steps.alias("steps"))


def report(decisions: DataFrame) -> str:
    """A short Markdown summary, from one aggregate row."""
    r = decide.decision_summary(decisions).first()
    lines = ["# Terminology run", "", f"Terms decided: {r['total_decisions']}", f"Average score: {r['average_score']}", "", "| Status | Terms | % |", "|-|-|-|"]
    lines += [f"| {s} | {r[s]} | {r[f'{s}_rate']} |" for s in decide.STATUSES]
    return "\n".join(lines) + "\n"
