"""Model-backed steps behind small protocols, with offline defaults and an Arrow-batched wrapper."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import context, scoring


class Reviewer(Protocol):
    """struct(score, status, web_ok, domain_relevance, ...) of a term and its texts."""

    def __call__(self, term: Column, texts: Column) -> Column: ...


class Searcher(Protocol):
    """A search result for a query, or null."""

    def __call__(self, query: Column) -> Column: ...


class Describer(Protocol):
    """A sentence for an approved term from its texts and decision."""

    def __call__(self, texts: Column, decision: Column) -> Column: ...


def offline_reviewer(term: Column, texts: Column) -> Column:
    return scoring.fallback_review(term, texts)


def offline_searcher(query: Column) -> Column:
    return F.lit(None).cast("string")


def offline_describer(texts: Column, decision: Column) -> Column:
    return context.describe(texts, decision)


def accepted_description(answer: Column, texts: Column, decision: Column, longer: int = 20) -> Column:
    """A provider's description where it says enough, else the offline one."""
    return F.when(F.length(F.trim(answer)) > longer, F.trim(answer)).otherwise(offline_describer(texts, decision))


def batched(make: Callable[[], Callable[[list[str]], list[str]]], *, attempts: int = 3, pause: float = 1.0, per_minute: float | None = None):
    """A pandas UDF over strings: make() loads the model once for a Python worker, and its result maps a batch.

    A failing batch is tried again with growing pauses; after the last attempt its rows are null,
    so a deterministic fallback can take over. per_minute spaces the batches of one worker.
    """

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, last = make(), 0.0
        for part in parts:
            out: list = [None] * len(part)
            for i in range(attempts):
                if per_minute:
                    time.sleep(max(0.0, last + 60 / per_minute - time.monotonic()))
                last = time.monotonic()
                try:
                    out = model(part.tolist())
                    break
                except Exception:
                    if i + 1 < attempts:
                        time.sleep(pause * 2**i * (1 + random.random() / 2))
            yield pd.Series(out, index=part.index, dtype="object")

    return run


def with_provider(df: DataFrame, name: str, udf, arg: str, fallback: Column) -> DataFrame:
    """df with the provider's column; the call comes last, after all filters, and null answers are filled by the fallback."""
    return df.withColumn(name, F.coalesce(udf(F.col(arg)), fallback))
