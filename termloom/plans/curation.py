"""The end-to-end plan: documents or extracted terms to decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import decide, dictionary, generic, scoring


def document_words(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(term, n): the cleaned words of each row, with their number in it.

    Counted within the row, by the lengths of runs in the ordered words, so nothing but counts by
    term is ever shuffled.
    """
    words = F.filter(F.transform(F.split(text_col, r"\s+"), T.clean_term), lambda t: t.isNotNull())
    rows = docs.select(F.array_sort(words).alias("w")).where(F.size("w") > 0)
    first = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (i == 0) | (F.get("w", i) != F.get("w", F.greatest(i - 1, F.lit(0)))))
    rows = rows.select("w", first.alias("at"))
    runs = F.transform("at", lambda i, k: F.struct(F.get("w", i).alias("term"), (F.coalesce(F.get("at", k + 1), F.size("w")) - i).cast("long").alias("n")))
    return rows.select(F.inline(runs))


def document_terms(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(term, frequency): cleaned words and the number of rows, each a document, that they occur in."""
    return document_words(docs, text_col=text_col).groupBy("term").agg(F.count("*").alias("frequency"))


def scored(terms: DataFrame, lexicon: L.Lexicon = L.DEFAULT) -> DataFrame:
    """terms (term, frequency[, contexts]) with dictionary rule, genericness, score, decision and tier, offline providers only."""
    contexts = F.coalesce(F.col("contexts"), F.array().cast("array<string>")) if "contexts" in terms.columns else F.array().cast("array<string>")
    t = terms.withColumn("contexts", contexts)
    term, f = F.col("term"), F.col("frequency")
    t = t.withColumns({"dictionary": dictionary.classify(term, lexicon), "generic": generic.detect(term, F.col("contexts")), "review": scoring.fallback_review(term, F.col("contexts"))})
    t = t.withColumn("quality", scoring.quality_score(term, f, F.col("review.domain_relevance"), F.col("review.web_ok"), F.size("contexts"), lexicon=lexicon))
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("quality") * 0.25 + F.col("review.score") * 0.2 + F.col("generic.penalty") + 0.25)), 6)
    t = t.withColumn("final_score", score).withColumn("status", decide.decision(F.col("final_score"), F.lit(None).cast("string"), term))
    return t.withColumn("quality_tier", decide.quality_tier(F.col("final_score")))


def curate(docs: DataFrame, *, least: int = 2, lexicon: L.Lexicon = L.DEFAULT) -> DataFrame:
    """(term, frequency, in_dictionary, method, votes, penalty, final_score, status, quality_tier) of terms in at least least documents."""
    out = scored(document_terms(docs).where(F.col("frequency") >= least), lexicon)
    return out.select("term", "frequency", "dictionary.in_dictionary", "dictionary.method", "generic.votes", "generic.penalty", "final_score", "status", "quality_tier")
