"""The nine steps from an extraction file to approved terms, each a table that a later run reuses.

Every step is a function of tables; sinks.stage() writes it whole and records it in the manifest,
so a run that was interrupted goes on behind its last finished step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import decide, dictionary, export, generic, glossary, scoring, store, terms, translation
from ..sources import sinks


@dataclass
class Inputs:
    """combined: terms as readers.extraction gives them; glossary: (pair, source, target, load_order);
    words: (word); languages: (language); store: the store of rare terms after earlier runs. Providers default to the
    offline ones."""

    combined: DataFrame
    glossary: DataFrame
    words: DataFrame
    languages: DataFrame
    translate: translation.Translator | None = None
    lexicon: L.Lexicon = field(default_factory=L.Lexicon)
    least: int = 2
    store: DataFrame | None = None


def new_terms(cleaned: DataFrame, known: DataFrame) -> DataFrame:
    """Step 2: terms that hold no do-not-translate term of the glossary."""
    return glossary.verdict(cleaned, known)[1]


def rare_store(known: DataFrame, rare: DataFrame, run_name: str) -> DataFrame:
    """Step 4: the store after this run's rare terms have arrived, each once."""
    arrivals = rare.select(F.xxhash64("term").alias("seq"), "term", F.lit(run_name).alias("source_file"), "contexts", "pos_tags", F.lit(None).cast("string").alias("metadata"), F.current_timestamp().alias("seen_at"))
    return store.upsert(known, arrivals)


def translated(rows: DataFrame, languages: DataFrame, translate: translation.Translator, lexicon: L.Lexicon) -> DataFrame:
    """Step 5: every term in the languages of its tier that are there; the tier prunes before the translator runs."""
    tier = translation.tier(translation.category(F.col("term"), lexicon))
    wanted = rows.select("term", F.explode(translation.tier_languages(tier)).alias("language"))
    return translation.guarded(wanted, languages, translate).select("term", "language", "translation")


def decided(enriched: DataFrame, summary: DataFrame, checked: DataFrame, lexicon: L.Lexicon) -> DataFrame:
    """Step 7: translation and verification results joined to the terms, scored and decided."""
    t = enriched.join(summary, "term", "left").join(checked, "term", "left")
    total = F.greatest(F.coalesce("total_languages", F.lit(1)), F.lit(1))
    t = t.withColumns({"coverage": F.coalesce("translated_languages", F.lit(0)) / total, "same": F.coalesce("same_languages", F.lit(0)) / total, "tscore": F.coalesce("translatability_score", F.lit(0.0))})
    term, f, texts = F.col("term"), F.col("frequency"), F.col("contexts")
    t = t.withColumns({"review": scoring.fallback_review(term, texts), "generic": generic.detect(term, texts), "tr": decide.translatability(term, F.col("tscore"), F.col("coverage"), F.col("same"), lexicon)})
    t = t.withColumn("quality", scoring.quality_score(term, f, F.col("review.domain_relevance"), F.col("review.web_ok"), F.size("contexts"), lexicon=lexicon))
    has = F.col("total_languages").isNotNull()
    score = decide.final_score(
        F.col("quality"), F.col("review.score"), F.col("tr"), F.col("coverage"), F.col("same"), has, F.col("verification_passed"), F.coalesce("verification_issues_count", F.lit(0)),
        F.coalesce("verified_count", F.lit(0)), scoring.context_quality(texts), scoring.semantic_richness(term, texts), F.col("generic.penalty"),
    )
    t = t.withColumn("final_score", score).withColumn("status", decide.decision(F.col("final_score"), F.col("tr.action"), term))
    zero = F.lit(0)
    why = decide.reasons(
        F.col("tr"), F.col("coverage"), F.col("same"), F.col("quality"), F.coalesce("translated_languages", zero), F.coalesce("total_languages", zero), F.coalesce("verification_passed", F.lit(False)),
        F.coalesce("verification_issues_count", zero), F.coalesce("verified_count", zero), scoring.usage_patterns(texts),
    )
    t = t.withColumn("reasons", why).withColumn("reason_text", decide.reason_text(term, F.col("final_score"), F.col("status"), F.col("reasons")))
    return t.select("reasons", "reason_text", "term", "frequency", F.col("contexts").alias("texts"), "in_dictionary", F.col("tr.category").alias("category"), F.col("tr.action").alias("action"), "final_score", "status", F.upper("status").alias("decision"), decide.quality_tier(F.col("final_score")).alias("quality_tier"))


def run(spark: SparkSession, inputs: Inputs, out: str) -> DataFrame:
    """All steps under the folder out; returns the approved export."""
    manifest = f"{out}/manifest"
    step = lambda n, name, build: sinks.stage(spark, manifest, n, name, f"{out}/{n}_{name}", build)
    cleaned = step(1, "cleaned", lambda: terms.aggregate(inputs.combined).withColumn("pos_tag", F.lit("UNKNOWN")))
    new = step(2, "new_terms", lambda: new_terms(cleaned, inputs.glossary.where("pair = 'DNT'")))
    enriched = step(3, "enriched", lambda: dictionary.classify_terms(terms.with_contexts(new, cleaned), inputs.words, inputs.lexicon))
    frequent, rare = terms.split_by_frequency(enriched, inputs.least)
    # rare terms wait in the store; those seen in an earlier run too are promoted and go on
    kept = step(41, "store", lambda: rare_store(inputs.store if inputs.store is not None else store.empty(spark), rare, out))
    promoted = kept.where("status = 'promoted'").select(F.col("term_id"))
    often = step(4, "frequent", lambda: frequent.unionByName(rare.join(promoted, T.term_id(F.col("term")) == F.col("term_id"), "left_semi")))
    translate = inputs.translate or translation.glossary_translator(inputs.glossary.withColumn("language", F.col("pair")))
    rows = step(5, "translations", lambda: translated(often, inputs.languages, translate, inputs.lexicon))
    checked = step(6, "verified", lambda: translation.verified(rows))
    decisions = step(7, "decisions", lambda: decided(often, translation.summary(rows), checked, inputs.lexicon))
    step(8, "audit", lambda: export.audit(decisions, {"decisions": f"{out}/7_decisions"}, {"least": str(inputs.least)}, F.current_timestamp()))
    return step(9, "export", lambda: export.approved_export(decisions))
