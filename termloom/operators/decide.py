"""Translatability, the additive final score, decisions, tiers and reasons."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T

STATUSES = ("approved", "conditionally_approved", "needs_review", "rejected", "approved_as_new_term", "conditionally_approved_as_new_term", "needs_review_for_new_term")


def indicators(term: Column) -> Column:
    """The signs that a term isn't translated, in a fixed order."""
    low = F.lower(term)
    tests = [
        ("contains_numbers", term.rlike(r"\p{Nd}")),
        ("contains_special_chars", term.rlike("[" + re.escape(L.SPECIAL_CHARS) + "]")),
        ("very_short", F.length(term) <= 2),
        ("very_long", F.length(term) >= 20),
        ("all_uppercase", T.is_upper(term) & (F.length(term) > 3)),
        ("contains_dot", term.contains(".")),
        ("file_extension", T.contains_any(low, L.FILE_EXTENSIONS)),
        ("error_related", T.contains_any(low, L.ERROR_TERMS)),
        ("common_stopword", low.isin(L.STOPWORDS)),
        ("identifier_prefix", low.rlike("^(" + "|".join(L.ID_PREFIXES) + ")")),
        ("web_related", T.contains_any(low, L.WEB_PATTERNS)),
        ("version_pattern", T.contains_any(low, L.VERSION_PATTERNS)),
    ]
    return F.array_compact(F.array(*(F.when(c, name) for name, c in tests)))


def technical_value(term: Column, ind: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """Whether a term that isn't translated is worth a term of its own."""
    has = lambda *names: T.any_of(F.array_contains(ind, n) for n in names)
    low = F.lower(term)
    medium = (has("all_uppercase") & (F.length(term) >= 3)) | (has("contains_special_chars") & (F.length(term) >= 3) & term.rlike(r"[\p{L}\p{N}]")) | has("contains_dot")
    code = (F.length(term) >= 4) & (term.rlike(r"^[A-Za-z]+\d+") | term.rlike(r"^\d+[A-Za-z]+") | (term.rlike(r"^[A-Za-z0-9._-]+$") & term.rlike(r"\d") & term.rlike(r"[A-Za-z]")))
    return (
        F.when(has("common_stopword", "error_related", "very_short"), False).when(has("file_extension", "version_pattern", "web_related", "contains_numbers"), True)
        .when(medium, True).when(T.contains_any(low, [*L.TECH_DOMAINS, *lexicon.product_names]), True).otherwise(code)
    )


def translatability(term: Column, score: Column, coverage: Column, same: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """struct(category, is_translatable, has_technical_value, indicators, action, new_term, quality, complexity, universality)."""
    ind = indicators(term)
    tech = technical_value(term, ind, lexicon)
    cat = F.when((score == 0) | (coverage == 0), "UNTRANSLATABLE").when((score < 0.5) | (coverage < 0.5) | (F.size(ind) >= 3), "PARTIALLY_TRANSLATABLE").otherwise("FULLY_TRANSLATABLE")
    bad = F.array_contains(ind, "common_stopword") | F.array_contains(ind, "error_related")
    un = F.when((same > 0.8) & tech, "APPROVE_AS_NEW_TERM").when(tech, "CONDITIONAL_APPROVAL_AS_NEW_TERM").when(bad, "REJECT").otherwise("NEEDS_REVIEW_FOR_NEW_TERM")
    part = F.when((coverage >= 0.3) & (score >= 0.3), "CONDITIONAL_APPROVAL").otherwise("NEEDS_REVIEW")
    full = F.when((coverage >= 0.8) & (score >= 0.8), "APPROVE").when((coverage >= 0.6) & (score >= 0.6), "CONDITIONAL_APPROVAL").otherwise("NEEDS_REVIEW")
    return F.struct(
        cat.alias("category"), (cat != "UNTRANSLATABLE").alias("is_translatable"), tech.alias("has_technical_value"), ind.alias("indicators"),
        F.when(cat == "UNTRANSLATABLE", un).when(cat == "PARTIALLY_TRANSLATABLE", part).otherwise(full).alias("action"),
        F.when((cat == "UNTRANSLATABLE") & tech, F.when(same > 0.8, "high").otherwise("medium")).otherwise("low").alias("new_term"),
        F.when(coverage >= 0.9, "excellent").when(coverage >= 0.7, "good").otherwise("poor").alias("quality"),
        F.when(F.size(ind) >= 3, "high").when(F.size(ind) >= 1, "medium").otherwise("low").alias("complexity"),
        F.when(same > 0.8, "universal").when(same > 0.3, "partial").otherwise("language_specific").alias("universality"),
    )


def final_score(ml: Column, agent: Column, tr: Column, coverage: Column, same: Column, has_translation: Column, passed: Column, n_issues: Column, n_verified: Column, quality: Column, richness: Column, penalty: Column) -> Column:
    """The additive score, clamped to [0, 1] and rounded to six decimals.

    ml and agent may be null; passed is null where nothing was verified, quality where there is
    no context analysis, has_translation false where nothing was translated.
    """
    s = F.coalesce(ml * 0.25, F.lit(0.4)) + F.coalesce(agent * 0.2, F.lit(0.0))
    un = F.when(tr["has_technical_value"], F.when(same > 0.8, 0.08).otherwise(0.06)).otherwise(-0.05)
    s = s + F.when(tr["category"] == "UNTRANSLATABLE", un).when(tr["category"] == "PARTIALLY_TRANSLATABLE", F.when(coverage >= 0.3, 0.04).otherwise(-0.02)).otherwise(0.08)
    s = s - F.least(F.lit(0.05), F.size(tr["indicators"]) * 0.01)
    steps = F.when(coverage >= 0.95, 0.15).when(coverage >= 0.85, 0.12).when(coverage >= 0.70, 0.09).when(coverage >= 0.50, 0.06).when(coverage >= 0.30, 0.03).otherwise(0.0)
    s = s + F.when(has_translation, steps).otherwise(-0.05)
    good = F.when(n_verified >= 10, 0.10).when(n_verified >= 5, 0.09).otherwise(0.08)
    poor = F.when(n_issues == 0, 0.02).when(n_issues <= 2, 0.01).when(n_issues <= 5, 0.03).otherwise(F.least(F.lit(0.08), n_issues * 0.015))
    s = s + F.when(passed.isNull(), -0.03).when(passed, good).otherwise(-poor)
    s = s + F.when(quality.isNotNull(), quality * 0.08 + richness * 0.07 + 0.02).when(has_translation & passed.isNotNull(), 0.03).otherwise(0.0)
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), s + penalty))
    return F.round(s, 6)


def decision(score: Column, action: Column, term: Column) -> Column:
    """The status; single words need more than longer terms."""
    one = F.size(T.words(term)) == 1

    def cut(levels_one: tuple, levels_more: tuple, names: tuple, rest: str) -> Column:
        return T.first_of(((score >= F.when(one, a).otherwise(b), name) for a, b, name in zip(levels_one, levels_more, names, strict=True)), rest)

    new = cut((0.7, 0.5), (0.6, 0.4), ("approved_as_new_term", "conditionally_approved_as_new_term"), "needs_review_for_new_term")
    plain = cut((0.55, 0.45, 0.38), (0.48, 0.38, 0.32), ("approved", "conditionally_approved", "needs_review"), "rejected")
    return F.when(F.coalesce(action.contains("NEW_TERM"), F.lit(False)), new).otherwise(plain)


def quality_tier(score: Column) -> Column:
    return F.when(score >= 0.85, "Exceptional").when(score >= 0.70, "High Quality").when(score >= 0.55, "Good Quality").when(score >= 0.40, "Standard Quality").when(score >= 0.25, "Below Standard").otherwise("Poor Quality")


def percent(x: Column) -> Column:
    return F.concat(F.format_string("%.1f", F.round(x * 100, 1)), F.lit("%"))


def thousandths(x: Column) -> Column:
    """Three decimals, halves rounded up."""
    return F.format_string("%.3f", F.round(x, 3))


def reasons(tr: Column, coverage: Column, same: Column, ml: Column, n_translated: Column, n_total: Column, passed: Column, n_issues: Column, n_verified: Column, usage: Column) -> Column:
    """What speaks for and against a term, as ordered sentences."""
    word = F.when(coverage >= 0.9, "Excellent").when(coverage >= 0.7, "Good").otherwise("Poor")
    return F.array_compact(F.array(
        F.when(tr["is_translatable"], F.concat(F.lit("Translatable: "), tr["category"])).when(tr["has_technical_value"], "New term candidate: untranslatable but of technical value").otherwise("Untranslatable without technical value"),
        F.concat(F.lit("Translation coverage: "), percent(coverage), F.lit(" - "), word),
        F.when(same > 0.8, F.concat(F.lit("Universal technical term: "), percent(same), F.lit(" unchanged"))).when(same > 0.3, F.concat(F.lit("Partially universal: "), percent(same), F.lit(" unchanged"))),
        F.when(F.size(tr["indicators"]) > 0, F.concat(F.lit("Technical indicators: "), F.array_join(F.slice(tr["indicators"], 1, 3), ", "))),
        F.when(F.size(tr["indicators"]) >= 3, "Several technical patterns"),
        F.concat(F.lit("Recommendation: "), tr["action"]),
        F.concat(F.lit("Quality score: "), thousandths(ml)),
        F.when(n_total > 0, F.concat(F.lit("Translated: "), n_translated.cast("string"), F.lit("/"), n_total.cast("string"), F.lit(" languages"))),
        F.when(passed, "Verification: passed").when((n_issues == 0) & (n_verified == 0), "Verification: skipped").otherwise(F.concat(F.lit("Verification: failed ("), n_issues.cast("string"), F.lit(" issues)"))),
        F.when(F.size(usage) > 0, F.concat(F.lit("Usage: "), F.array_join(usage, ", "))),
    ))


def reason_text(term: Column, score: Column, status: Column, reason_list: Column) -> Column:
    one = F.size(T.words(term)) == 1
    kind = F.when(one, "single-word").otherwise("multi-word")
    return F.concat_ws(
        " ",
        F.concat(F.lit("Term '"), term, F.lit("' ("), kind, F.lit(") scored "), thousandths(score), F.lit(": "), F.upper(status), F.lit(".")),
        F.concat(F.array_join(F.slice(reason_list, 1, 2), "; "), F.lit(".")),
        F.concat(F.lit("Quality tier: "), quality_tier(score), F.lit(".")),
    )


def by_term(decisions: DataFrame) -> DataFrame:
    """Decisions in the order of their terms."""
    return decisions.orderBy("term")


def fallback_decisions(df: DataFrame, n: int = 100) -> DataFrame:
    """The decisions when no review ran: the first n terms need review, at 0.5."""
    return df.orderBy("index", "term").limit(n).select("term", F.lit("needs_review").alias("status"), F.lit(0.5).alias("final_score"))


def empty_decisions(df: DataFrame) -> DataFrame:
    return df.limit(0).select("term", F.lit("").alias("status"), F.lit(0.0).alias("final_score"))


def decision_summary(d: DataFrame) -> DataFrame:
    """One row: counts and rates by status, and the mean score."""
    n = F.greatest(F.count("*"), F.lit(1))
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    rates = [F.round(F.count_if(F.col("status") == s) / n * 100, 1).alias(f"{s}_rate") for s in STATUSES]
    return d.agg(F.count("*").alias("total_decisions"), *counts, *rates, F.round(F.avg("final_score"), 3).alias("average_score"))


def join_steps(verified: DataFrame, translations: DataFrame) -> DataFrame:
    """Verified rows, the first of a term by index, with their last translation row by index."""
    v = verified.groupBy("term").agg(F.min_by(F.struct(*[c for c in verified.columns if c != "term"]), "index").alias("v")).select("term", "v.*")
    rest = [c for c in translations.columns if c not in ("term", "index")]
    t = translations.groupBy("term").agg(F.max_by(F.struct(*rest), "index").alias("t")).select("term", "t.*")
    return v.join(t, "term", "left")
