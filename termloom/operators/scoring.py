"""Term characteristics, the quality score with its penalties, and context analysis."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T


def characteristics(term: Column) -> Column:
    """Ten facts about the form of a term."""
    low = F.lower(term)
    return F.struct(
        F.length(term).alias("length"),
        term.rlike(r"\p{Nd}").alias("has_numbers"),
        term.rlike("[" + re.escape(L.SPECIAL_CHARS) + "]").alias("has_special_chars"),
        (F.length(term) <= 3).alias("is_very_short"),
        (F.length(term) > 15).alias("is_long"),
        (term.contains(".") & T.contains_any(low, L.FILE_WORDS)).alias("is_filename"),
        T.contains_any(low, L.ERROR_CHARACTER).alias("is_error_related"),
        T.contains_any(low, L.CODE_PREFIXES).alias("is_technical_code"),
        (T.is_upper(term) & (F.length(term) <= 6)).alias("potential_acronym"),
        term.rlike(r"\d+\.\d+|\d+_\d+").alias("has_version_pattern"),
    )


def search_strategy(c: Column) -> Column:
    return (
        F.when(c["is_very_short"] | c["potential_acronym"], "definition_focused").when(c["is_filename"], "software_focused").when(c["is_error_related"], "error_focused")
        .when(c["is_technical_code"], "technical_focused").when(c["is_long"], "context_focused").otherwise("comprehensive")
    )


def context_score(term: Column, c: Column, texts: Column) -> Column:
    """Score from a term's form and the texts it occurs in, from 0 to 1."""
    joined = F.lower(F.array_join(texts, " "))
    inside = F.coalesce((F.size(texts) > 0) & joined.contains(F.lower(term)), F.lit(False))
    s = F.when(c["is_very_short"], 0.1).when(c["length"].between(4, 12), 0.3).otherwise(0.0)
    s = s + F.when(c["is_technical_code"] | c["is_error_related"], 0.2).otherwise(0.0) + F.when(c["is_filename"], 0.15).otherwise(0.0)
    s = s + F.when(inside, 0.3).otherwise(0.0) + F.when(inside & T.contains_any(joined, ("error", "system", "software", "technical")), 0.1).otherwise(0.0)
    s = s - F.when(c["has_special_chars"] & ~c["is_filename"], 0.1).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 6)


def context_status(score: Column) -> Column:
    return F.when(score >= 0.7, "accepted").when(score >= 0.5, "needs_review").when(score >= 0.3, "low_priority").otherwise("not_recommended")


def context_note(c: Column, texts: Column) -> Column:
    """The sentences that describe a term's form and contexts."""
    n = F.coalesce(F.size(texts), F.lit(0))
    return F.concat_ws(
        " ",
        F.when(c["is_very_short"], "Very short term, possibly an acronym or abbreviation."),
        F.when(c["is_filename"], "Appears to be a filename or system file reference."),
        F.when(c["is_error_related"], "Error-related term, likely used in system diagnostics."),
        F.when(c["is_technical_code"], "Technical coding pattern detected."),
        F.when(n > 0, F.concat(F.lit("Term context available from "), n.cast("string"), F.lit(" source texts."))).otherwise("No original context texts provided."),
    )


def fallback_review(term: Column, texts: Column) -> Column:
    """The offline reviewer: struct(score, status, strategy, web_ok, domain_relevance, confidence, note)."""
    c = characteristics(term)
    s = context_score(term, c, texts)
    boost = c["is_technical_code"] | c["is_error_related"]
    confidence = F.when(s > 0.3, 0.7).otherwise(0.3)
    return F.struct(
        s.alias("score"), context_status(s).alias("status"), search_strategy(c).alias("strategy"), (s > 0.3).alias("web_ok"),
        s.alias("domain_relevance"), F.round(F.when(boost, F.least(F.lit(1.0), s + 0.1)).otherwise(s), 6).alias("improved_relevance"),
        F.round(F.when(c["is_technical_code"], F.least(F.lit(1.0), confidence + 0.1)).otherwise(confidence), 6).alias("confidence"), context_note(c, texts).alias("note"),
    )


def enhanced_fallback_score(term: Column) -> Column:
    """The score of a term whose review gave no readable answer."""
    return F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.4), F.length(term) / F.lit(20.0))), 6)


def single_generic(word: Column, frequency: Column) -> Column:
    """How generic a single lower-case word is, from 0 to 0.2."""
    p = F.when(word.isin(L.UI_VERBS), 0.18).otherwise(0.0) + F.when(word.isin(L.SINGLE_UI_NOUNS), 0.16).otherwise(0.0) + F.when(word.isin(L.BROAD), 0.14).otherwise(0.0)
    p = F.when(word.isin(L.SINGLE_DOMAIN), 0.0).otherwise(p)
    affix = word.rlike("(" + "|".join(L.AFFIX_SUFFIXES) + ")$") | word.rlike("^(" + "|".join(L.AFFIX_PREFIXES) + ")")
    p = F.when(affix & (F.length(word) >= 8), p * 0.7).otherwise(p)
    p = F.when(frequency >= 30, p * 0.6).when(frequency < 3, p + 0.05).otherwise(p)
    return F.when(word.isin(L.VERY_COMMON), 0.20).otherwise(F.least(F.lit(0.20), p))


def pair_penalty(term: Column, frequency: Column) -> Column:
    """The penalty of a term of two words, from 0 to 0.25; other terms have none."""
    low = F.lower(term)
    w = T.words(low)
    a, b = F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(2))
    common = a.isin([*L.VERY_COMMON, *L.UI_COMMON]).cast("int") + b.isin([*L.VERY_COMMON, *L.UI_COMMON]).cast("int")
    broad = a.isin(L.PAIR_BROAD).cast("int") + b.isin(L.PAIR_BROAD).cast("int")
    domain = a.isin(L.PAIR_DOMAIN).cast("int") + b.isin(L.PAIR_DOMAIN).cast("int")
    p = F.when(common == 2, 0.15).when(common == 1, 0.08).otherwise(0.0) + broad * 0.06 - domain * 0.08
    p = p + F.when(frequency < 5, 0.05).when(frequency >= 20, -0.03).otherwise(0.0)
    p = p - F.when((domain == 2) | a.isin(L.PAIR_ADJECTIVES) | a.isin(L.PAIR_VERBS), 0.05).otherwise(0.0)
    p = p + F.when(a.isin(L.PAIR_GENERIC_VERBS) & b.isin(L.PAIR_GENERIC_NOUNS), 0.12).otherwise(0.0)
    smart = F.round(F.greatest(F.lit(0.0), F.least(F.lit(0.25), p)), 6)
    more = F.when(low.isin(list(L.ULTRA_PHRASES)), F.greatest(smart, F.lit(0.20))).otherwise(smart)
    more = F.when(a.isin("click", "press", "toggle") & ~b.isin("machine", "tool", "fixture"), F.greatest(more, F.lit(0.12))).otherwise(more)
    return F.when(F.size(w) != 2, 0.0).when(smart >= 0.10, smart).otherwise(F.least(F.lit(0.25), more))


def word_penalty(term: Column, frequency: Column) -> Column:
    """The penalty of a single word, from 0 to 0.5; longer terms go to pair_penalty."""
    low = F.lower(term)
    m = F.when(frequency >= 50, 0.5).otherwise(1.0)
    p = single_generic(low, frequency) * m + F.when(frequency < 10, m * 0.15).otherwise(0.0)
    p = p + F.when((F.length(term) < 4) & ~T.is_upper(term), m * 0.10).otherwise(0.0) + F.when(low.isin(L.ULTRA_GENERIC), 0.25).otherwise(0.0)
    single = F.when(low.isin(L.ACRONYMS) | (T.is_upper(term) & (F.length(term) <= 5)), 0.05).otherwise(F.least(F.lit(0.50), p))
    return F.round(F.when(F.size(T.words(term)) > 1, pair_penalty(term, frequency)).otherwise(single), 6)


def pattern_adjustment(term: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    low = F.lower(term)
    return F.when(T.contains_any(low, L.TECH_TOKENS), 0.1).when(T.contains_any(low, lexicon.product_names), 0.15).when(low.isin(L.STOP_LOAD), -0.3).otherwise(0.0)


def quality_score(term: Column, frequency: Column, relevance: Column, web_ok: Column, n_contexts: Column, *, lexicon: L.Lexicon = L.DEFAULT, compat: bool = False) -> Column:
    """The weighted quality score with pattern and genericness adjustments, three decimals.

    compat: richness is a constant 0.1 and rounding is half to even.
    """
    richness = F.lit(0.1) if compat else n_contexts / F.lit(10.0)
    s = F.least(F.lit(1.0), F.length(term) / F.lit(20.0)) * 0.1 + F.least(F.lit(1.0), frequency / F.lit(100.0)) * 0.2 + relevance * 0.3 + F.when(web_ok, 0.25).otherwise(0.0) + richness * 0.15
    s = F.least(F.lit(1.0), s + pattern_adjustment(term, lexicon))
    s = F.greatest(F.lit(0.0), s - word_penalty(term, frequency))
    return F.bround(s, 3) if compat else F.round(F.round(s, 9), 3)


def domains(term: Column, texts: Column) -> Column:
    """struct of five domains: the share of each one's keywords in the term and its texts."""
    text = F.lower(F.concat_ws(" ", term, F.array_join(texts, " ")))
    return F.struct(*(F.round(T.count_contained(text, w) / F.lit(float(len(w))), 6).alias(d) for d, w in L.DOMAINS.items()))


def context_quality(texts: Column) -> Column:
    """Length and variety of the texts, from 0 to 1."""
    n = F.size(texts)
    length = F.aggregate(texts, F.lit(0.0), lambda s, t: s + F.length(t)) / n
    all_words = F.flatten(F.transform(texts, lambda t: T.words(F.lower(t))))
    variety = F.size(F.array_distinct(all_words)) / F.greatest(F.lit(1), F.size(all_words))
    return F.round(F.when(F.coalesce(n, F.lit(0)) == 0, 0.0).otherwise(F.least(F.lit(1.0), (F.least(F.lit(1.0), length / 100) + variety) / 2)), 6)


def semantic_richness(term: Column, texts: Column) -> Column:
    """Occurrences of the term and of five indicators in the texts, a tenth each, at most 1."""
    text, low = F.lower(F.array_join(texts, " ")), F.lower(term)
    times = (F.length(text) - F.length(F.replace(text, low, F.lit("")))) / F.greatest(F.lit(1), F.length(low))
    return F.round(F.when(F.coalesce(F.size(texts), F.lit(0)) == 0, 0.1).otherwise(F.least(F.lit(1.0), (times + T.count_contained(text, L.RICHNESS)) / 10)), 6)


def usage_patterns(texts: Column) -> Column:
    text = F.lower(F.array_join(texts, " "))
    return F.array_compact(F.array(*(F.when(T.contains_any(text, w), name) for name, w in L.USAGE.items())))


def text_evidence(texts: Column, *, lexicon: L.Lexicon = L.DEFAULT, efficient: bool = False) -> Column:
    """struct(products, indicators, n_hits, usage, score) of a term's texts; usage: up to five hits with three words around."""
    texts = F.when(F.lit(efficient) & (F.size(texts) > 10), F.slice(texts, 1, 10)).otherwise(texts)
    text = F.lower(F.array_join(texts, " "))
    products = F.array_compact(F.array(*(F.when(text.contains(p), p) for p in lexicon.product_names))) if lexicon.product_names else F.array().cast("array<string>")
    found = F.array_compact(F.array(*(F.when(text.contains(k), k) for k in L.REVIEW_KEYWORDS)))
    three = F.slice(found, 1, 3)
    hits = kwic(T.words(text), lambda w: F.exists(three, lambda k: w.contains(k)))
    score = F.least(F.lit(0.5), F.size(products) * 0.2 + F.size(found) * 0.1 + F.size(hits) * 0.05)
    return F.struct(products.alias("products"), found.alias("indicators"), F.size(hits).alias("n_hits"), F.slice(hits, 1, 5).alias("usage"), F.round(score, 6).alias("score"))


def kwic(words: Column, hit, before: int = 3, after: int = 3) -> Column:
    """Each hit with the words around it."""
    at = F.filter(F.transform(words, lambda w, i: F.when(hit(w), i)), lambda i: i.isNotNull())
    return F.transform(at, lambda i: F.array_join(F.slice(words, F.greatest(i - before, F.lit(0)) + 1, i + after + 1 - F.greatest(i - before, F.lit(0))), " "))


def translation_insight(total: Column, translated: Column, same: Column, errors: Column, score: Column, samples: Column) -> Column:
    """struct(confidence, label, notes, contribution) on translation results; samples: an array of sample translations.

    contribution: what the results add to the review score, 0 without any.
    """
    conf = F.when(total > 0, (translated + same) / total * 0.4).otherwise(0.0) + score * 0.4 + F.when(total >= 50, 0.2).when(total >= 30, 0.15).when(total >= 20, 0.1).otherwise(0.0)
    conf = F.round(conf, 3)
    label = F.when(score >= 0.8, "Excellent").when(score >= 0.6, "Good").when(score >= 0.4, "Fair").otherwise("Limited")
    kinds = F.size(F.array_distinct(samples))
    notes = F.array_compact(F.array(
        F.when(score > 0.8, "high translatability").when(score > 0.5, "moderate translatability").otherwise("low translatability"),
        F.when(same > translated, "often unchanged"),
        F.when(errors == 0, "no errors").when(errors / F.nullif(total, F.lit(0)) > 0.2, "translation challenges"),
        F.when(kinds == 1, "highly consistent").when((kinds > 0) & (kinds / F.size(samples) < 0.3), "consistent"),
    ))
    wide = F.when(total >= 50, 0.05).when(total >= 30, 0.03).when(total >= 20, 0.02).otherwise(0.0)
    contribution = F.round(F.when(total > 0, F.round(score, 3) * 0.2 + conf * 0.1 + wide).otherwise(0.0), 6)
    return F.struct(conf.alias("confidence"), label.alias("label"), notes.alias("notes"), contribution.alias("contribution"))


def domain_relevance(exists: Column, related: Column, term: Column) -> Column:
    """Relevance from a known duplicate, related glossary terms and industry words, from -1 to 1."""
    s = F.when(exists, -0.3).otherwise(0.0) + F.least(F.lit(0.4), related * 0.1) + F.when(T.contains_any(F.lower(term), L.INDUSTRY_KEYWORDS), 0.2).otherwise(0.0)
    return F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s)), 6)


def review_score(context: Column, domain: Column, searches: Column, translation: Column, exists: Column) -> Column:
    """The reviewer's total: context, positive relevance, good searches, translation, less for a duplicate."""
    return F.round(context * 0.8 + F.greatest(F.lit(0.0), domain) * 0.3 + F.least(F.lit(0.25), searches * 0.08) + translation - F.when(exists, 0.25).otherwise(0.0), 6)


def review_status(score: Column, exists: Column) -> Column:
    return F.when(score >= 0.8, "recommended").when(score >= 0.5, "needs_review").when(score >= 0.3, "low_priority").when(exists, "unexpected_duplicate").otherwise("not_recommended")


def web_ok(result: Column) -> Column:
    """A search result that names no failure and has more than 50 characters."""
    return ~T.contains_any(F.lower(result), L.WEB_FAILURES) & (F.length(T.strip(result)) > 50)


def worth_saving(score: Column, related: Column, context: Column, web: Column, insight: Column) -> Column:
    """Whether a review result says anything: any of five signs."""
    return F.coalesce((score > 0) | (related > 0) | (context > 0) | web | (insight > 0), F.lit(False))
