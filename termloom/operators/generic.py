"""Generic-term detection: three votes, a graduated penalty and technical protection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T


def _verdict(*rules: tuple[Column, float], other: float) -> Column:
    """struct(generic, confidence) of the first rule that holds."""
    generic = T.first_of(((condition, True) for condition, _ in rules), False)
    return F.struct(generic.alias("generic"), T.first_of(rules, other).alias("confidence"))


def context_type(c: Column) -> Column:
    return T.first_of(((T.contains_any(F.lower(c), words), name) for name, words in L.CONTEXT_TYPES), "General")


def _times(types: Column, name: str) -> Column:
    return F.size(F.filter(types, lambda t: t == name)).cast("double")


def by_contexts(contexts: Column) -> Column:
    """Method 1: few nats over at least four types of contexts; fewer than three contexts say nothing."""
    types = F.transform(contexts, context_type)
    names = [n for n, _ in L.CONTEXT_TYPES] + ["General"]
    counts = F.array(*(_times(types, n) for n in names))
    used = F.size(F.filter(counts, lambda x: x > 0))
    enough = F.coalesce(F.size(contexts), F.lit(0)) >= 3
    hit = enough & (T.entropy(counts) < 1.0) & (used >= 4)
    return F.struct(F.coalesce(hit, F.lit(False)).alias("generic"), F.when(~enough, 0.0).when(hit, 0.7).otherwise(0.3).alias("confidence"))


def by_frequency(term: Column) -> Column:
    """Method 2: common short words, actions, adjectives, interface words, colours, directions, and pairs with them."""
    low, w = F.lower(term), T.words(F.lower(term))
    one, first, last = F.size(w) == 1, F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(-1))
    more = F.size(w) >= 2
    return _verdict(
        (one & (F.length(low) <= 4) & low.isin(L.SHORT_COMMON), 0.85),
        (one & low.isin(L.ACTIONS), 0.80),
        (one & low.isin(L.ADJECTIVES), 0.75),
        (one & low.isin(L.UI_NOUNS), 0.70),
        (one & low.isin(L.COLORS), 0.85),
        (one & low.isin(L.DIRECTIONS), 0.80),
        (more & first.isin([*L.ACTIONS, "new", "old"]), 0.75),
        (more & last.isin(L.UI_NOUNS), 0.70),
        other=0.3,
    )


def by_patterns(term: Column) -> Column:
    """Method 5: known generic words, alone, in pairs, or as half of a longer term."""
    low, w = F.lower(term), T.words(F.lower(term))
    known = F.array(*(F.lit(x) for x in L.generic_words()))
    count = F.size(F.filter(w, lambda x: F.array_contains(known, x)))
    first, second = F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(2))
    pair = (F.size(w) == 2) & F.array_contains(known, first) & (first.isin(L.PAIR_ACTIONS) | second.isin(L.PAIR_UI))
    return _verdict(
        ((F.size(w) == 1) & F.array_contains(known, low), 0.75),
        (F.coalesce(pair, F.lit(False)), 0.70),
        ((F.size(w) > 1) & (count >= F.size(w) * 0.5), 0.60),
        other=0.4,
    )


def protection(term: Column) -> Column:
    """The reason that halves the penalty, or null: a technical suffix, a domain root, three words. First in sorted order."""
    w = T.words(F.lower(term))
    out = F.when(F.size(w) >= 3, "Multi-word compound term")
    roots = F.array(*(F.lit(r) for r in sorted(L.DOMAIN_ROOTS)))
    suffixes = F.array(*(F.lit(s) for s in sorted(L.TECHNICAL_SUFFIXES)))
    root = F.try_element_at(F.filter(roots, lambda r: F.exists(w, lambda x: x.contains(r))), F.lit(1))
    suffix = F.try_element_at(F.filter(suffixes, lambda s: F.exists(w, lambda x: x.endswith(s) & (F.length(x) > F.length(s) + 2))), F.lit(1))
    return F.coalesce(F.concat(F.lit("Has technical suffix '-"), suffix, F.lit("'")), F.concat(F.lit("Contains domain root '"), root, F.lit("'")), out)


def detect(term: Column, contexts: Column) -> Column:
    """struct(m1, m2, m5, votes, confidence, is_generic, protection, penalty)."""
    m1, m2, m5 = by_contexts(contexts), by_frequency(term), by_patterns(term)
    votes = sum((m["generic"].cast("int") for m in (m1, m2, m5)), F.lit(0))
    base = F.when(votes == 3, -0.15).when(votes == 2, -0.07).when(votes == 1, -0.03).otherwise(0.0)
    reason = protection(term)
    return F.struct(
        m1["generic"].alias("m1"), m2["generic"].alias("m2"), m5["generic"].alias("m5"), votes.alias("votes"),
        F.round((m1["confidence"] + m2["confidence"] + m5["confidence"]) / 3, 6).alias("confidence"), (votes >= 2).alias("is_generic"),
        reason.alias("protection"), F.round(F.when(reason.isNotNull(), base * 0.5).otherwise(base), 6).alias("penalty"),
    )


def penalised(score: Column, penalty: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score + penalty))
