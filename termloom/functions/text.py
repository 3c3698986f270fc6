"""Column expressions on text: cleaning, words, keys and language codes."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

NOT_ALLOWED = r"[^\p{L}\p{N}_\s\-.]"


def any_of(conditions: Iterable[Column]) -> Column:
    return functools.reduce(operator.or_, conditions, F.lit(False))


def first_of(rules: Iterable[tuple], other) -> Column:
    """One CASE: the value of the first rule (condition, value) that holds."""
    rules = list(rules)
    other = other if isinstance(other, Column) else F.lit(other)
    if not rules:
        return other
    out = F.when(*rules[0])
    for condition, value in rules[1:]:
        out = out.when(condition, value)
    return out.otherwise(other)


def bound(c: Column, fn) -> Column:
    """fn(c) with c computed once."""
    return F.transform(F.array(c), fn)[0]


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """Whether any of the words is a substring; one regular expression instead of a chain of tests."""
    words = list(words)
    return c.rlike("|".join(re.escape(w) for w in words)) if words else F.lit(False)


def count_contained(c: Column, words: Iterable[str]) -> Column:
    """How many of the words are substrings."""
    return functools.reduce(operator.add, (F.when(c.contains(w), 1).otherwise(0) for w in words), F.lit(0))


def strip(c: Column) -> Column:
    """Remove outer white space of any kind, not only spaces."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def words(c: Column) -> Column:
    """Parts between white space, no empty ones."""
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def clean_term(c: Column) -> Column:
    """Trim; null for fewer than two characters or digits only; drop signs; single spaces; empty is null."""
    t = strip(c)
    cleaned = strip(F.regexp_replace(F.regexp_replace(t, NOT_ALLOWED, ""), r"(?U)\s+", " "))
    # words of letters only, most of a text, are clean as they stand
    return F.when(c.rlike(r"^\p{L}{2,}\z"), c).when((F.length(t) >= 2) & ~t.rlike(r"^\p{Nd}+$") & (cleaned != ""), cleaned)


def split_terms(c: Column) -> Column:
    """Cleaned terms of a field: parts between |, else between commas, else the whole."""
    parts = F.when(c.contains("|"), F.split(c, r"\|")).when(c.contains(","), F.split(c, ",")).otherwise(F.array(c))
    return F.filter(F.transform(parts, clean_term), lambda t: t.isNotNull())


def parse_term_field(c: Column) -> Column:
    """Terms of a field that may be JSON (a list of objects with a term or of strings, or one object) or plain text.

    Mixed lists are read as variants, so objects and strings may stand side by side. Where JSON
    gives no term, the field is split as text.
    """
    v = F.when(c.rlike(r"^\s*[\[{]"), F.try_parse_json(c))
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(F.try_variant_get(v, "$.term", "string").isNotNull(), F.array(v)))
    named = F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$.term", "string"), F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))))
    found = F.filter(F.transform(named, clean_term), lambda t: t.isNotNull())
    return F.when(F.coalesce(F.size(found), F.lit(0)) > 0, found).otherwise(split_terms(c))


def pick_text(*candidates: Column, length: int = 200) -> Column:
    """The first candidate that isn't null, cut to length."""
    return F.substring(F.coalesce(*candidates), 1, length)


def term_id(c: Column) -> Column:
    return F.substring(F.md5(F.lower(c)), 1, 16)


def term_hash8(c: Column) -> Column:
    return F.substring(F.md5(c), 1, 8)


def cache_key(term: Column, src: Column, tgt: Column, context: Column) -> Column:
    """md5 of term|src|tgt|context; a null target counts as the word None."""
    return F.md5(F.concat_ws("|", term, src, F.coalesce(tgt, F.lit("None")), context))


def _lookup(mapping: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))


def language(c: Column) -> Column:
    """Normal form of a language code: aliases, CORE_x_TERMS, region suffixes, else upper case."""
    low = F.lower(c)
    alias = F.try_element_at(_lookup({a: code for code, names in L.LANGUAGE_CODES.items() for a in names}), low)
    core = F.when(c.startswith("CORE_") & c.contains("_TERMS"), F.replace(F.replace(c, F.lit("CORE_"), F.lit("")), F.lit("_TERMS"), F.lit("")))
    region = F.when(low.contains("-") & (low != "zh-tw"), F.split(low, "-")[0])
    return F.coalesce(alias, core, region, F.upper(c))


def standard_code(c: Column) -> Column:
    return F.try_element_at(_lookup(L.STANDARD_CODES), c)


def translator_code(c: Column) -> Column:
    return F.try_element_at(_lookup(L.TRANSLATOR_CODES), c)


def html_clean(c: Column) -> Column:
    """Tags, entities and bracketed parts removed, single spaces."""
    c = F.regexp_replace(c, r"<[^>]*>", "")
    c = F.regexp_replace(c, r"&[a-zA-Z0-9#]+;", " ")
    c = F.regexp_replace(c, r"\[[^\]]*\]", "")
    c = F.regexp_replace(c, r"[<>\[\]]", "")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def result_clean(c: Column) -> Column:
    """html_clean over the values of a map of strings."""
    return F.transform_values(c, lambda _, v: html_clean(v))


def json_text_clean(c: Column) -> Column:
    """Clean JSON text as a string (it also removes array brackets; for compatibility only)."""
    c = F.regexp_replace(c, r"\[/?[a-zA-Z0-9_-]+\]", "")
    c = F.regexp_replace(c, r"[\[\]]", "")
    c = F.regexp_replace(c, r"<[^>]*>", "")
    c = F.regexp_replace(c, r"&[a-zA-Z0-9#]+;", " ")
    return F.regexp_replace(c, r"(?U)\s+", " ")


def context_samples(texts: Column, n: int = 10) -> Column:
    """The first n texts, trimmed, without empty ones, joined by '; '."""
    return F.array_join(F.filter(F.transform(F.slice(texts, 1, n), strip), lambda t: t != ""), "; ")


def prompt_sample(texts: Column, cut: int = 150) -> Column:
    """A few texts for a prompt: 7 spread over more than ten, the first five of six to ten, else all; cut to length."""
    n = F.size(texts)
    spread = F.transform(F.array(F.lit(1), F.lit(2), F.floor(n / 3) + 1, F.floor(n / 2) + 1, n - 2, n - 1, n), lambda i: F.try_element_at(texts, i.cast("int")))
    chosen = F.when(n > 10, spread).when(n >= 6, F.slice(texts, 1, 5)).otherwise(texts)
    return F.transform(chosen, lambda t: F.when(F.length(t) > cut, F.concat(F.substring(t, 1, cut), F.lit("..."))).otherwise(t))


def text_to_context(text: Column, fallback: Column) -> Column:
    """A text of at most 150 characters, else its first sentence, else its start; fallback under 10."""
    t = strip(F.translate(text, "\"'", ""))
    first = F.split(t, r"\.")[0]
    long = F.when(F.length(first) <= 150, F.concat(strip(first), F.lit("."))).otherwise(F.concat(F.substring(t, 1, 147), F.lit("...")))
    return F.when(text.isNull() | (F.length(text) < 10), fallback).when(F.length(t) <= 150, t).otherwise(long)


def split_texts(c: Column) -> Column:
    """Stored texts back from '; '-joined text."""
    return F.filter(F.transform(F.split(c, "; "), strip), lambda t: t != "")


def batch_numbers(c: Column) -> Column:
    """'3-5,10' as the ordered numbers; parts that are no number or range are left out."""
    parts = F.filter(F.transform(F.split(c, ","), strip), lambda p: p.rlike(r"^\d+(\s*-\s*\d+)?$"))
    ends = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^(\d+)", 1).cast("int").alias("a"), F.regexp_extract(p, r"(\d+)$", 1).cast("int").alias("b")))
    ranges = F.transform(F.filter(ends, lambda e: e["a"] <= e["b"]), lambda e: F.sequence(e["a"], e["b"]))
    return F.array_sort(F.array_distinct(F.flatten(ranges)))


def entropy(counts: Column) -> Column:
    """Shannon entropy (nats) of an array of counts."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.filter(counts, lambda x: x > 0), F.lit(0.0), lambda s, x: s - x / total * F.ln(x / total))
