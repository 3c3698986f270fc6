"""Context sentences for exported terms, by keyword patterns and templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T

#: The sentences of this module, which exports must hold word for word.
CONDITIONAL = "Technical term used in CAD/engineering software; conditionally approved for terminology database."
APPROVED = "Technical term used in CAD/engineering software; approved for terminology database."


def fallback(decision: Column) -> Column:
    return F.when(decision.contains("CONDITIONALLY"), CONDITIONAL).otherwise(APPROVED)


def action(text: Column) -> Column:
    return T.first_of(((F.lower(text).contains(a), f"{a} objects or elements") for a in L.CONTEXT_ACTIONS), "perform operations")


def _first(text: Column, rules: tuple, other: str) -> Column:
    return T.first_of(((F.lower(text).contains(word), phrase) for word, phrase in rules), other)


def capability(text: Column) -> Column:
    return _first(text, (("convert", "converts or transforms data"), ("manage", "manages system resources"), ("display", "displays information or graphics")), "provides functionality")


def process(text: Column) -> Column:
    return _first(text, (("render", "rendering graphics or models"), ("export", "exporting data or files"), ("import", "importing external data")), "processing data or operations")


def file_action(text: Column) -> Column:
    return _first(text, (("save", "saving project data"), ("load", "loading external files")), "managing project files")


def pattern(texts: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """The group with the most keywords in the first three texts, the earlier of equals; null without any."""
    names = F.array(*(F.lit(name) for name, _ in L.CONTEXT_PATTERNS))

    def scores(text: Column) -> Column:
        return F.array(*(T.count_contained(text, [*words, *(lexicon.product_names if name == "cad" else ())]) for name, words in L.CONTEXT_PATTERNS))

    counts = T.bound(F.lower(F.array_join(F.slice(texts, 1, 3), " ")), scores)
    return T.bound(counts, lambda s: F.when(F.array_max(s) > 0, F.element_at(names, F.array_position(s, F.array_max(s)).cast("int"))))


def template(name: Column, text: Column) -> Column:
    sentence = (
        F.when(name == "command", F.concat(F.lit("Command used in CAD software to "), action(text)))
        .when(name == "feature", F.concat(F.lit("Feature that "), capability(text), F.lit(" in design applications")))
        .when(name == "process", F.concat(F.lit("Process of "), process(text), F.lit(" in engineering workflows")))
        .when(name == "object", "Design element used for design and modeling purposes in 3D modeling")
        .when(name == "interface", "Interface element for user interaction and control in software applications")
        .when(name == "file", F.concat(F.lit("File operation for "), file_action(text), F.lit(" in CAD systems")))
        .when(name == "modeling", "3D modeling tool for creating and manipulating 3D geometry")
        .when(name == "cad", "CAD function for technical design and documentation in technical drawings")
        .when(name == "graphics", "Graphics feature for visual representation and rendering in visual design")
    )
    return F.when(F.length(sentence) > 150, F.concat(F.substring(sentence, 1, 147), F.lit("..."))).otherwise(sentence)


def describe(texts: Column, decision: Column, lexicon: L.Lexicon = L.DEFAULT) -> Column:
    """The offline describer: a template by pattern, else the first text, else a fixed sentence."""
    first = F.try_element_at(texts, F.lit(1))
    name = pattern(texts, lexicon)
    empty = F.coalesce(F.size(texts), F.lit(0)) == 0
    return F.when(empty, fallback(decision)).when(name.isNotNull(), template(name, first)).otherwise(T.text_to_context(first, F.lit(APPROVED)))
