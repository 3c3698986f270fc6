"""A small front for single texts and words: what a terminology or dictionary agent is asked.

Every call is a query on the glossary and word tables, so the same methods serve one text and a
table of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from . import dictionary, glossary


@dataclass
class Terminology:
    """glossary: (pair, source, target, load_order); words: (word), the general word list."""

    glossary: DataFrame
    words: DataFrame
    lexicon: L.Lexicon = field(default_factory=L.Lexicon)

    def _texts(self, texts: list[str] | DataFrame) -> DataFrame:
        if isinstance(texts, DataFrame):
            return texts
        return self.glossary.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def _pair(self, src: str, tgt: str) -> str | None:
        asked = self.glossary.sparkSession.createDataFrame([(src, tgt)], "src string, tgt string")
        row = glossary.resolve_pairs(asked, self.glossary).first()
        return row["pair"] if row else None

    def text_terms(self, texts: list[str] | DataFrame, src: str, tgt: str) -> DataFrame:
        """(doc_id, term, kind, translation): the glossary's terms in the texts; none without a glossary for the pair."""
        g, pair = self.glossary, self._pair(src, tgt) or ""
        return glossary.term_details(glossary.used_terms(self._texts(texts).select("doc_id", "text"), g, pair), g, pair)

    def overview(self) -> DataFrame:
        """(pair, source_language, target_language, n_terms) of what is loaded."""
        return glossary.statistics(self.glossary)

    def related(self, terms: list[str], each: int = 5) -> DataFrame:
        """(term, duplicates, related): sources that equal, hold or are held by each term."""
        rows = self.glossary.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        return glossary.related(rows, self.glossary, each)

    def translate(self, texts: list[str] | DataFrame, src: str, tgt: str) -> DataFrame:
        """The texts with the column replaced: terms put into the target language, longest first, do-not-translate terms kept."""
        return glossary.replaced(self._texts(texts), self.glossary, self._pair(src, tgt) or "")

    def lookup(self, words: str | list[str] | DataFrame) -> DataFrame:
        """(term, in_dictionary, method, confidence, found_as) of one word, many, or a table with the column term."""
        if not isinstance(words, DataFrame):
            many = [words] if isinstance(words, str) else words
            words = self.glossary.sparkSession.createDataFrame([(w,) for w in many], "term string")
        return dictionary.classify_terms(words, self.words, self.lexicon)
