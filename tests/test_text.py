import pytest
from pyspark.sql import functions as F

from termloom.functions import text as T


def one(spark, fn, *values, types="string"):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {t}" for i, t in enumerate([types] * len(values) if isinstance(types, str) else types)))
    return df.select(fn(*(F.col(c) for c in df.columns)).alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("  a@b  c! ", "ab c"), ("7", None), ("2024", None), ("!!", None), ("x", None), ("a!", "a"), (None, None), ("", None), ("ö&ü -x.y", "öü -x.y"), (" ab ", "ab")])
def test_clean_term(spark, raw, want):
    assert one(spark, T.clean_term, raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("a1 | b2, c", ["a1", "b2 c"]), ("aa, bb ,7", ["aa", "bb"]), ("single term", ["single term"]), ('[{"term": "ab"}, "cd", 5]', ["ab", "cd"]), ('{"term": "one two"}', ["one two"]),
        ("[broken | text", ["broken", "text"]), ('[{"other": 1}]', ["other 1"]),
    ],
)
def test_parse_term_field(spark, raw, want):
    assert one(spark, T.parse_term_field, raw) == want


def test_batch_numbers(spark):
    assert one(spark, T.batch_numbers, "3-5,10") == [3, 4, 5, 10]
    assert one(spark, T.batch_numbers, "9-3, x, 2 ,2") == [2]


def test_language(spark):
    assert [one(spark, T.language, x) for x in ("de", "CORE_FRA_TERMS", "pt-BR", "zh-tw", "xx")] == ["DEU", "FRA", "pt", "CHT", "XX"]


def test_html_clean(spark):
    assert one(spark, T.html_clean, "<p>A &amp; B</p> [link]x[/link]  <b") == "A B x b"


def test_prompt_sample(spark):
    texts = [f"t{i}" for i in range(12)]
    assert one(spark, T.prompt_sample, texts, types="array<string>") == ["t0", "t1", "t4", "t6", "t9", "t10", "t11"]
    assert one(spark, T.prompt_sample, texts[:7], types="array<string>") == texts[:5]
    assert one(spark, T.prompt_sample, ["x" * 200], types="array<string>") == ["x" * 150 + "..."]


def test_text_to_context(spark):
    f = lambda c: T.text_to_context(c, F.lit("fallback"))
    assert one(spark, f, "short") == "fallback"
    assert one(spark, f, "A sentence of text.") == "A sentence of text."
    assert one(spark, f, "First. " + "x" * 200) == "First."
    assert one(spark, f, "y" * 200) == "y" * 147 + "..."


def test_cache_key_of_null_target(spark):
    import hashlib

    got = one(spark, T.cache_key, "a", "EN", None, "c")
    assert got == hashlib.md5(b"a|EN|None|c").hexdigest()
