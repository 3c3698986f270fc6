"""Readers: extraction CSV, glossary trees, term JSON in several shapes, damaged JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import batches, store, terms

TERM_COLUMNS = ("Final_Curated_Terms", "Final_Curated_Terms_Detailed")
TEXT_COLUMNS = ("Original_Text", "Text", "Content")


def csv(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', **options)


def extraction(spark: SparkSession, path: str) -> DataFrame:
    """Combined terms of an extraction CSV; needs one of the two term columns."""
    df = csv(spark, path)
    if not set(TERM_COLUMNS) & set(df.columns):
        raise ValueError(f"none of the columns {list(TERM_COLUMNS)} is in {path}")
    return terms.row_terms(df.withColumn("source_row", F.monotonically_increasing_id()), list(TERM_COLUMNS), list(TEXT_COLUMNS), "source_row")


def pair_of_path(path: Column) -> Column:
    """The language pair that a glossary file's place under data/ names, or null."""
    rest = F.regexp_extract(path, r"/data/(.+)$", 1)
    parts = F.split(rest, "/")
    file = F.element_at(parts, -1)
    stem = F.regexp_replace(file, r"\.csv$", "")
    folder = F.upper(F.try_element_at(parts, F.lit(3)))
    in_domain = (F.size(parts) > 3) & folder.isin(L.GLOSSARY_DOMAINS) & file.contains("_")
    to_others = F.concat(F.lit("ENG-"), F.upper(F.when(in_domain, F.split(file, "_")[1]).otherwise(stem)))
    from_others = F.concat(F.upper(F.when(file.contains("-EN_"), F.split(file, "-EN_")[0]).otherwise(stem)), F.lit("-ENG"))
    ui = F.split(stem, "-")
    return (
        F.when(F.lower(file) == "dnt.csv", "DNT").when(F.lower(file).isin("index.csv", "sample.csv"), None)
        .when(rest.startswith("general/english-to-others/"), to_others).when(rest.startswith("general/others-to-english/") & ~from_others.startswith("-"), from_others)
        .when(rest.startswith("ui-element/") & (F.size(ui) == 2), F.upper(stem))
    )


def glossary_tree(spark: SparkSession, root: str) -> DataFrame:
    """(pair, source, target, load_order) of all glossary files under root/data; files in path order, later ones win.

    Byte order marks are dropped by the reader; rows with an empty side are left out.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("header", True).option("multiLine", True).option("escape", '"').schema("source string, target string").csv(f"{root.rstrip('/')}/data")
    path = F.col("_metadata.file_path")
    order = F.monotonically_increasing_id()
    rows = raw.select(pair_of_path(path).alias("pair"), path.alias("file"), T.strip(F.col("source")).alias("source"), T.strip(F.col("target")).alias("target"), order.alias("line"))
    named = rows.where("pair is not null and source <> '' and target <> ''")
    # the order of files is that of their paths: a rank among the distinct paths, and the line within
    files = batches.numbered(named.select("file").distinct(), "file", "rank")
    return named.join(files, "file").select("pair", "source", "target", (F.shiftleft(F.col("rank") - 1, 40) + F.col("line") % F.lit(1 << 40)).alias("load_order"), "file")


def glossary_rows(spark: SparkSession, root: str) -> DataFrame:
    """(file, source, target, two_columns) of every row of the glossary files under root, as they stand.

    Empty fields are empty strings; two_columns is false where a row has fewer or more fields.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("header", True).option("multiLine", True).option("escape", '"')
    raw = rows.option("columnNameOfCorruptRecord", "bad").schema("source string, target string, bad string").csv(root)
    ok = F.col("bad").isNull()
    filled = lambda c: F.when(ok, F.coalesce(c, F.lit(""))).otherwise(F.col(c))
    return raw.select(F.col("_metadata.file_path").alias("file"), filled("source").alias("source"), filled("target").alias("target"), ok.alias("two_columns"))


def first_lines(spark: SparkSession, root: str) -> DataFrame:
    """(file, first_line) of glossary files, for the header check."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("file"), F.split("value", "\n")[0].alias("first_line"))


def term_json(spark: SparkSession, path: str) -> DataFrame:
    """(term, frequency, contexts, pos_tags) of JSON term files: a list, or an object with one of three keys."""
    text = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    lists = [F.try_variant_get("v", f"$.{k}", "array<variant>") for k in ("terms", "dictionary_terms", "non_dictionary_terms")]
    items = text.select(F.explode(F.coalesce(*lists, F.try_variant_get("v", "$", "array<variant>"))).alias("t"))
    get = lambda p, t: F.try_variant_get("t", p, t)
    none = F.array().cast("array<string>")
    return items.select(
        get("$.term", "string").alias("term"), F.coalesce(get("$.frequency", "long"), F.lit(1)).alias("frequency"),
        F.coalesce(get("$.original_texts.texts", "array<string>"), none).alias("contexts"), F.coalesce(get("$.pos_tag_variations.tags", "array<string>"), none).alias("pos_tags"),
    ).where("term is not null")


def prioritised(spark: SparkSession, path: str, least: int = 2) -> DataFrame:
    return terms.by_priority(terms.loadable(term_json(spark, path), least))


def enriched_from_simple(df: DataFrame) -> DataFrame:
    """(term, frequency, contexts, pos_tags) from Terms, POS_Tags, Sample_Texts, Text_Count, Frequency; at most ten texts, no 'more texts' marks."""
    texts = F.filter(F.transform(F.split("Sample_Texts", r" \| "), T.strip), lambda t: (t != "") & ~t.rlike(r"^\[\.\.\. .*more texts\]$"))
    tags = F.filter(F.transform(F.split("POS_Tags", r"[|,]"), T.strip), lambda t: t != "")
    return df.select(
        T.strip(F.col("Terms")).alias("term"), F.expr("try_cast(Frequency as bigint)").alias("frequency"), F.coalesce(F.slice(texts, 1, 10), F.array().cast("array<string>")).alias("contexts"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("pos_tags"),
    ).where("term <> ''")


def simple_statistics(enriched: DataFrame) -> DataFrame:
    has = F.size("contexts") > 0
    return enriched.agg(F.count_if(has).alias("with_contexts"), F.count_if(~has).alias("without_contexts"), F.round(F.avg("frequency"), 6).alias("average_frequency"), F.max("frequency").alias("max_frequency"), F.min("frequency").alias("min_frequency"))


def json_or_backup(spark: SparkSession, schema: str, path: str, *backups: str) -> DataFrame:
    """Rows of the first file that holds valid JSON; of none, the salvaged rows of the first; an empty table without any."""
    for p in (path, *backups):
        text = spark.read.text(p, wholetext=True)
        if text.where(F.try_parse_json("value").isNotNull()).limit(1).count():
            return spark.read.schema(schema).option("multiLine", True).json(p)
    return salvage(spark.read.text(path, wholetext=True).select(F.col("value").alias("text")), schema)


def salvage(df: DataFrame, schema: str) -> DataFrame:
    """Flat finished objects that can be read out of damaged JSON text."""
    found = df.select(F.explode(F.regexp_extract_all("text", F.lit(r'(?s)(\{[^{}]*"status"\s*:\s*"completed"[^{}]*\})'), F.lit(1))).alias("raw"))
    return found.where(F.try_parse_json("raw").isNotNull()).select(F.from_json("raw", schema).alias("r")).select("r.*").where("term is not null")


def salvage_counters(text: Column) -> Column:
    """struct(total_terms, completed_terms, remaining_terms): the last value of each counter in damaged JSON."""
    last = lambda k: F.try_element_at(F.regexp_extract_all(text, F.lit(rf'"{k}"\s*:\s*(\d+)'), F.lit(1)), F.lit(-1)).cast("long")
    return F.struct(*(last(k).alias(k) for k in ("total_terms", "completed_terms", "remaining_terms")))


def json_ok(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """The first path that exists, in whatever store Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            return p
    return None


def pending(spark: SparkSession, processed: DataFrame, *paths: str) -> DataFrame:
    """Terms of the first file there is, without those already processed."""
    path = first_existing(spark, *paths)
    if path is None:
        raise FileNotFoundError(", ".join(paths))
    return terms.missing(term_json(spark, path), processed)


def store_import(spark: SparkSession, path: str, seen_at: Column, source_name: str | None = None) -> DataFrame:
    """Arrivals for the store of rare terms: the rows with frequency 1 of a JSON term file, or of a CSV with Terms and Frequency.

    A CSV's Original Text and pos_tags become the contexts and tags where it has them. Rows
    without a term are left out; a file of another kind is refused.
    """
    if path.rstrip("/").endswith(".json"):
        rows = term_json(spark, path)
    elif path.rstrip("/").endswith(".csv"):
        df = csv(spark, path)
        if not {"Terms", "Frequency"} <= set(df.columns):
            raise ValueError(f"{path} has no columns Terms and Frequency")
        one = lambda c: F.array_compact(F.array(F.col(f"`{c}`"))) if c in df.columns else F.array().cast("array<string>")
        rows = df.select(F.col("Terms").alias("term"), F.expr("try_cast(Frequency as bigint)").alias("frequency"), one("Original Text").alias("contexts"), one("pos_tags").alias("pos_tags"))
    else:
        raise ValueError(f"{path} is neither JSON nor CSV")
    return store.arrivals_of(rows, source_name or path, seen_at)
