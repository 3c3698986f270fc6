"""Inputs of the registered queries, as SQL that both engines run, since the tables hold no glossary or translations.

ARR(...) and EMPTY stand for the engine's array constructor and an empty array of strings.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SAMPLES = (
    "api", "API", "AutoX v1.2", "v1.2.dwg", "extrude command", "loft feature", "new bolt", "click", "click save", "add button", "the", "ERR_42", "id_field", "http", "user interface design",
    "parameterization", "running", "stops", "quickly", "colored", "baaad", "x", "is", "error log", "PRO2024", "M24X750", "software update", "market share", "family car", "customer order",
    "simulation mesh", "process step", "work order", "press enter", "toggle machine", "set value", "Ångström unit", "über grün", "red", "left", "create new item", "fillet", "mesh", "dialog window",
    "inventory menu", "custom fixture", "machine part", "show all", "www.site.com", "config.txt", "version_2", "status",
)

TERMS = f"""
SELECT term, CAST(sum(n) AS BIGINT) AS frequency FROM (
  SELECT p_name AS term, 1 AS n FROM {{part}} UNION ALL SELECT p_type, 1 FROM {{part}} UNION ALL SELECT event_type, 1 FROM {{events}}
  UNION ALL SELECT o_orderpriority, 1 FROM {{orders}} UNION ALL SELECT c_mktsegment, 1 FROM {{customer}}
  UNION ALL SELECT term, length(term) FROM (VALUES {", ".join(f"('{s}')" for s in SAMPLES)}) AS s(term)
) AS t GROUP BY term
"""

CONTEXTS = f"""
SELECT term, frequency, CASE
  WHEN frequency % 4 = 0 THEN EMPTY
  WHEN frequency % 4 = 1 THEN ARR('Click the button for ' || term || ' in the menu', 'The API endpoint returns ' || term, 'Warehouse stock of ' || term, 'A process step on the machine')
  WHEN frequency % 4 = 2 THEN ARR('Error: ' || term || ' failed in the software', 'set the value of the parameter for every design element')
  ELSE ARR('A note about ' || term || '. Another sentence with many more words that goes on for long enough to pass the limit of one hundred and fifty characters set by the rules.') END AS contexts
FROM ({TERMS}) AS t
"""

TRANSLATIONS = f"""
SELECT term, language, CASE (length(term) + i) % 6 WHEN 0 THEN 'ERROR: no model' WHEN 1 THEN upper(term) WHEN 2 THEN ' ' WHEN 3 THEN repeat(term || '-', 6) ELSE reverse(term) || 'e' END AS translation
FROM ({TERMS}) AS t CROSS JOIN (VALUES ('deu_Latn', 0), ('fra_Latn', 1), ('spa_Latn', 4), ('ita_Latn', 5), ('jpn_Jpan', 10), ('kor_Hang', 11), ('por_Latn', 16), ('rus_Cyrl', 3)) AS l(language, i)
"""

GLOSSARY = """
SELECT pair, source, target, CAST(load_order AS BIGINT) AS load_order FROM (VALUES
  ('ENG-DEU', 'thing', 'Ding', 1), ('ENG-DEU', 'ation', 'ierung', 2), ('ENG-DEU', 'the', 'das', 3), ('ENG-DEU', 'the', 'die', 7), ('ENG-DEU', 'ing', 'end', 4), ('ENG-DEU', 'bolt', 'Bolzen', 5),
  ('ENG-FRE', 'bolt', 'boulon', 6), ('ENG-FRE', 'new', 'nouveau', 8), ('EN-DE', 'gear', 'Zahnrad', 9), ('DNT', 'that', 'that', 10), ('DNT', 'ou', 'ou', 11), ('DNT', 'ation', 'ation', 12), ('ENG-CSY', 'red', 'rudy', 13)
) AS g(pair, source, target, load_order)
"""

BATCHES = "SELECT DISTINCT CAST(o_custkey % 997 AS BIGINT) AS batch_id FROM {orders} WHERE o_custkey % 997 % 7 NOT IN (3, 4)"

ARRIVALS = """
SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END || '|' || CAST(user_id AS VARCHAR(20)) AS term, 'file' || CAST(event_id % 5 AS VARCHAR(20)) AS source_file,
  ARR('ctx ' || event_type, 'ctx ' || CAST(event_id % 3 AS VARCHAR(20))) AS contexts, ARR(event_type) AS pos_tags, CAST(NULL AS VARCHAR(20)) AS metadata, ts AS seen_at
FROM {events}
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(re.sub(r"\bARR\(", "array(", sql).replace("EMPTY", "cast(array() as array<string>)"), **used)


def other(sql: str) -> str:
    """The same input for the other engine."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return re.sub(r"\bARR\(", "list_value(", sql).replace("EMPTY", "CAST([] AS VARCHAR[])")
