"""Chat formatting by quotation linking, in DataFrame functions only.

Messages are cut into lines; a line's quote level is the number of > marks before its text.
Runs of lines of one level are quoted passages. Passages, their paragraphs and lines are
normalised, hashed and joined to the bodies, paragraphs and lines of earlier messages of the same conversation; the
latest earlier message that has the text is linked. A turn replies to the message that its
outermost quotes cover most of, or else to the turn before it. Messages come back without
quotes, in reply order: by their distance from the conversation's start, then by turn.

Orders within a conversation are found in levels, blocks of turns or ranges of depths and
summaries of them, so a conversation with a third of all messages is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._spark import cut, integer_id

MARKS = r"^(?:[ \t]{0,3}>)+[ \t]?"
PARAGRAPHS = r"\n[ \t]*\n"
#: Turns of a block.
TURNS = 1024


def normalised(text: Column) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed_lines(df: DataFrame) -> DataFrame:
    """(conv, turn, msg, at, level, line): every line with its quote level and bare text."""
    lines = df.select("conv", "turn", "msg", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    marks = F.regexp_extract("raw", MARKS, 0)
    return lines.select("conv", "turn", "msg", "at", F.length(F.regexp_replace(marks, "[^>]", "")).cast("long").alias("level"), F.substr(F.col("raw"), F.length(marks) + 1).alias("line"))


def bodies(df: DataFrame) -> DataFrame:
    """df with body: the message's lines without quote marks, outer white space removed; and the quoted lines' number and deepest level."""
    lines = F.split("text", "\n")
    marks = F.transform(lines, lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")))
    own = F.filter(lines, lambda x: ~x.rlike(MARKS))
    body = F.regexp_replace(F.regexp_replace(F.array_join(own, "\n"), r"^\s+", ""), r"\s+$", "")
    return df.withColumns({"body": body, "quoted_lines": F.size(F.filter(marks, lambda n: n > 0)).cast("long"), "max_level": F.coalesce(F.array_max(marks), F.lit(0)).cast("long")})


def _quotes(lines: DataFrame) -> DataFrame:
    """(conv, turn, level, hash, weight): quoted runs, their paragraphs (between blank quoted lines) and lines."""
    quoted = lines.where("level > 0")
    run = F.col("at") - F.row_number().over(Window.partitionBy("conv", "turn", "msg", "level").orderBy("at"))
    runs = quoted.withColumn("run", run)
    whole = runs.groupBy("conv", "turn", "msg", "level", "run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda s: s["line"]), "\n").alias("line"))
    parts = F.array_distinct(F.concat(F.array("line"), F.split("line", PARAGRAPHS)))
    units = whole.select("conv", "turn", "level", F.explode(parts).alias("line")).union(quoted.select("conv", "turn", "level", "line"))
    text = units.withColumn("text", normalised(F.col("line"))).where("text <> ''")
    return text.select("conv", "turn", "level", F.md5("text").alias("hash"), F.length("text").cast("long").alias("weight")).distinct()


def _originals(df: DataFrame) -> DataFrame:
    """(conv, turn, hash) of bodies, paragraphs and lines."""
    parts = F.concat(F.array("body"), F.split("body", PARAGRAPHS), F.split("body", "\n"))
    units = df.select("conv", "turn", F.explode(F.array_distinct(parts)).alias("part"))
    text = units.withColumn("text", normalised(F.col("part"))).where("text <> ''")
    return text.select("conv", "turn", F.md5("text").alias("hash")).distinct()


def _latest_before(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """rows with out: the largest value of the same keys at an earlier turn."""
    block = rows.withColumn("block", F.floor(F.col("turn") / TURNS).cast("long"))
    inside = Window.partitionBy(*keys, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    tops = block.groupBy(*keys, "block").agg(F.max(value).alias("top"))
    before = tops.select(*keys, "block", F.max("top").over(Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    return block.withColumn("near", F.max(value).over(inside)).join(before, [*keys, "block"]).withColumn(out, F.coalesce("near", "earlier")).drop("near", "earlier", "block")


def reply_order(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, parent_turn, parent_kind, depth, position, quoted_lines, max_level, body)
    for each message.

    parent_kind: quote, previous or root. depth: replies between the message and a root;
    position: from 1, by depth, then turn, role and body. Rows with the same conversation and turn
    are one node: their quotes count together and they share parent and depth. Rows without a
    conversation or turn stand alone: root, depth 0, position 1; both must be integers. A null text is empty. Quotes
    of any length link; those that match nothing earlier, or have no letter or digit, are removed
    but link nothing.
    """
    rows = df.select(integer_id(df, conv_col).alias("conv"), integer_id(df, turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = bodies(rows.where("conv is not null and turn is not null"))
    nodes = placed.select("conv", "turn").distinct()
    quoting = rows.where(F.col("conv").isNotNull() & F.col("turn").isNotNull() & F.col("text").rlike("(?m)" + MARKS)).withColumn("msg", F.md5(F.concat_ws("\x1f", F.coalesce("role", F.lit("")), "text"))).distinct()
    quotes = cut(_quotes(parsed_lines(quoting)))
    originals = _originals(placed).join(quotes.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    units = quotes.select("conv", "turn", "hash", "level", "weight", F.lit(None).cast("long").alias("body_turn")).union(originals.select("conv", "turn", "hash", F.lit(None).cast("long"), F.lit(None).cast("long"), F.col("turn")))
    found = _latest_before(units, ["conv", "hash"], "body_turn", "linked").where("level is not null and linked is not null")
    score = found.groupBy("conv", "turn", "level", "linked").agg(F.sum("weight").alias("weight"))
    best = score.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "weight", "linked")).alias("b")).select("conv", "turn", F.col("b.linked").alias("quoted"))
    linear = _latest_before(nodes.withColumn("own", F.col("turn")), ["conv"], "own", "previous").drop("own")
    parents = linear.join(best, ["conv", "turn"], "left").select("conv", "turn", F.coalesce("quoted", "previous").alias("parent"), F.when(F.col("quoted").isNotNull(), "quote").when(F.col("previous").isNotNull(), "previous").otherwise("root").alias("kind"))
    parents = cut(parents)
    # distance to the root by pointer doubling
    # only turns that haven't reached their root are joined again
    jumps = parents.select("conv", "turn", F.col("parent").alias("to"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    settled, moving = jumps.where("to is null"), jumps.where("to is not null")
    while moving.limit(1).count():
        ahead = settled.union(moving).select("conv", F.col("turn").alias("to"), F.col("to").alias("to2"), F.col("depth").alias("depth2"))
        moved = cut(moving.join(ahead, ["conv", "to"]).select("conv", "turn", F.col("to2").alias("to"), (F.col("depth") + F.col("depth2")).alias("depth")))
        settled, moving = settled.union(moved.where("to is null")), moved.where("to is not null")
    jumps = settled
    full = placed.join(parents, ["conv", "turn"]).join(jumps.select("conv", "turn", "depth"), ["conv", "turn"])
    # the place in three steps: ranges of depths, depths and blocks of turns within a range, and
    # rows within a block, so that neither a long chain nor a wide one is ordered in one task
    block = full.withColumns({"range": F.floor(F.col("depth") / TURNS).cast("long"), "block": F.floor(F.col("turn") / TURNS).cast("long")})
    counts = block.groupBy("conv", "range", "depth", "block").agg(F.count("*").alias("n"))
    ranges = counts.groupBy("conv", "range").agg(F.sum("n").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("conv", "range").orderBy("depth", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("inside", inside).join(ranges.select("conv", "range", earlier.alias("earlier")), ["conv", "range"])
    counts = counts.select("conv", "depth", "block", (F.col("earlier") + F.col("inside")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("conv", "depth", "block").orderBy("turn", "role", "body"))
    ordered = block.withColumn("rank", rank).join(counts, ["conv", "depth", "block"]).withColumn("position", (F.col("offset") + F.col("rank")).cast("long"))
    alone = bodies(rows.where("conv is null or turn is null")).select("conv", "turn", "role", F.lit(None).cast("long").alias("parent"), F.lit("root").alias("kind"), F.lit(0).cast("long").alias("depth"), F.lit(1).cast("long").alias("position"), "quoted_lines", "max_level", "body")
    out = ordered.select("conv", "turn", "role", "parent", "kind", "depth", "position", "quoted_lines", "max_level", "body").union(alone)
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("parent").alias("parent_turn"), F.col("kind").alias("parent_kind"), "depth", "position", "quoted_lines", "max_level", "body")


def formatted(ordered: DataFrame, *, conv_col: str = "conv_id", part: int = 256, template: str = "<|%s|>\n%s\n") -> DataFrame:
    """(conv_id, part, text): conversations as chat text, cut into parts of a bounded number of messages.

    ordered: what reply_order() gives. A null role is an empty one; messages without a
    conversation make a part of their own, in the order of their body.
    """
    rows = ordered.withColumn("part", F.floor((F.col("position") - 1) / part).cast("long"))
    line = F.format_string(template, F.coalesce("role", F.lit("")), F.col("body"))
    sorted_lines = F.transform(F.array_sort(F.collect_list(F.struct("position", "body", line.alias("line")))), lambda s: s["line"])
    return rows.groupBy(conv_col, "part").agg(F.array_join(sorted_lines, "").alias("text"))


_ORACLE = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM TURNS
), ln AS (
  SELECT conv_id, turn, role, text, l.i AS pos, string_split(text, chr(10))[l.i] AS raw
  FROM (SELECT DISTINCT * FROM m) m, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i) l
), lv AS (
  SELECT *, length(regexp_replace(regexp_extract(raw, '^(?:[ \t]{0,3}>)+[ \t]?'), '[^>]', '', 'g')) AS level,
    substr(raw, length(regexp_extract(raw, '^(?:[ \t]{0,3}>)+[ \t]?')) + 1) AS line FROM ln
), b AS (
  SELECT conv_id, turn, role, text,
    regexp_replace(regexp_replace(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE level = 0), ''), '^\s+', ''), '\s+$', '') AS body,
    CAST(count(*) FILTER (WHERE level > 0) AS BIGINT) AS quoted_lines, CAST(max(level) AS BIGINT) AS max_level
  FROM lv GROUP BY conv_id, turn, role, text
), runs AS (
  SELECT *, pos - row_number() OVER (PARTITION BY conv_id, turn, role, text, level ORDER BY pos) AS run FROM lv WHERE level > 0
), qt AS (
  SELECT conv_id, turn, level, line FROM runs UNION ALL SELECT conv_id, turn, level, unnest(list_concat([line], regexp_split_to_array(line, '\n[ \t]*\n')))
  FROM (SELECT conv_id, turn, level, string_agg(line, chr(10) ORDER BY pos) AS line FROM runs GROUP BY conv_id, turn, role, text, level, run) w
), q AS (
  SELECT DISTINCT conv_id, turn, level, t AS hash, length(t) AS weight
  FROM (SELECT *, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS t FROM qt) WHERE t <> ''
), o AS (
  SELECT DISTINCT conv_id, turn, t AS hash FROM (
    SELECT conv_id, turn, trim(regexp_replace(lower(p), '[^\p{L}\p{N}]+', ' ', 'g')) AS t FROM (
      SELECT conv_id, turn, unnest(list_concat([body], list_concat(regexp_split_to_array(body, '\n[ \t]*\n'), string_split(body, chr(10))))) AS p FROM b)) WHERE t <> ''
), f AS (
  SELECT q.conv_id, q.turn, q.level, q.hash, q.weight, max(o.turn) AS linked FROM q JOIN o ON q.conv_id = o.conv_id AND q.hash = o.hash AND o.turn < q.turn GROUP BY ALL
), best AS (
  SELECT conv_id, turn, linked FROM (
    SELECT conv_id, turn, level, linked, row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, sum(weight) DESC, linked DESC) AS r
    FROM f GROUP BY conv_id, turn, level, linked) WHERE r = 1
), n AS (
  SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM (SELECT DISTINCT conv_id, turn FROM m)
), p AS (
  SELECT n.conv_id, n.turn, coalesce(linked, previous) AS parent_turn,
    CASE WHEN linked IS NOT NULL THEN 'quote' WHEN previous IS NOT NULL THEN 'previous' ELSE 'root' END AS parent_kind
  FROM n LEFT JOIN best USING (conv_id, turn)
), d AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM p WHERE parent_turn IS NULL
  UNION ALL SELECT p.conv_id, p.turn, d.depth + 1 FROM p JOIN d ON p.conv_id = d.conv_id AND p.parent_turn = d.turn
)
SELECT m.conv_id, m.turn, m.role, p.parent_turn, p.parent_kind, d.depth,
  CAST(row_number() OVER (PARTITION BY m.conv_id ORDER BY d.depth, m.turn, m.role, b.body) AS BIGINT) AS position, b.quoted_lines, b.max_level, b.body
FROM m JOIN b ON b.conv_id = m.conv_id AND b.turn = m.turn AND b.role IS NOT DISTINCT FROM m.role AND b.text = m.text
JOIN p ON p.conv_id = m.conv_id AND p.turn = m.turn JOIN d ON d.conv_id = m.conv_id AND d.turn = m.turn
"""

ORACLE = _ORACLE.replace("TURNS", "conversations")
#: Conversations in which turns quote earlier ones: every second turn all of the turn before it, every fifth a line of the one before that, deeper.
QUOTING = """
SELECT conv_id, turn, role, CASE WHEN turn % 2 = 1 AND near IS NOT NULL THEN concat('> ', replace(near, chr(10), concat(chr(10), '> ')), chr(10), chr(10), coalesce(text, ''))
  WHEN turn % 5 = 0 AND far IS NOT NULL THEN concat('Before:', chr(10), '>> ', split_part(far, chr(10), 1), chr(10), '> ok', chr(10), coalesce(text, '')) ELSE text END AS text
FROM (SELECT conv_id, turn, role, text, lag(text, 1) OVER (PARTITION BY conv_id ORDER BY turn) AS near, lag(text, 2) OVER (PARTITION BY conv_id ORDER BY turn) AS far FROM {conversations}) AS t
"""
ORACLE_QUOTING = _ORACLE.replace("TURNS", "(" + QUOTING.replace("{conversations}", "conversations") + ") AS quoting")
