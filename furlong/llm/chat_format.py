"""Chat formatting into budgeted windows, with DataFrame functions alone.

A turn is written as `<s>role⏎text</s>⏎`. Backslashes, and control strings inside roles and texts, get a backslash, so
every text comes back exactly. Tokens of a turn are its words and other visible signs. Prefix sums of them choose
the windows: a turn belongs to the window of the half-budget cell in which it starts, so windows are made of whole
turns. The opening system turn stands in front of every window, and up to an eighth of the budget of the turns before a
window is repeated ahead of it. Loss spans cover the texts of assistant turns where they are new, never
where they are repeated. A window is over budget only where single turns are longer than three eighths of it.

Null texts and roles are empty. Turns are ordered by number (null first), then role, then text; repeated rows are
turns of their own. A row without a conversation id is a conversation of its own with id null. An empty table
gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
# The marks of the template, and what is escaped inside texts.
OPEN, CLOSE = "<s>", "</s>\n"
CONTROL = r"(<(?=/?s>|</?SYS>)|\[(?=/?INST\]))"
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0b\f\r]"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(turns: DataFrame, budget: int = BUDGET, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per window: key (the conversation), conv_id, window, formatted, n_repeated (turns ahead that other windows
    hold as new), loss_spans array<struct<start,end>> (code points of formatted), n_tokens."""
    cell, history = max(1, budget // 2), budget // 8
    said = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string"))).alias("key"),
    )
    by_conv = Window.partitionBy("key").orderBy("turn", "role", "text", "block")
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    sized = (
        said.withColumn("head", head).withColumn("block", F.concat("head", escape(F.col("text")), F.lit(CLOSE)))
        .withColumn("nth", F.row_number().over(by_conv)).withColumn("system", (F.col("nth") == 1) & (F.col("role") == "system"))
        .withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long") + 3)
        .withColumn("counted", F.when(F.col("system"), 0).otherwise(F.col("tokens")))
        .withColumn("before", F.sum("counted").over(Window.partitionBy("key").orderBy("nth")) - F.col("counted"))
        .withColumn("cell", F.floor(F.col("before") / cell))
        .withColumn("window", F.dense_rank().over(Window.partitionBy("key").orderBy("cell")) - 1)
    )
    by_window = Window.partitionBy("key").orderBy("window")
    spread = sized.withColumn("last", F.max("window").over(Window.partitionBy("key"))).withColumn("next_from", F.min("before").over(by_window.rangeBetween(1, 1)))
    places = F.when(F.col("system"), F.sequence(F.lit(0), F.col("last"))).when(F.col("before") >= F.col("next_from") - history, F.array("window", F.col("window") + 1)).otherwise(F.array("window"))
    placed = spread.select("key", "conv_id", "nth", "role", "head", "block", "tokens", F.col("window").alias("own"), F.explode(places).alias("window"))
    place = Window.partitionBy("key", "window").orderBy("nth")
    repeated = F.col("window") > F.col("own")
    begin = F.col("until") - F.char_length("block")
    span = F.when((F.col("role") == "assistant") & ~repeated, F.struct((begin + F.char_length("head")).cast("long").alias("start"), (F.col("until") - len(CLOSE)).cast("long").alias("end")))
    laid = placed.withColumn("until", F.sum(F.char_length("block")).over(place)).select("key", "conv_id", "window", "nth", "block", "tokens", repeated.alias("repeated"), span.alias("span"))
    grouped = laid.groupBy("key", "window").agg(
        F.any_value("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("nth", "block", "span"))).alias("turns"), F.sum(F.col("repeated").cast("int")).alias("n_repeated"), F.sum("tokens").alias("n_tokens")
    )
    return grouped.select(
        "key", "conv_id", "window", F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"), "n_repeated",
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"), "n_tokens",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window: the new turns as role⏎text⏎, unescaped, and the text under the loss mask, both parsed from the formatted string."""
    blocks = F.regexp_extract_all("formatted", F.lit(f"(?s){OPEN}(.*?){CLOSE}"), F.lit(1))
    new = F.slice(blocks, F.col("n_repeated") + 1, F.greatest(F.size(blocks) - F.col("n_repeated"), F.lit(0)))
    parsed = F.transform(new, lambda b: F.concat(unescape(F.regexp_extract(b, HEADER, 1)), F.lit("\n"), unescape(F.regexp_extract(b, HEADER, 2)), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("key", "conv_id", "window", F.size(new).alias("n_turns"), F.array_join(parsed, "").alias("said"), F.array_join(loss, "").alias("loss"), F.char_length("formatted").alias("n_chars"))


HEADER = r"(?s)\A((?:[^\\\n]|\\.)*+)\n(.*)\z"


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: what its windows say, as counts and digests."""
    parts = read_back(formatted)
    whole = parts.groupBy("key").agg(F.any_value("conv_id").alias("conv_id"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"), F.sum("n_turns").cast("long").alias("n_turns"), F.sum("n_chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    said = F.array_join(F.transform("w", lambda w: w["said"]), "")
    return whole.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"

SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
    len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0b\f\r]')) + 3 AS tokens,
    3 + length(replace(replace(role, '\', '\\'), chr(10), '\' || chr(10))) + 1 + length(replace(text, '\', '\\'))
      + len(regexp_extract_all(text, '</?s>|<</?SYS>|\[/?INST\]')) + len(regexp_extract_all(role, '</?s>|<</?SYS>|\[/?INST\]')) + 5 AS chars
  FROM given
), summed AS (
  SELECT *, nth = 1 AND role = 'system' AS system,
    sum(CASE WHEN nth = 1 AND role = 'system' THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY nth)
      - CASE WHEN nth = 1 AND role = 'system' THEN 0 ELSE tokens END AS before
  FROM sized
), cells AS (
  SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY before // 512) - 1 AS win FROM summed
), starts AS (
  SELECT conv_id, win, min(before) AS start FROM cells GROUP BY ALL
), spread AS (
  SELECT c.*, n.start AS next_from, max(c.win) OVER (PARTITION BY c.conv_id) AS last FROM cells c LEFT JOIN starts n ON n.conv_id = c.conv_id AND n.win = c.win + 1
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars * CASE WHEN system THEN last + 1 WHEN before >= next_from - 128 THEN 2 ELSE 1 END)::BIGINT AS formatted_chars
FROM spread GROUP BY conv_id
"""
