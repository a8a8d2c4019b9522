r"""Operator 8 -- chat formatting with a grammar round trip.

Template (one turn after the other, nothing in between)::

    assistant turn   <s>TEXT</s>
    any other turn   [INST]ROLE\nTEXT[/INST]

``parse`` is a deterministic reader of that grammar: from the left, each turn
ends at the first end mark of its kind.  ``format_conversations`` renders every
text raw, reparses it and compares the recovered turns with the source; where
they differ, the turns at fault are escaped and the conversation rendered
again, until the reading is identical (escaping always makes it so).

Escaping puts one backslash more between the bracket and the rest of a control
string, ``[\INST]``; reading takes one away.  So it is reversible for any text,
texts that already hold such backslashes included.

Everything is DataFrame expressions: no user function, one shuffle by
conversation.  The loss mask is run-length coded: ``segments`` concatenate to
the formatted text, those with ``loss`` are assistant texts.

Defined cases: null texts and roles are empty strings; turns are in order of
(turn, role, text), a null turn first, so ties and repeated rows have one
order and are all kept; rows with a null conv_id form one conversation; an
empty table gives no conversation; only the four named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.text import total, whole

ASSISTANT = "assistant"
OPEN, CLOSE = "[INST]", "[/INST]"
LOSS_OPEN, LOSS_CLOSE = "<s>", "</s>"
TURN = r"(?s)\[INST\].*?\[/INST\]|<s>.*?</s>"
#: A bracket, the backslashes after it, and the rest of a control string.
_CONTROL = r"(?:(?<=\[)(\\*)(?=/?INST\])|(?<=<)(\\*)(?=/?s>))"
_ESCAPED = r"(?:(?<=\[)\\(\\*)(?=/?INST\])|(?<=<)\\(\\*)(?=/?s>))"
#: The text whose control strings the query's extra conversation carries.
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def _role_out(role: Column) -> Column:
    """Roles are names, one line each: backslashes and line ends coded."""
    coded = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(coded)


def _role_in(role: Column) -> Column:
    held = F.replace(unescape(role), F.lit("\\\\"), F.lit("\\\x00"))
    return F.replace(F.replace(held, F.lit("\\n"), F.lit("\n")), F.lit("\\\x00"), F.lit("\\"))


def render_turn(role: Column, body: Column) -> Column:
    return F.when(role == ASSISTANT, F.concat(F.lit(LOSS_OPEN), body, F.lit(LOSS_CLOSE))).otherwise(
        F.concat(F.lit(OPEN), _role_out(role), F.lit("\n"), body, F.lit(CLOSE)))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns that the grammar reads."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), _read_turn)


def _read_turn(turn: Column) -> Column:
    inner = F.substring(turn, F.lit(len(OPEN) + 1), F.length(turn) - len(OPEN) - len(CLOSE))
    loss = F.substring(turn, F.lit(len(LOSS_OPEN) + 1),
                       F.length(turn) - len(LOSS_OPEN) - len(LOSS_CLOSE))
    cut = F.locate("\n", inner)
    return F.when(turn.startswith(LOSS_OPEN), F.struct(F.lit(ASSISTANT).alias("role"),
                                                      unescape(loss).alias("text"))).otherwise(
        F.struct(_role_in(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                 unescape(F.substring(inner, cut + 1, F.length(inner))).alias("text")))


def _segments(turn: Column) -> Column:
    """A rendered turn in pieces, with the mask of each."""
    def piece(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    body = F.substring(turn, F.lit(len(LOSS_OPEN) + 1),
                       F.length(turn) - len(LOSS_OPEN) - len(LOSS_CLOSE))
    return F.when(turn.startswith(LOSS_OPEN), F.array(
        piece(F.lit(LOSS_OPEN), False), piece(body, True), piece(F.lit(LOSS_CLOSE), False))).otherwise(
        F.array(piece(turn, False)))


def format_conversations(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: formatted text, mask segments, the turns read
    back, how many turns needed escaping, and whether the round trip holds."""
    rows = conversations.select(F.col(id_col).alias(id_col), F.col("turn").alias("turn"),
                                whole("role").alias("role"), whole("text").alias("text"))
    source = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))),
                         lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    grouped = rows.groupBy(id_col).agg(source.alias("source"))
    # Round 1: raw.  A turn is at fault if the reader does not give it back.
    raw = grouped.select(id_col, "source", F.transform(
        "source", lambda t: render_turn(t["role"], t["text"])).alias("raw"))
    read = raw.select("*", parse(F.array_join("raw", "")).alias("read"))
    checked = read.select(id_col, "source", "raw", F.when(
        F.col("read") == F.col("source"), F.array().cast("array<string>")).otherwise(
        # Round 2: escape the turns that do not survive on their own.
        F.transform("source", lambda t, i: F.when(
            parse(F.get("raw", i)) == F.array(t), F.get("raw", i)).otherwise(
            render_turn(t["role"], escape(t["text"]))))).alias("escaped"))
    turns = checked.select(id_col, "source", "raw", F.when(
        F.size("escaped") > 0, F.col("escaped")).otherwise(F.col("raw")).alias("rendered"))
    out = turns.select(id_col, "source", F.array_join("rendered", "").alias("formatted"),
                       F.size(F.filter(F.transform("rendered", lambda x, i: x != F.get("raw", i)),
                                       lambda x: x)).alias("n_escaped"))
    parts = out.select("*", F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0)).alias("parts"))
    return parts.select(
        id_col, "formatted", "n_escaped", F.transform("parts", _read_turn).alias("turns"),
        F.flatten(F.transform("parts", _segments)).alias("segments"),
        (F.transform("parts", _read_turn) == F.col("source")).alias("round_trip"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
                                  F.lit(PROBE).alias("text"))
    done = format_conversations(table.unionByName(probe))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    digest = done.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                         F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                         F.array_join(masked, "").alias("loss"), total(F.transform(
                             "segments", lambda s: F.length(s["text"]))).alias("formatted_chars"),
                         "n_escaped", "round_trip")
    return digest.select("conv_id", "n_turns", "turns_sha256",
                         F.length("loss").cast("long").alias("loss_chars"),
                         F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
                         F.col("n_escaped").cast("long").alias("n_escaped"), "round_trip")


# The tables' roles are plain names; a text is at fault if it holds a control
# string or its escaped form.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, (role = 'assistant' AND (contains(text, '</s>') OR regexp_matches(text, '\[\\+/?INST\]|<\\+/?s>')))
    OR (role <> 'assistant' AND (contains(text, '[/INST]') OR regexp_matches(text, '\[\\+/?INST\]|<\\+/?s>'))) AS bad,
    len(regexp_extract_all(text, '\[\\*/?INST\]|<\\*/?s>')) AS controls
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + CASE WHEN bad THEN controls ELSE 0 END
      + CASE WHEN role = 'assistant' THEN 7 ELSE length(role) + 14 END)::BIGINT AS formatted_chars,
  count(*) FILTER (bad)::BIGINT AS n_escaped, true AS round_trip
FROM marked GROUP BY conv_id
"""
