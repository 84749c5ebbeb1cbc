"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: the conversation up to
that turn is its context and only that reply is under the loss mask. If a
conversation does not end with an assistant turn, one more example carries
the whole conversation with an empty mask, so that nothing is lost.

Template: each turn is ``<s>[ROLE]role[/ROLE]text</s>``. A control string
inside a role or text is broken by one more backslash after its first
character (``</s>`` becomes ``<\\/s>``), and a string that already looks
broken gets one more as well, so taking one away gives the text back.

Defined cases: a null text or role is empty; a null turn comes first; rows
with the same turn number are ordered by role and text and each is a turn;
a null conv_id is a conversation of its own; an empty table gives no rows.
A conversation is formatted as one string, so its turns meet in one task;
its texts must fit there together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
# Control strings of the template, and the instruction marks in common use.
_REST = r"/?s>|/?ROLE\]|/?INST\]"
ESCAPE = rf"([<\[])(\\*(?:{_REST}))"
UNESCAPE = rf"([<\[])\\(\\*(?:{_REST}))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2")


def _opening(role: Column) -> Column:
    return F.concat(F.lit("<s>[ROLE]"), role, F.lit("[/ROLE]"))


def expand_examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (position of its last turn),
    is_last, text (formatted), loss_start and loss_chars (the mask, in code
    points of ``text``)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (conversations.select("conv_id", turn.alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    formatted = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), _opening(escape(t["role"])).alias("opening"),
        escape(t["text"]).alias("body")))
    turns = turns.select("conv_id", formatted.alias("turns"))
    last = F.size("turns") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (
        (F.element_at("turns", i + 1)["role"] == ASSISTANT) | (i == last)))
    rows = turns.select("conv_id", "turns", last.alias("last"), F.explode(ends).alias("example"))
    target = F.element_at("turns", F.col("example") + 1)
    trained = target["role"] == ASSISTANT
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("example")), lambda t: F.concat(
        t["opening"], t["body"], F.lit("</s>"))), "")
    head = F.concat(context, target["opening"])
    loss = F.when(trained, F.length(target["body"])).otherwise(0)
    return rows.select(
        "conv_id", "example", (F.col("example") == F.col("last")).alias("is_last"),
        F.concat(head, target["body"], F.lit("</s>")).alias("text"),
        F.length(head).alias("loss_start"), loss.alias("loss_chars"))


def read_back(examples: DataFrame) -> DataFrame:
    """Digests per conversation, recovered from the formatted examples: the
    turns from the example that holds them all, the loss from each mask."""
    loss = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_chars")))
    parts = examples.select("conv_id", "example", F.length("text").cast("long").alias("n"),
                            F.when(F.col("is_last"), F.col("text")).alias("full"), loss.alias("loss"))
    per = parts.groupBy("conv_id").agg(
        F.max("full").alias("full"), F.sum("n").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"))
    # Every turn ends with a control string, so the piece after the last is empty.
    pieces = F.split("full", "</s>")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    turns = F.transform(pieces, lambda p: F.concat(
        unescape(F.regexp_extract(p, r"(?s)\A<s>\[ROLE\](.*?)\[/ROLE\](.*)\z", 1)), F.lit("\n"),
        unescape(F.regexp_extract(p, r"(?s)\A<s>\[ROLE\](.*?)\[/ROLE\](.*)\z", 2)), F.lit("\n")))
    loss_text = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return per.select(
        "conv_id", F.size(pieces).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss_text).cast("long").alias("loss_chars"),
        F.sha2(loss_text.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"

ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(role, '([<\[])(\\*(?:/?s>|/?ROLE\]|/?INST\]))', '\1\\\2', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*(?:/?s>|/?ROLE\]|/?INST\]))', '\1\\\2', 'g')) + 20 AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
r AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR pos = n)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""
