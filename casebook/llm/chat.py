"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered ``<|ROLE|>TEXT<|end|>``. It is parsed back by the grammar's one rule and compared with its source; where they
differ, or where a text holds another template's control string, the turn is rendered again as ``<|~ROLE|>TEXT<|end|>`` with
``~`` and every opening character of a control string escaped, which no text can then imitate. Turns that
parse back to themselves follow one another without meeting, so the parser's split of a whole conversation is the turns.

Defined cases: null texts and null roles are empty; turns are ordered by turn number (nulls first), then role and text,
and repeated rows stay; a conversation id of null is a conversation of its own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Strings by which templates mark turns.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: The escape character first, then what opens or closes a control string.
ESCAPES = (("~", "~0"), ("<", "~1"), (">", "~2"), ("[", "~3"), ("|", "~4"))
END = "<|end|>"


def escape(c: Column) -> Column:
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def parse_turn(c: Column) -> tuple[Column, Column, Column]:
    """``(escaped, role, body)`` of one rendered turn without its end mark: the role ends at the first ``|>``."""
    close = F.instr(c, "|>")
    escaped = F.startswith(c, F.lit("<|~"))
    role = F.substring(c, F.when(escaped, 4).otherwise(3), close - F.when(escaped, 4).otherwise(3))
    return escaped, role, F.substring(c, close + F.lit(2), F.length(c))


def render(turns: DataFrame) -> DataFrame:
    """Adds ``rendered``, ``head`` (characters before the text) and ``escaped`` to ``turns(conv_id, turn, role, text)``."""
    role, text = F.col("role"), F.col("text")
    raw = F.concat(F.lit("<|"), role, F.lit("|>"), text)
    was_escaped, parsed_role, parsed_text = parse_turn(raw)
    # END may only close the turn, also where text and end mark run together
    alone = F.instr(F.concat(raw, F.lit(END)), END) == F.length(raw) + 1
    same = alone & ~was_escaped & (parsed_role == role) & (parsed_text == text)
    foreign = F.lit(False)
    for mark in CONTROL:
        foreign = foreign | F.contains(F.concat_ws("\n", role, text), F.lit(mark))
    bad = ~same | foreign
    out = turns.withColumn("escaped", bad)
    role, text = F.when(F.col("escaped"), escape(role)).otherwise(role), F.when(F.col("escaped"), escape(text)).otherwise(text)
    head = F.concat(F.when(F.col("escaped"), "<|~").otherwise("<|"), role, F.lit("|>"))
    return out.withColumn("head", F.length(head)).withColumn("body", F.length(text)).withColumn("rendered", F.concat(head, text, F.lit(END)))


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_spans array<struct<start, length, escaped>>)``: spans are 0-based characters of ``formatted``."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = render(turns).select("conv_id", F.struct("turn", "role", "text", "rendered", "head", "body", "escaped").alias("t"))
    one = made.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    spans = F.aggregate(
        "t",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,escaped:boolean>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["rendered"])).alias("at"),
            F.when(t["role"] == loss_role, F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length"), t["escaped"].alias("escaped"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return one.select("conv_id", F.array_join(F.transform("t", lambda t: t["rendered"]), "").alias("formatted"), spans.alias("loss_spans"))


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """``(conv_id, turns array<struct<role, text>>, loss_text, formatted)`` read back from ``formatted`` and ``loss_spans`` alone."""

    def turn(piece: Column) -> Column:
        escaped, role, body = parse_turn(piece)
        return F.struct(F.when(escaped, unescape(role)).otherwise(role).alias("role"), F.when(escaped, unescape(body)).otherwise(body).alias("text"))

    pieces = F.split(F.col("formatted"), r"<\|end\|>", -1)
    turns = F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)

    def loss(s: Column) -> Column:
        body = F.substring(F.col("formatted"), s["start"] + 1, s["length"])
        return F.when(s["escaped"], unescape(body)).otherwise(body)

    return formatted.select("conv_id", turns.alias("turns"), F.array_join(F.transform("loss_spans", loss), "").alias("loss_text"), "formatted")


def op6_chat(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for k, r in enumerate(("user", "assistant"))])))
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(table)


def digests(table: DataFrame) -> DataFrame:
    """Counts and digests of the turns and of the text under the loss mask, read back from the formatted conversations."""
    back = parse_conversations(format_conversations(table))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


_HIT = " OR ".join(f"contains(role || chr(10) || text, '{m}')" for m in (*CONTROL, END))
_CODED = "{0}"
for _plain, _code in ESCAPES:
    _CODED = f"replace({_CODED}, '{_plain}', '{_code}')"
#: The same rows without the round trip: what a turn's rendering must measure, and the sources' digests.
OP6_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, CASE WHEN {_HIT} OR starts_with(role, '~') OR starts_with(role, '>') OR role = 'end'
    THEN length({_CODED.format('role')}) + length({_CODED.format('text')}) + 12 ELSE length(role) + length(text) + 11 END AS n
  FROM t
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
