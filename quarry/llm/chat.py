"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation (control strings in quotes)::

    conversation := turn*
    turn         := '[INST]' role '[/INST]' text '</s>'

Control strings are ``[INST]``, ``[/INST]``, ``<s>`` and ``</s>``.  Content
that holds one is escaped by a backslash after its first character
(``[\\INST]``); content that already holds such an escaped form gets one more
backslash, and reading takes one away, so escaping is reversible for every
text.  Content is only escaped where the round trip asks for it: a turn is
rendered as it is, reparsed, compared with its source, and escaped if what
was recovered differs.

Because no control string can start inside another one, a control string that
is found in rendered text lies wholly inside one content or is a mark of the
grammar; escaped content holds none, so the second reading is always equal to
the source.  ``round_trip`` in the result says so for every row from a parse
of the final text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
# Fixed value: a control string with any number of backslashes after its first character.
_CONTROL = r"([\[<])(\\*)(/?INST\]|/?s>)"
_ESCAPED = r"([\[<])\\(\\*)(/?INST\]|/?s>)"


def escape(text: Column) -> Column:
    """Add a backslash to every control string, escaped or not."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """Take one backslash from every escaped control string."""
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def _split(text: Column, mark: str) -> Column:
    return F.split(text, r"\Q" + mark + r"\E", -1)


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Deterministic parser: an array of ``struct<ok, role, text>`` by turn.
    ``ok`` is false for a piece that is not a turn of the grammar."""
    pieces = _split(formatted, END)
    turns = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        halves = _split(piece, CLOSE)
        ok = piece.startswith(F.lit(OPEN)) & (F.size(halves) == 2)
        return F.struct(
            ok.alias("ok"),
            unescape(F.substr(halves[0], F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.when(ok, halves[1]).otherwise(F.lit(""))).alias("text"),
        )

    return F.transform(turns, one)


def _conflicts(role: Column, text: Column, rendered: Column) -> Column:
    """True where a turn, rendered as given, is not read back as it was."""
    back = parse(rendered)
    return ~((F.size(back) == 1) & back[0]["ok"] & (back[0]["role"] == role) & (back[0]["text"] == text))


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv, n_turns, formatted, loss_spans,
    round_trip``.

    ``loss_spans`` are ``struct<start, end>`` (code points in ``formatted``,
    end exclusive) of the assistant texts as rendered.  Turns are taken by
    ``turn``, ties by role and text; repeated rows are turns of their own.
    A null role or text is empty, a null turn number comes first, and rows
    with a null conversation id form one conversation.  Other columns are
    ignored.  A conversation is one row, so its turns meet in one task."""
    src = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # a text without any control string reads back as it is; only others are parsed one by one
    suspect = F.col("role").rlike(_CONTROL) | F.col("text").rlike(_CONTROL)
    plain = _turn(F.col("role"), F.col("text"))
    src = src.withColumn("escaped", suspect & _conflicts(F.col("role"), F.col("text"), plain))
    src = src.withColumn("role_out", F.when(F.col("escaped"), escape(F.col("role"))).otherwise(F.col("role")))
    src = src.withColumn("text_out", F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text")))
    grouped = src.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "role_out", "text_out"))).alias("turns")
    )
    rendered = grouped.withColumn("formatted", F.array_join(F.transform("turns", lambda t: _turn(t["role_out"], t["text_out"])), ""))
    marks = len(OPEN) + len(CLOSE)
    steps = F.aggregate(
        F.col("turns"),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: _advance(acc, t, marks),
    )
    back = rendered.withColumn("parsed", parse(F.col("formatted")))
    same = F.transform("turns", lambda t: F.struct(F.lit(True).alias("ok"), t["role"], t["text"])) == F.col("parsed")
    return back.select(
        F.col("conv").alias(conv),
        F.size("turns").cast("long").alias("n_turns"),
        "formatted",
        steps["spans"].alias("loss_spans"),
        same.alias("round_trip"),
    )


def _advance(acc: Column, t: Column, marks: int) -> Column:
    start = acc["at"] + F.lit(marks) + F.length(t["role_out"])
    end = start + F.length(t["text_out"])
    span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
    spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
    return F.struct((end + F.lit(len(END))).cast("long").alias("at"), spans.alias("spans"))


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted text and its loss spans say: turns from
    the parser, texts under the loss mask from the spans."""
    masked = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ),
        "",
    )
    rows = formatted.withColumn("parsed", parse(F.col("formatted"))).withColumn("masked", masked)
    told = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        conv,
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.explode(
            F.array(
                F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit(hard).alias("text")),
                F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit(hard).alias("text")),
            )
        ).alias("t")
    ).select("t.*")
    return read_back(format_conversations(turns.unionByName(extra)))


OP2_SQL = r"""
WITH src AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 17 + length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?s>)', '\1\\\2\3', 'g'))
       + length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>)', '\1\\\2\3', 'g')) AS chars
  FROM src
)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
