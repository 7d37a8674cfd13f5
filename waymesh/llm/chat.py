"""Chat formatting by relational operations and Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role
become one block, and blocks are concatenated:

    <|turn:user|>text<|also|>text<|end|><|turn:assistant|>text<|end|>

``<|also|>`` stands between the turns of a block, so turns can be told apart again. In
texts and roles ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|``: no text can hold a
control string, and the escapes are undone without loss. A role's ``|>`` is ``|&gt;``, and as
every role follows ``turn:`` none can form another control string. The loss mask, kept beside
the formatted text as spans of it, covers the texts of the assistant's turns.

Defined cases: a null text is an empty turn, a null role an empty role, null conversation
ids are one conversation, null turn numbers come first. Turns with the same number are
ordered by role and text; repeated rows are repeated turns. Extra columns are ignored. A
conversation is one output value, so its turns meet in one task; distinct conversations
are spread whatever their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import let, sums_before

TURN, END, ALSO = "<|turn:", "<|end|>", "<|also|>"
#: Role whose texts are under the loss mask.
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("|>"), F.lit("|&gt;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("|&gt;"), F.lit("|>")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, blocks, formatted, loss_spans) from rows (conv_id, turn, role, text). ``blocks``
    has role and texts; ``loss_spans`` has start and end, in code points of ``formatted`` and end
    exclusive, of every text under the loss mask."""
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_ = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    opens = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: (i == 1) | (F.get(F.col("t"), i - 1)["role"] != F.get(F.col("t"), i - 2)["role"]))
    runs = sorted_.withColumn("first", opens).withColumn("next", F.concat(F.slice("first", 2, F.size("first")), F.array(F.size("t") + 1)))
    block = F.transform(
        F.arrays_zip("first", "next"),
        lambda r: F.struct(F.get(F.col("t"), r["first"] - 1)["role"].alias("role"), F.transform(F.slice("t", r["first"], r["next"] - r["first"]), lambda x: x["text"]).alias("texts")),
    )
    merged = runs.select("conv_id", block.alias("blocks"))

    def said(b: Column) -> Column:
        """A block's turns: what stands before the text, the text, what stands after it."""
        last = F.size(b["texts"]) - 1
        head = F.concat(F.lit(TURN), escaped_role(b["role"]), F.lit("|>"))
        return F.transform(
            b["texts"],
            lambda x, k: F.struct(
                F.when(k == 0, head).otherwise(F.lit("")).alias("lead"), escaped(x).alias("body"), F.when(k == last, F.lit(END)).otherwise(F.lit(ALSO)).alias("tail"), (b["role"] == LEARNED).alias("learned")
            ),
        )

    parts = merged.withColumn("parts", F.flatten(F.transform("blocks", said)))
    starts = sums_before(F.transform("parts", lambda p: F.length(p["lead"]) + F.length(p["body"]) + F.length(p["tail"])))
    spans = F.zip_with("parts", starts, lambda p, at: F.struct((at + F.length(p["lead"])).alias("start"), (at + F.length(p["lead"]) + F.length(p["body"])).alias("end"), p["learned"].alias("learned")))
    masked = F.transform(F.filter(spans, lambda x: x["learned"]), lambda x: F.struct(x["start"], x["end"]))
    whole = F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["body"], p["tail"])), "")
    return parts.select("conv_id", "blocks", whole.alias("formatted"), masked.alias("loss_spans"))


def parsed(formatted: Column | str) -> Column:
    """Array of (role, texts) blocks read from a formatted conversation."""
    whole = F.col(formatted) if isinstance(formatted, str) else formatted
    pieces = F.split(whole, r"<\|end\|>")

    def block(piece: Column) -> Column:
        stop = F.locate("|>", piece, len(TURN) + 1)
        body = F.substring(piece, stop + 2, F.length(piece))
        role = unescaped_role(F.substring(piece, F.lit(len(TURN) + 1), stop - len(TURN) - 1))
        return F.struct(role.alias("role"), F.transform(F.split(body, r"<\|also\|>"), unescaped).alias("texts"))

    return F.transform(let(pieces, lambda p: F.slice(p, 1, F.size(p) - 1)), block)


def under_mask(formatted: Column, spans: Column) -> Column:
    """The texts that the mask's spans cut from a formatted conversation, unescaped."""
    return F.transform(spans, lambda x: unescaped(F.substring(formatted, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))))


def digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted text and its mask alone."""
    read = formatted.select("conv_id", "formatted", parsed("formatted").alias("blocks"), "loss_spans")
    turn = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda x: F.concat(b["role"], F.lit("\n"), x, F.lit("\n")))))
    learned = F.array_join(under_mask(F.col("formatted"), F.col("loss_spans")), "")
    return read.select("conv_id", turn.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_chat_format(turns: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digest(format_conversations(turns.select("conv_id", "turn", "role", "text").unionByName(extra)))


#: The same in DuckDB SQL, from the turns themselves.
OP8_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER o AS k, coalesce(lag(role) OVER o = role, false) AS again,
        length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) AS text_chars,
        length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), '|>', '|&gt;')) AS role_chars
    FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(text_chars + CASE WHEN again THEN 8 ELSE role_chars + 9 + 7 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""
