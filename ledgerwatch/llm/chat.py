"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role form a block:

    ### User: first text</turn>second text</turn>
    ### Assistant: reply</turn>

Texts are escaped so that neither `###` nor `</turn>` is left in them: a backslash is doubled, `##` becomes
`#\\#` and `</turn>` becomes `<\\/turn>`; dropping each escaping backslash reverses this. The output is the list of segments whose
concatenation is the formatted text, each with its flag in the loss mask, which covers the texts of the
assistant and nothing else, and the formatted text itself.

Null texts and roles are empty; a null turn sorts first; equal turns sort by role and text; repeated rows are turns
each. Rows with a null conv_id form a conversation of their own. Roles other than the three known ones are kept as they
are, after `=`. A conversation is one value here, as its text and digest are; its rows meet in one task, after each task has
gathered its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END, KNOWN = "</turn>", ("system", "user", "assistant")


def escape(text: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ("##", "#\\#"), (END, "<\\/turn>")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _name(role: Column) -> Column:
    odd = F.concat(F.lit("="), F.replace(escape(role), F.lit(":"), F.lit("\\:")))
    return F.when(role.isin(*KNOWN), F.initcap(role)).otherwise(odd)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, segments (text, loss) and formatted of every conversation of (conv_id, turn, role, text)."""
    text = F.coalesce("text", F.lit(""))
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    sorted_ = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    # Where a block begins, then the turns of each block.
    begins = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.element_at("turns", i + 1)["role"] != F.element_at("turns", F.greatest(i, F.lit(1)))["role"]),
    )
    blocks = sorted_.withColumn("begins", begins).withColumn(
        "blocks",
        F.transform("begins", lambda b, k: F.slice("turns", b + 1, F.coalesce(F.get("begins", k + 1), F.size("turns")) - b)),
    )

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def block(turns_: Column, k: Column) -> Column:
        role = turns_[0]["role"]
        head = F.concat(F.when(k > 0, F.lit("\n")).otherwise(F.lit("")), F.lit("### "), _name(role), F.lit(": "))
        texts = F.flatten(F.transform(turns_, lambda t: F.array(segment(escape(t["text"]), role == "assistant"), segment(F.lit(END), F.lit(False)))))
        return F.concat(F.array(segment(head, F.lit(False))), texts)

    out = blocks.select("conv_id", F.flatten(F.transform("blocks", block)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(chats: DataFrame) -> DataFrame:
    """`turns` (role, text), parsed from `formatted`, and `loss_text`, what the mask covers, of the output of `formatted`."""
    pieces = F.split("formatted", END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = r"(?s)^\n?### ((?:[^\\:]++|\\.)*+): "
    # An escaped text never has ###, so a piece that begins with it begins a block.
    named = F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, head, 1).alias("name"), F.regexp_replace(p, head, "").alias("text")))
    heads = F.filter(F.transform("pieces", lambda p, i: F.when(p["name"] != "", i)), lambda i: i.isNotNull())
    ends = F.transform("heads", lambda h, k: F.struct(F.element_at("pieces", h + 1)["name"].alias("name"), h.alias("from"), F.coalesce(F.get("heads", k + 1), F.size("pieces")).alias("to")))

    def role(name: Column) -> Column:
        return F.when(name.startswith("="), unescape(F.substring(name, 2, 2**31 - 1))).otherwise(F.lower(name))

    parsed = chats.withColumn("pieces", named).withColumn("heads", heads).withColumn("spans", ends)
    turns = F.flatten(
        F.transform(
            "spans",
            lambda s: F.transform(F.slice("pieces", s["from"] + 1, s["to"] - s["from"]), lambda p: F.struct(role(s["name"]).alias("role"), unescape(p["text"]).alias("text"))),
        )
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return parsed.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    back = read_back(formatted(given.unionByName(own)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, row_number() OVER w = 1 AS is_first, row_number() OVER w = 1 OR lag(role) OVER w <> role AS begins,
    replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS escaped,
    CASE WHEN role IN ('system', 'user', 'assistant') THEN role
      ELSE '=' || replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ':', '\:') END AS name
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + 7 + CASE WHEN begins THEN length(name) + 6 ELSE 0 END + CASE WHEN begins AND NOT is_first THEN 1 ELSE 0 END)::BIGINT
    AS formatted_chars
FROM marked GROUP BY conv_id
"""
