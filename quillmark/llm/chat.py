"""Chat formatting with typed content parts, in DataFrame operations only.

A message is a row (conversation, turn, role, parts). ``parts`` is an array of (kind, text, ref, tokens): text parts carry
text, the others (image, audio, document) an attachment reference and the number of tokens that they expand to. The
visitor goes through the parts in order. Text is escaped; every other part becomes the placeholder ``<part:kind:n>``, n
counting a conversation's attachments, and adds (n, kind, ref, tokens) to ``attachments`` and its tokens to
``expanded_tokens``. Turns are marked ``<turn:role>`` ... ``</turn>``.

Control strings all start with ``<``. Texts and roles are escaped by ``\\`` -> ``\\b``, ``<`` -> ``\\l`` and ``>`` -> ``\\g``, so
none can stand in a text, and unescaping in the reverse order gives the text back whatever it holds.

``loss_spans`` marks, in code points of the formatted string, the content of assistant turns. Offsets come from a running
sum over the conversation's turns and so need no shuffle beyond the one that groups a conversation.

Defined results: null text or role is empty, a part of an unknown kind is an attachment, null tokens count zero. Rows that
share a turn number are ordered by role and text, and repeated rows are turns of their own. A null conv_id is one
conversation. A conversation with no rows doesn't exist; an empty table gives no rows. Other columns aren't used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
TURN_END = "</turn>\n"
PART = "struct<kind:string,text:string,ref:string,tokens:bigint>"


def escape(text: Column) -> Column:
    for plain, safe in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(_ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A message of plain text as parts."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).cast("bigint").alias("tokens")))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("")) == "text"


def format_chats(messages: DataFrame, *, train_on: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens; input conv_id, turn, role and parts or text."""
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in messages.columns else text_parts(F.col("text"))
    rows = messages.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(parts, F.expr(f"cast(array() as array<{PART}>)")).alias("parts"))
    # The visitor's state at a message is the number of attachments before it: a running sum over the conversation.
    rows = rows.withColumn("n_files", F.size(F.filter("parts", lambda p: ~_is_text(p))))
    rows = rows.withColumn("key", F.to_json(F.struct("parts")))
    turns = W.partitionBy("conv_id").orderBy("turn", "role", "key")
    before = turns.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.row_number().over(turns)).withColumn("files_before", F.coalesce(F.sum("n_files").over(before), F.lit(0)))
    marked = F.transform(
        "parts",
        lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<part:"), escape(F.coalesce(p["kind"], F.lit(""))), F.lit(":"), (F.col("files_before") + F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i), lambda q: ~_is_text(q)))).cast("string"), F.lit(">"))
        ),
    )
    files = F.filter(
        F.transform("parts", lambda p, i: F.when(~_is_text(p), F.struct((F.col("files_before") + F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i), lambda q: ~_is_text(q)))).cast("bigint").alias("n"), p["kind"].alias("kind"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0).cast("bigint")).alias("tokens")))),
        lambda x: x.isNotNull(),
    )
    rows = rows.select("conv_id", "at", "role", F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">\n")).alias("open"), F.array_join(marked, "").alias("content"), files.alias("files"))
    length = F.char_length("open") + F.char_length("content") + len(TURN_END)
    start = F.coalesce(F.sum(length).over(W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.char_length("open")
    rows = rows.withColumn("start", start.cast("bigint"))
    turn = F.struct("at", F.concat("open", "content", F.lit(TURN_END)).alias("s"), "role", "start", (F.col("start") + F.char_length("content")).cast("bigint").alias("end"), "files")
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    attachments = F.flatten(F.col("t.files"))
    return chats.select(
        "conv_id",
        F.size("t").cast("bigint").alias("n_turns"),
        F.array_join("t.s", "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["role"] == train_on), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted string, as an array of (role, content); content still has its placeholders, texts are plain.

    Splitting by the end mark is safe: no text can hold it.
    """
    turns = F.filter(F.split(formatted, "</turn>\n", -1), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(7)), ">\n", 1)).alias("role"),
            unescape(F.substr(x, F.char_length(F.substring_index(x, ">\n", 1)) + 3)).alias("content"),
        ),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """The plain text under the loss mask, cut from the formatted string, with nothing between spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
