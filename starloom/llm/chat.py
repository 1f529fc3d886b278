"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts: text, image, audio or document. One visitor expression
per kind flattens them, in order, into a string: text is escaped, anything else becomes a
placeholder that names its kind, turn and place, and its reference and expanded token count
are recorded. A turn is ``### role:\\n<content></turn>\\n``.

Escaping is reversible and keeps every control character out of the content: a backslash
becomes ``\\b``, ``<`` becomes ``\\l`` and ``#`` becomes ``\\h`` (in a role also a line feed
``\\n``), so neither a turn mark nor a
placeholder can be forged by a text or a role.

The loss mask is an array of (turn, begin, length) in code points, begin counted from the
start of that turn in the formatted string: one span for each assistant turn with content.

Defined results for odd input: a null text, role or part is empty; a null turn comes first;
equal turns are ordered by role, then content; repeated rows are repeated turns; an unknown kind
of part is an attachment of that kind with no tokens; a null conversation id is a conversation, as
GROUP BY has it (nothing else says which of its turns belong together);
an empty table gives an empty result; extra columns are not read.

A conversation is one row, so it has to fit in the memory of one task; the README has figures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,millis:bigint,pages:bigint>"
END = "</turn>\n"


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for: image patches, audio frames, document pages."""

    patch: int = 14
    frame_millis: int = 40
    page_tokens: int = 256


def escape(c: Column) -> Column:
    for raw, mark in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        c = F.replace(c, F.lit(raw), F.lit(mark))
    return c


def unescape(c: Column) -> Column:
    for raw, mark in (("#", "\\h"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(mark), F.lit(raw))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """An array with the one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            *[F.lit(None).cast("long").alias(c) for c in ("width", "height", "millis", "pages")])).cast(f"array<{PART}>")


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _tokens(part: Column, x: Expansion) -> Column:
    def up(n: Column, by: int) -> Column:
        return F.ceil(F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)) / by).cast("long")

    return (F.when(part["kind"] == "image", up(part["width"], x.patch) * up(part["height"], x.patch))
            .when(part["kind"] == "audio", up(part["millis"], x.frame_millis))
            .when(part["kind"] == "document", up(part["pages"], 1) * x.page_tokens)
            .otherwise(F.lit(0)).cast("long"))


def visit(turn: Column, part: Column, place: Column) -> Column:
    """What a part becomes in the formatted string."""
    mark = F.concat(F.lit("<"), escape(part["kind"]), F.lit(" "), turn.cast("string"), F.lit("."), place.cast("string"), F.lit(">"))
    return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)


def format_chats(turns: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """Rows (conv_id, turn, role, parts) to one row per conversation.

    Returns conv_id, formatted, mask array<struct<turn, begin, length>> and attachments
    array<struct<turn, place, kind, ref, tokens>>. One shuffle, on conv_id.
    """
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()).alias("parts"))
    chats = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    seen = chats.withColumn("rows", F.transform("rows", lambda r, i: F.struct(
        r["role"].alias("role"), F.concat(F.lit("### "), escape_role(r["role"]), F.lit(":\n")).alias("head"),
        F.array_join(F.transform(r["parts"], lambda p, j: visit(i, p, j)), "").alias("body"),
        F.filter(F.transform(r["parts"], lambda p, j: F.struct(i.cast("long").alias("turn"), j.cast("long").alias("place"), p["kind"].alias("kind"),
                                                               p["ref"].alias("ref"), _tokens(p, expansion).alias("tokens"))),
                 lambda a: F.coalesce(a["kind"], F.lit("text")) != "text").alias("attached"))))
    spans = F.transform("rows", lambda r, i: F.struct((r["role"] == "assistant").alias("on"), i.cast("long").alias("turn"),
                                                      F.length(r["head"]).cast("long").alias("begin"), F.length(r["body"]).cast("long").alias("length")))
    return seen.select(
        "conv_id", F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["on"] & (s["length"] > 0)), lambda s: F.struct(s["turn"], s["begin"], s["length"])).alias("mask"),
        F.flatten(F.transform("rows", lambda r: r["attached"])).alias("attachments"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds turns array<struct<role, text>> and learned (the text under the mask), both read from ``formatted``."""
    parsed = chats.withColumn("_segments", F.filter(F.split("formatted", END), lambda s: s != ""))
    turn = F.transform("_segments", lambda s: F.struct(
        unescape_role(F.substring_index(F.substr(s, F.lit(5)), ":\n", 1)).alias("role"),
        unescape(F.substr(s, F.length(F.substring_index(s, ":\n", 1)) + 3)).alias("text")))
    learned = F.array_join(F.transform("mask", lambda m: unescape(
        F.substr(F.get("_segments", m["turn"].cast("int")), (m["begin"] + 1).cast("int"), m["length"].cast("int")))), "")
    return parsed.select(*chats.columns, turn.alias("turns"), learned.alias("learned"))


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted strings."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
