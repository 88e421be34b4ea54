"""Chat formatting: typed content parts to one marked text per conversation, with a loss mask.

Only DataFrame functions. A conversation is a formatted text

    <turn ROLE>\\nTEXT</turn>\\n  (once per turn)

in which role and text are escaped, so that the only `<` are those of the marks:
`\\` is written `\\b`, `<` is `\\l`, `>` is `\\g`. Every backslash is thus followed by its
code, and `unescape` gives the original back whatever the text holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "</turn>\n"
#: Order matters: the escape character is escaped first and restored last.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))

PART = "struct<kind:string, text:string, ref:string, width:int, height:int, seconds:double, pages:int>"

#: Tokens that one attachment takes up once a model expands its placeholder.
PATCH, AUDIO_PER_SECOND, PER_PAGE = 14, 25, 256


def escape(text: Column) -> Column:
    for raw, coded in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part; null counts as empty."""
    none = [F.lit(None).cast(t).alias(n) for n, t in
            (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *none))


def _count(part: Column) -> Column:
    """Expanded tokens of an attachment; unknown sizes count as one token."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    size = (F.when(part["kind"] == "image", patches)
            .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_PER_SECOND))
            .when(part["kind"] == "document", part["pages"] * PER_PAGE))
    return F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long")


def _visit(part: Column) -> Column:
    """One part as text: escaped text, or a placeholder `<image>`, `<audio>`, `<document>`.

    A part of another kind is an attachment `<other>`; null parts are empty text."""
    kind = F.coalesce(part["kind"], F.lit("text"))
    name = F.when(kind.isin("image", "audio", "document"), kind).otherwise("other")
    return F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<"), name, F.lit(">")))


def flatten_parts(parts: Column) -> Column:
    """struct(text, attachments, tokens): parts in order as one escaped text, references of
    the attachments with their ordinal, kind and expanded token count, and their sum."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    others = F.filter(parts, lambda p: F.coalesce(p["kind"], F.lit("text")) != "text")
    refs = F.transform(others, lambda p, i: F.struct(
        i.alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), _count(p).alias("tokens")))
    return F.struct(
        F.array_join(F.transform(parts, _visit), "").alias("text"), refs.alias("attachments"),
        F.aggregate(refs, F.lit(0).cast("long"), lambda a, r: a + r["tokens"]).alias("tokens"))


def format_conversations(turns: DataFrame, parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)
                         ) -> DataFrame:
    """`conv_id`, `formatted`, `loss` (array of struct(start, length) in code points),
    `attachments` (with the turn's ordinal), `attachment_tokens`.

    `turns` has conv_id, turn, role and the column `parts`. Turns are ordered by turn
    (null first), then role and text, so ties have one order and repeated rows stay
    repeated. A null role counts as an empty one, a null conv_id is a conversation of its
    own name (SQL grouping); other columns are ignored. A conversation is one text, so
    it is bounded by what one row can hold.
    """
    flat = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        flatten_parts(F.col(parts)).alias("f")).select(
        "conv_id", "turn", "role", F.col("f.text").alias("text"), F.col("f.tokens").alias("tokens"),
        F.col("f.attachments").alias("refs"))
    whole = flat.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "tokens", "refs"))).alias("t"))
    pieces = F.transform("t", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD_END)).alias("head"), t["text"].alias("text"),
        t["role"].isin(*loss_roles).alias("learned"), t["tokens"].alias("tokens"), t["refs"].alias("refs")))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:long,length:long>>").alias("loss"))

    def advance(state, p):
        begin = state["at"] + F.length(p["head"])
        end = begin + F.length(p["text"])
        span = F.struct(begin.alias("start"), (end - begin).alias("length"))
        return F.struct((end + len(CLOSE)).cast("long").alias("at"),
                        F.when(p["learned"], F.concat(state["loss"], F.array(span)))
                        .otherwise(state["loss"]).alias("loss"))

    return whole.select("conv_id", pieces.alias("p")).select(
        "conv_id",
        F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["text"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("p", start, advance)["loss"].alias("loss"),
        F.flatten(F.transform("p", lambda p, i: F.transform(p["refs"], lambda r: F.struct(
            i.alias("turn"), r["ordinal"].alias("ordinal"), r["kind"].alias("kind"), r["ref"].alias("ref"),
            r["tokens"].alias("tokens"))))).alias("attachments"),
        F.aggregate("p", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """array of struct(role, text): the turns of a formatted text, unescaped."""
    pieces = F.split(formatted, OPEN)
    pieces = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, HEAD_END, 1)).alias("role"),
        unescape(F.substring(
            p, F.instr(p, HEAD_END) + len(HEAD_END),
            F.length(p) - F.instr(p, HEAD_END) - len(HEAD_END) - len(CLOSE) + 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
