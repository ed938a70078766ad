"""Operator 12: chat formatting with typed content parts, native.

A turn is a list of parts: text, image, audio or document. A visitor goes over the parts in order:
text is escaped, every other part becomes a numbered placeholder, and its reference and the number
of tokens that will take its place are recorded. A conversation becomes

    ### user: words of the user \\[image:0]</turn>
    ### assistant: the reply</turn>

In texts and roles a backslash is doubled, ``</turn>`` is written ``<\\/turn>`` and ``###`` as
``#\\##``, so no text can hold a mark of the template, and a backslash before ``[`` that is not
doubled can only be a placeholder. Escaping is undone by dropping one backslash of each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.tables import own_names

#: The type of one content part; fields that a kind does not use are null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
KINDS = ("image", "audio", "document")


@dataclass(frozen=True)
class Costs:
    """Tokens that take a placeholder's place: per image tile, per second, per page, and the least."""

    tile: int = 512
    per_tile: int = 170
    per_image: int = 85
    per_second: float = 25.0
    per_page: int = 1024
    least: int = 1


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part; null is empty."""
    fields = [F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text")]
    empty = [F.lit(None).cast(t).alias(n) for n, t in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(*fields, *empty)).cast(f"array<{PART}>")


def expanded_tokens(part: Column, costs: Costs = Costs()) -> Column:
    """Tokens of an attachment; sizes that are null or negative count as 0."""

    def size(name: str) -> Column:
        return F.greatest(F.coalesce(part[name], F.lit(0)), F.lit(0))

    tiles = F.ceil(size("width") / costs.tile) * F.ceil(size("height") / costs.tile)
    tokens = (
        F.when(part["kind"] == "image", tiles * costs.per_tile + costs.per_image)
        .when(part["kind"] == "audio", F.ceil(size("seconds") * costs.per_second))
        .otherwise(size("pages") * costs.per_page)
    )
    return F.greatest(tokens.cast("long"), F.lit(costs.least).cast("long"))


def _attached(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*KINDS), F.lit(False))


def _marks_broken(doubled: Column) -> Column:
    """Template marks cannot be found in the result; backslashes must be doubled before."""
    return F.regexp_replace(F.regexp_replace(doubled, "<(?=/turn>)", r"<\\"), "#(?=##)", r"#\\")


def _doubled(text: Column) -> Column:
    return F.replace(text, F.lit("\\"), F.lit("\\\\"))


def escaped(text: Column) -> Column:
    return _marks_broken(_doubled(text))


def unescaped(text: Column) -> Column:
    """Undoes ``escaped``; placeholders go."""
    words = F.regexp_replace(text, r"(\\\\)|\\\[(?:" + "|".join(KINDS) + r"):\d+\]", "$1")
    return F.regexp_replace(words, r"(?s)\\(.)", "$1")


def formatted(
    turns: DataFrame, parts: str = "parts", costs: Costs = Costs(), loss_role: str = "assistant"
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens.

    ``turns`` has conv_id, turn, role and a list of ``PART`` in the column ``parts``; other columns count for
    nothing. A part whose kind is null or unknown counts as text; a null part, text or list as empty; a null
    role as the empty one. Rows go by turn (null first), rows of one turn by role, then by their parts; repeated
    rows repeat. Rows without conv_id are one conversation without id. An empty table gives no rows.

    ``loss_spans`` are the texts of ``loss_role`` in the result: start and length in code points and in UTF-8
    bytes, without the marks around them. The places come from running sums over the sorted turns,
    so only the conversation itself, which is one value of at most 2 GB, is put together in a task.
    """
    slim = own_names(turns, conv_id="conv_id", turn="turn", role="role", **{parts: "parts"}).select(
        "conv_id", F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    ahead = Window.partitionBy("conv_id").orderBy("turn", "role", "parts").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: Column) -> Column:
        return F.coalesce(F.sum(column).over(ahead), F.lit(0)).cast("long")

    slim = slim.withColumn("things", F.filter("parts", _attached))
    slim = slim.withColumns({"first": before(F.size("things").cast("long")), "place": F.row_number().over(ahead.rowsBetween(Window.unboundedPreceding, 0))})
    # The n-th attachment of a turn is at place i of its parts: count those before it.
    flat = F.array_join(
        F.transform(
            "parts",
            lambda p, i: F.when(
                _attached(p),
                F.concat(
                    F.lit("\\["), p["kind"], F.lit(":"),
                    (F.col("first") + F.size(F.filter(F.slice("parts", F.lit(1), i), _attached))).cast("string"), F.lit("]"),
                ),
            ).otherwise(_doubled(F.coalesce(p["text"], F.lit("")))),
        ),
        "",
    )
    head = F.concat(F.lit(HEAD), F.regexp_replace(escaped(F.col("role")), ":(?= )", r":\\"), F.lit(MIDDLE))
    slim = slim.select(
        "conv_id", "turn", "role", "place",
        F.transform(
            "things",
            lambda p, i: F.struct(
                (F.col("first") + i).cast("long").alias("number"), F.col("turn").alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                expanded_tokens(p, costs).alias("tokens"),
            ),
        ).alias("things"),
        head.alias("head"), _marks_broken(flat).alias("body"),
    )
    ahead = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    slim = slim.withColumn("piece", F.concat("head", "body", F.lit(END)))
    slim = slim.withColumns({
        "start": before(F.char_length("piece")) + F.char_length("head"),
        "start_byte": before(F.octet_length("piece")) + F.octet_length("head"),
    })
    span = F.when(
        F.col("role") == loss_role,
        F.struct("start", F.char_length("body").cast("long").alias("length"), "start_byte", F.octet_length("body").cast("long").alias("n_bytes")),
    )
    row = F.struct("place", "piece", span.alias("span"), "things")
    whole = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    whole = whole.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"),
        F.array_join(F.col("rows.piece"), "").alias("formatted"),
        F.filter("rows.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("rows.things").alias("attachments"),
    )
    return whole.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]))


def read_turns(text: str = "formatted") -> Column:
    """The turns of a formatted conversation: a list of (role, text), placeholders left out."""
    pieces = F.split(F.col(text), END, -1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, MIDDLE)
        role = F.substring(piece, F.lit(len(HEAD) + 1), at - F.lit(len(HEAD) + 1))
        body = F.substring(piece, at + F.lit(len(MIDDLE)), F.char_length(piece))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def read_loss(text: str = "formatted", spans: str = "loss_spans") -> Column:
    """The text under the loss mask, unescaped, joined without anything between."""
    # The bytes are bound once by a list of one; cut by bytes, a span costs its own length.
    cut = F.transform(
        F.array(F.col(text).cast("binary")),
        lambda body: F.array_join(
            F.transform(
                F.col(spans),
                lambda s: unescaped(F.substring(body, (s["start_byte"] + 1).cast("int"), s["n_bytes"].cast("int")).cast("string")),
            ),
            "",
        ),
    )
    return F.element_at(cut, 1)


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, hashes of turns and loss, lengths: read back from the output of ``formatted``."""
    read = conversations.select("conv_id", "formatted", read_turns().alias("turns"), read_loss().alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
