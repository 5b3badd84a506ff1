"""Chat logs: event-sourced reconstruction and a training template, in DataFrame expressions only.

A log has one row per event: conversation, sequence number, kind, turn, role and
text. Kinds: ``message`` opens a turn with its text, ``delta`` appends streamed
text, ``edit`` replaces the text of a turn, ``regenerate`` empties a turn so that
the deltas after it write it anew. An edit or a regeneration also drops what
later turns had said before it, since they answered the former text.

Template: a turn is ``### <role>: <text> </turn>`` and a line end. Backslash,
every ``#`` and ``</turn>`` inside a text become ``\\b``, ``\\h`` and
``\\t/turn>``; roles also write ``:`` and line ends as codes. No control string
can then come from a text, however many ``#`` it has in a row, so the output
splits at literal marks and every text is read back exactly.

A null text is empty, a null role is an empty role, and null sequence numbers or
turns come first. Events of equal sequence number are ordered by kind (opening
ones first), then text; repeated events are kept, since a delta may repeat.
Unknown kinds count as messages. An empty log gives no conversations. A very
long text is one event or many; a conversation is one row of the output, so its
final texts meet in one task. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Codes for backslash and control strings; unescaped in reverse order.
TEXT_CODES = [("\\", "\\b"), ("#", "\\h"), ("</turn>", "\\t/turn>")]
ROLE_CODES = [*TEXT_CODES, (":", "\\c"), ("\n", "\\n")]
HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
LOSS_ROLE = "assistant"


def escape(text: Column, codes: list[tuple[str, str]] = TEXT_CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes: list[tuple[str, str]] = TEXT_CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold_events(
    events: DataFrame,
    conv_id: str = "conv_id",
    seq: str = "seq",
    kind: str = "kind",
    turn: str = "turn",
) -> DataFrame:
    """The final messages of a log: conv_id, turn, role and text.

    Events are folded per turn first, so a long conversation is spread over
    tasks; only facts about its turns meet in one window.
    """
    log = events.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(seq).alias("seq"),
        F.when(F.col(kind).isin("delta", "edit", "regenerate"), F.col(kind)).otherwise("message").alias("kind"),
        F.col("role").alias("role"),
        _empty("text").alias("text"),
    ).withColumn(
        "opens", F.when(F.col("kind") == "message", 0).when(F.col("kind") == "delta", 2).otherwise(1)
    )
    # (sequence, rank of kind) of the last event that empties the turn, and of the last revision.
    at = F.struct("seq", "opens")
    turns = log.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("kind") != "delta", at)).alias("start"),
        F.max(F.when(F.col("opens") == 1, at)).alias("revised"),
        F.max_by("role", F.when(F.col("role").isNotNull(), at)).alias("role"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("dropped", F.max("revised").over(earlier))
    mine = log.alias("l").join(
        turns.alias("t"),
        F.col("l.conv_id").eqNullSafe(F.col("t.conv_id")) & F.col("l.turn").eqNullSafe(F.col("t.turn")),
    )
    here = F.struct(F.col("l.seq").alias("seq"), F.col("l.opens").alias("opens"))
    alive = (F.col("t.start").isNull() | (here >= F.col("t.start"))) & (
        F.col("t.dropped").isNull() | (here > F.col("t.dropped"))
    )
    part = F.struct("l.seq", "l.opens", F.when(F.col("l.kind") == "regenerate", "").otherwise(F.col("l.text")).alias("text"))
    folded = (
        mine.where(alive)
        .groupBy(F.col("l.conv_id").alias("conv_id"), F.col("l.turn").alias("turn"))
        .agg(
            F.array_sort(F.collect_list(part)).alias("parts"),
            F.first("t.role").alias("role"),
        )
    )
    # Of several messages or edits at one place the last text stands; deltas follow it.
    final = F.aggregate(
        "parts",
        F.struct(F.lit("").alias("text"), F.array().cast("array<string>").alias("more")),
        lambda held, p: F.when(
            p["opens"] < 2, F.struct(p["text"].alias("text"), F.array().cast("array<string>").alias("more"))
        ).otherwise(F.struct(held["text"].alias("text"), F.concat(held["more"], F.array(p["text"])).alias("more"))),
        lambda held: F.concat(held["text"], F.array_join(held["more"], "")),
    )
    return folded.select("conv_id", "turn", _empty("role").alias("role"), final.alias("text"))


def turns_as_events(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Finished turns as a log of message events.

    Rows are numbered by turn, role and text, so repeated turns stay messages of
    their own instead of replacing each other.
    """
    order = Window.partitionBy(conv_id).orderBy(turn, "role", "text")
    return turns.select(
        F.col(conv_id).alias("conv_id"),
        F.row_number().over(order).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    ).withColumn("turn", F.col("seq"))


def turns_as_streams(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Finished turns as the log of a conversation that was streamed and revised.

    An assistant's turn opens empty, streams a first draft (the first half of
    its text), is regenerated and streams its text in two deltas; any other turn
    opens with half of its text and is edited to the whole one.
    """
    events = turns_as_events(turns, conv_id, turn)
    text = _empty("text")
    half = F.floor(F.char_length(text) / 2).cast("int")
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text) - half)

    def steps(*kinds: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in kinds])

    none = F.lit(None).cast("string")
    streamed = steps(("message", none), ("delta", first), ("regenerate", none), ("delta", first), ("delta", rest))
    edited = steps(("message", first), ("edit", text))
    spread = F.when(F.col("role").eqNullSafe(LOSS_ROLE), streamed).otherwise(edited)
    return events.select("conv_id", "turn", "role", "seq", F.posexplode(spread).alias("step", "event")).select(
        "conv_id", (F.col("seq") * 8 + F.col("step")).alias("seq"), "event.kind", "turn", "role", "event.text"
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted text, and its parts with the loss mask.

    ``segments`` joined is ``formatted``; a segment with ``loss`` holds the
    (escaped) text of one turn of ``loss_role``.
    """
    ordered = F.array_sort(
        F.collect_list(F.struct("turn", _empty("role").alias("role"), _empty("text").alias("text")))
    )
    turns = messages.groupBy("conv_id").agg(ordered.alias("turns"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(
                    F.concat(F.lit(HEAD), escape(t["role"], ROLE_CODES), F.lit(COLON)).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss")),
                F.struct(F.lit(TAIL).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    parts = turns.select("conv_id", segments.alias("segments"))
    return parts.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation: array of (role, text)."""
    pieces = F.split(formatted, TAIL, -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def read(piece: Column) -> Column:
        body = F.substring(piece, len(HEAD) + 1, F.char_length(piece))
        role = F.substring_index(body, COLON, 1)
        text = F.substring(body, F.char_length(role) + len(COLON) + 1, F.char_length(body))
        return F.struct(unescape(role, ROLE_CODES).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, read)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def digests(rendered: DataFrame) -> DataFrame:
    """Facts that are read back from rendered conversations."""
    read = rendered.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    joined = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
