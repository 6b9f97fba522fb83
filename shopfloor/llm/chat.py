"""Chat logs: folding events into final messages and rendering them with a loss mask.

Only DataFrame functions. Everything is grouped by conversation, which one shuffle provides; a
conversation's formatted text is one value, so a conversation is the smallest unit there can be.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escape(text: Column) -> Column:
    """Text without any ``<|``: backslashes are doubled, then ``<|`` becomes ``<\\|``.

    After doubling, a single backslash between ``<`` and ``|`` can only come from the second step.
    """
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def as_events(rows: DataFrame) -> DataFrame:
    """A log for ``fold`` from finished messages (conv_id, turn, role, text): one message event for each row.

    Rows of a conversation are numbered by turn, null turns first, then by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("seq", F.row_number().over(order).cast("bigint"))
    return numbered.select("conv_id", "seq", F.col("seq").alias("message"), F.lit(MESSAGE).alias("kind"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, seq, message, kind, role, text).

    In the order of ``seq``, ``message`` and ``delta`` events append their text to the message,
    ``edit`` replaces what it said so far, and ``regenerate`` empties it and drops what later
    messages (those with a higher number) had said until then. A message without remaining events
    disappears. Its role is that of its earliest event that has one, else empty. Null texts are
    empty; events of equal ``seq`` apply in the order of kind and text; an unknown kind appends;
    events without a message number or a sequence number come first, as number 0. Events of a null
    conversation belong to one conversation without a name. Other columns are left out.
    """
    replaces = F.col("kind").isin(EDIT, REGENERATE)
    rows = events.select(
        "conv_id",
        F.coalesce(F.col("seq").cast("bigint"), F.lit(0)).alias("seq"),
        F.coalesce(F.col("message").cast("bigint"), F.lit(0)).alias("message"),
        F.coalesce("kind", F.lit(DELTA)).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("conv_id", "message")
    in_order = own.orderBy("seq", "role").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    standing = (
        rows.withColumn("dropped_until", F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).over(earlier))
        .withColumn("role", F.first("role", ignorenulls=True).over(in_order))
        .withColumn("restart", F.max(F.when(replaces, F.col("seq"))).over(own))
        .filter("dropped_until IS NULL OR seq > dropped_until")
        .filter("restart IS NULL OR seq >= restart")
    )
    # Of a sequence number's events the replacing ones come first: 'edit' < 'regenerate' < others.
    place = F.when(replaces, F.col("seq") * 2).otherwise(F.col("seq") * 2 + 1)
    said = F.array_sort(F.collect_list(F.struct(place.alias("place"), "kind", "text")))
    return standing.groupBy("conv_id", "message").agg(
        F.coalesce(F.min("role"), F.lit("")).alias("role"),
        F.array_join(F.transform(said, lambda e: F.when(e["kind"] == REGENERATE, "").otherwise(e["text"])), "").alias("text"),
    )


def render(messages: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_turns, loss_spans.

    ``formatted`` holds per message the start marker, the role, a line break, the text and the end
    marker with a line break; control strings inside are escaped. ``loss_turns`` says for each turn
    whether its text is to be learned, ``loss_spans`` where these texts stand in ``formatted``, in
    code points from 0. Expects the columns of ``fold``.
    """
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    pieces = messages.select(
        "conv_id",
        "message",
        F.col("role").isin(*loss_roles).alias("learned"),
        F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
    ).withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    begin = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(before), F.lit(0)) + F.length("head")
    turn = F.struct(
        "message", "piece", "learned", F.struct(F.col("begin").alias("start"), F.length("body").cast("bigint").alias("length")).alias("span")
    )
    turns = F.array_sort(F.collect_list(turn))
    return (
        pieces.withColumn("begin", begin)
        .groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.array_join(F.col("turns.piece"), "").alias("formatted"),
            F.col("turns.learned").alias("loss_turns"),
            F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["span"]).alias("loss_spans"),
        )
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """The columns of ``render`` and ``turns``, the (role, text) pairs read from ``formatted`` alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), F.lit(2), F.size("loss_turns") + 1)
    role = lambda p: F.substring_index(p, "\n", 1)
    text = lambda p: F.substr(p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 2 - len(END))
    return rendered.withColumn(
        "turns",
        F.transform(pieces, lambda p: F.struct(_unescape_role(role(p)).alias("role"), unescape(text(p)).alias("text"))),
    )


def learned_text(turns: Column, loss_turns: Column) -> Column:
    """The texts under the loss mask, one after the other."""
    return F.array_join(F.zip_with(turns, loss_turns, lambda t, learned: F.when(learned, t["text"]).otherwise("")), "")
