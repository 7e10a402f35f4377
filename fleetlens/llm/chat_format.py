"""Chat formatting in budgeted windows, in DataFrame functions only.

Template: each turn is ``<turn>role``, a line feed, the text, a line feed and
``</turn>`` with a line feed.  Inside a text, one backslash is put before every
control string (``<turn>``, ``</turn>``) together with the backslashes it
already has; a real control string follows a line feed or nothing, so reading
back removes exactly one.  A role escapes backslash, line feed and ``<``.

Windows: a turn's tokens are estimated as a quarter of its formatted bytes,
rounded up.  Prefix sums of the tokens cut the
conversation into slots; the turns that begin in a slot form a window, and the
slot's width is chosen so that a window stays within the budget.  Each window
starts with the conversation's system turn, then repeats the turns before it
that fit the history allowance.  Repeated turns carry no loss; a window's own
assistant texts do, each exactly once over all windows.  A turn larger than
half the room has a window of its own, which alone may pass the budget
(``over_budget``); nothing is cut.

Defined cases: NULL texts and roles are empty; turns are ordered by turn (NULL
first), then role and text, so repeated rows are repeated turns; a NULL
conversation id is one conversation.  Windows of one conversation are computed
with sorted windows that spill, and only the digest query joins a
conversation's turns into one row.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

BUDGET = 1024  # tokens of a window
HISTORY = 128  # tokens of repeated turns in it
BYTES_PER_TOKEN = 4
OPEN, CLOSE = "<turn>", "</turn>"
LOSS_ROLE = "assistant"
_END = f"\n{CLOSE}\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*</?turn>)", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*</?turn>)", "$1")


def escape_role(role: Column) -> Column:
    r = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    r = F.replace(r, F.lit("\n"), F.lit("\\n"))
    return F.replace(r, F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    # a backslash pair is parked on a character no escaped role holds: a line feed
    r = F.replace(role, F.lit("\\\\"), F.lit("\n"))
    r = F.replace(r, F.lit("\\l"), F.lit("<"))
    parts = F.split(r, "\n", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def turns_of(conversations: DataFrame) -> DataFrame:
    """Formatted turns: conv_id, place (0, 1, ...), role, text, segment, head (code points before the text), tokens."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    base = conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    estimated = F.ceil(F.octet_length("segment") / BYTES_PER_TOKEN)
    return (
        base.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("body", escape(F.col("text")))
        .withColumn("segment", F.concat(head, "body", F.lit(_END)))
        .select(
            "conv_id",
            "place",
            "role",
            "segment",
            F.length(head).alias("head"),
            F.length("body").alias("body_points"),
            estimated.cast("long").alias("tokens"),
        )
    )


def windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """One row per window: conv_id, window, formatted, n_repeated, n_new, tokens, loss_spans, over_budget.

    ``loss_spans`` are (start, length) in code points of ``formatted``.
    """
    conv = Window.partitionBy("conv_id")
    turns = turns_of(conversations)
    # the system turn is set apart; the others are cut by prefix sums
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    system_tokens = F.coalesce(F.max(F.when(is_system, F.col("tokens"))).over(conv), F.lit(0))
    turns = turns.withColumn("is_system", is_system).withColumn("system_tokens", system_tokens)
    body = F.when(F.col("is_system"), F.lit(0)).otherwise(F.col("tokens"))
    room = F.greatest(F.lit(budget) - F.col("system_tokens") - F.lit(history), F.lit(2)).cast("long")
    half = F.floor(F.col("room") / 2)
    by_place = conv.orderBy("place")
    turns = (
        turns.withColumn("cost", body)
        .withColumn("room", room)
        .withColumn("before", F.sum("cost").over(by_place) - F.col("cost"))
        .withColumn("big", F.col("cost") > half)
        .withColumn("largest_small", F.coalesce(F.max(F.when(~F.col("big"), F.col("cost"))).over(conv), F.lit(0)))
        # turns that begin in a slot of this width add up to less than width + the largest of them
        .withColumn("slot", F.floor(F.col("before") / F.greatest(F.col("room") - F.col("largest_small"), F.lit(1))))
    )
    previous = lambda c: F.lag(c).over(by_place)
    cut = (
        previous("slot").isNull()
        | (F.col("slot") != previous("slot"))
        | F.col("big")
        | F.coalesce(previous("big"), F.lit(False))
    )
    # the first turn after the system turn does not cut: both open window 0
    cut = F.when(F.coalesce(previous("is_system"), F.lit(False)), F.lit(False)).otherwise(cut)
    turns = turns.withColumn("window", F.sum(cut.cast("int")).over(by_place) - 1)
    # prefix sums again: the turns that begin at most ``history`` tokens before this one
    recent = conv.orderBy("before").rangeBetween(-history, -1)
    item = F.struct("place", "segment", "is_system")
    turns = turns.withColumn("history", F.filter(F.collect_list(item).over(recent), lambda x: ~x["is_system"]))
    system = F.max(F.when(F.col("is_system"), F.col("segment"))).over(conv)
    turns = turns.withColumn("system", system)

    new = F.sort_array(F.collect_list(F.struct("place", "segment", "head", "body_points", "role", "cost", "is_system")))
    grouped = turns.groupBy("conv_id", "window").agg(
        new.alias("new"),
        F.min(F.struct("place", "history"))["history"].alias("history"),
        F.first("system").alias("system"),
        F.first("system_tokens").alias("system_tokens"),
    )
    repeated = F.when(F.col("window") == 0, F.array().cast("array<string>")).otherwise(
        F.concat(
            F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.array().cast("array<string>")),
            F.transform(F.sort_array("history"), lambda x: x["segment"]),
        )
    )
    texts = F.concat("repeated", F.transform("new", lambda x: x["segment"]))
    lead = F.aggregate("repeated", F.lit(0), lambda n, s: n + F.length(s))
    spans = F.aggregate(
        "new",
        F.struct(lead.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["segment"])).alias("at"),
            F.when(
                x["role"] == loss_role,
                F.concat(
                    s["spans"],
                    F.array(F.struct((s["at"] + x["head"]).alias("start"), x["body_points"].alias("length"))),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    tokens = (
        F.aggregate("new", F.lit(0).cast("long"), lambda n, x: n + x["cost"])
        + F.col("system_tokens")
        + F.aggregate("repeated", F.lit(0).cast("long"), lambda n, s: n + F.ceil(F.octet_length(s) / BYTES_PER_TOKEN))
        - F.when((F.col("window") > 0) & F.col("system").isNotNull(), F.ceil(F.octet_length("system") / BYTES_PER_TOKEN)).otherwise(0)
    )
    return grouped.withColumn("repeated", repeated).select(
        "conv_id",
        "window",
        F.array_join(texts, "").alias("formatted"),
        F.size("repeated").alias("n_repeated"),
        F.size("new").alias("n_new"),
        tokens.alias("tokens"),
        spans.alias("loss_spans"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window: its own turns as (role, text), in order, and its loss texts, unescaped, from the formatted text alone."""
    # a real control string never follows a backslash
    marked = F.split("formatted", r"(?<!\\)<turn>", -1)
    parts = F.slice(marked, F.col("n_repeated") + 2, F.size(marked) - 1 - F.col("n_repeated"))
    turn = lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(
            F.substr(
                p,
                F.length(F.substring_index(p, "\n", 1)) + 2,
                F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(_END),
            )
        ).alias("text"),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select(
        "conv_id", "window", F.transform(parts, turn).alias("turns"), loss.alias("loss"), F.length("formatted").alias("points")
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(formatted).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("all"),
        F.array_join("loss", "").alias("loss"),
        "points",
    )
    parts = F.sort_array(F.collect_list(F.struct("window", "all", "loss")))
    one = back.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), parts.alias("parts"), F.sum("points").alias("formatted_chars")
    )
    text = F.array_join(F.transform("parts", lambda p: p["all"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return one.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
