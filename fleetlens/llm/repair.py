"""Repair of conversation structure by iterative-deepening A*.

A whole conversation reads ``(s?(ua)+)?`` over the initials of its roles: an
optional system turn, then user and assistant turns in pairs, or nothing.  A
repair is a string of edits in row order

    D  delete the row, 2            I  insert an empty user or assistant row, 5
    K  keep it, 0 (truncated: 5)    R  set its role to user or assistant, 1 (truncated: 6)

where blank and duplicate rows can only be deleted.  After any edits only one
role of user and assistant may follow, so the string says it all.  The cheapest
string is wanted, of equal ones the least in ASCII order.

``search`` finds it: depth first, edits in ASCII order, under a cost bound that
grows to the least cost seen beyond it, so the first accepting path is the
answer.  ``estimate`` never exceeds the cost left.  States that failed keep
the least cost they are now known to need, so none is expanded again under a
bound it cannot meet.

A conversation of any length is cut in blocks of BLOCK rows, each searched
where it lies:

1. rows are range partitioned by (conversation, turn, role, text hash), sorted and numbered;
   repeats of (role, text) are found by a partial minimum of those numbers;
2. blocks that are a whole conversation are searched at once;
3. the others are searched from every state to every state; a pass from the
   last block to the first adds those costs up to the cost left after each
   block, which the final searches of all blocks, again side by side, start
   from; a pass from first to last follows the states.

The two passes read 16 numbers a block of BLOCK rows, in order, and hold one
block.  Only the digest of a repaired text (``digests``) reads a conversation's
rows in one task, since SHA-256 is a chain: a stream in constant memory.  The
edit string of a conversation is one cell, a byte a row.

Defined cases: NULL role and text count as one space; a NULL turn sorts first;
rows of equal turn are ordered by role and text hash; NULL conv_ids are one
conversation.  Blank: nothing but white space.  Duplicate: role and text occur
in an earlier row.  Truncated: the last character that is no white space is
none of ``.!?``.  Of these the first counts.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fleetlens.llm.common import SPACES, Workspace, small_side

# Fixed costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK = 64  # rows searched at a time
NEVER = 1 << 30

# States: what the last row left is.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The state after a row of role initial s, u, a; None where such a row cannot follow.
FOLLOWS = [[SYSTEM, USER, None], [None, USER, None], [None, None, ASSISTANT], [None, USER, None]]
# The only one of user and assistant that can follow, as a state.
NEXT = [USER, USER, ASSISTANT, USER]
ROLE = {USER: "user", ASSISTANT: "assistant"}
# Cost of closing a conversation after its last row: empty rows are inserted until it may end.
END = [0, 2 * INSERT, INSERT, 0]

# A row as a number: 4 * initial (s, u, a, other) + fault.
OTHER = 3
SOUND, CUT, BLANK, DUPLICATE = range(4)


def conflict(x: int, y: int) -> bool:
    """Whether rows of these initials cannot stand side by side."""
    return (x, y) not in ((0, 1), (1, 2), (2, 1))


def estimate(tape: bytes) -> list[int]:
    """For each suffix of the rows, a cost no repair of it is below.

    Blank, duplicate and truncated rows cost at least DELETE, rows of another
    role REROLE.  Of two sound rows in conflict with no such row between, one
    is edited or an insert parts them, so pairs that share no row add one each.
    """
    own = [0] * (len(tape) + 1)
    pairs = [0] * (len(tape) + 1)
    after = None  # the next sound row, if the rows between are to be deleted anyway
    beyond = 0  # pairs behind that row
    for i in range(len(tape) - 1, -1, -1):
        initial, fault = divmod(tape[i], 4)
        sound = fault == SOUND and initial != OTHER
        own[i] = own[i + 1] + (0 if sound else REROLE if fault == SOUND else DELETE)
        pairs[i] = pairs[i + 1]
        if sound:
            if after is not None and conflict(initial, after):
                pairs[i] = max(pairs[i], 1 + beyond)
            after, beyond = initial, pairs[i + 1]
        elif fault in (SOUND, CUT):
            after = None
    return [a + b for a, b in zip(own, pairs, strict=True)]


def search(tape: bytes, entry: int, after: list[int]) -> tuple[int, str, int] | None:
    """(cost of the edits, edits, last state) of the best repair of the rows ``tape`` from state ``entry``.

    ``after`` is the cost that follows each last state (NEVER: not allowed);
    None if no edits lead to an allowed one.
    """
    end = len(tape)
    least = min(after)
    need = [[h + least] * STATES for h in estimate(tape)]
    need[end] = list(after)
    # a state that no row leads out of to an allowed one is no use; inserts would go round for ever there
    for dead in range(1, STATES):
        if min(after[dead if dead < USER else USER :]) >= NEVER:
            for row in need[:end]:
                row[dead] = NEVER
    path: list[str] = []
    last = entry

    def moves(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        initial, fault = divmod(tape[i], 4)
        yield "D", DELETE, i + 1, q
        yield "I", INSERT, i, NEXT[q]
        if fault in (SOUND, CUT):
            extra = TRUNCATED if fault == CUT else 0
            if initial != OTHER and FOLLOWS[q][initial] is not None:
                yield "K", extra, i + 1, FOLLOWS[q][initial]
            yield "R", REROLE + extra, i + 1, NEXT[q]

    def descend(i: int, q: int, budget: int) -> bool:
        nonlocal last
        if i == end:
            last = q
            return True
        best = NEVER
        for edit, cost, j, p in moves(i, q):
            if cost + need[j][p] <= budget:
                path.append(edit)
                if descend(j, p, budget - cost):
                    return True
                path.pop()
            best = min(best, cost + need[j][p])
        need[i][q] = max(need[i][q], best)  # failed: it takes at least this
        return False

    while (bound := need[0][entry]) < NEVER:
        if descend(0, entry, bound):
            return bound - after[last], "".join(path), last
    return None


def transfer(tape: bytes, first: bool) -> list[int]:
    """Least cost from each state to each, row by row of a 4 x 4 matrix; only from EMPTY in a first block."""
    out = [NEVER] * (STATES * STATES)
    keeps_system = any(b in (SOUND, CUT) for b in tape)  # initial s is 0, so the number is the fault
    for entry in [EMPTY] if first else range(STATES):
        for last in range(STATES):
            if last == EMPTY and entry != EMPTY or last == SYSTEM and entry > SYSTEM:
                continue
            if last == SYSTEM and entry == EMPTY and not keeps_system:
                continue
            found = search(tape, entry, [0 if q == last else NEVER for q in range(STATES)])
            if found is not None:
                out[STATES * entry + last] = found[0]
    return out


def steps(pos: int, tape: bytes, entry: int, edits: str) -> Iterator[tuple[int, int, str, str | None]]:
    """(row number, step at that row, edit, new role or None) of the edits of a block starting at row ``pos``."""
    row, q, step = 0, entry, 0
    for edit in edits:
        role = None
        if edit in "IR":
            q = NEXT[q]
            role = ROLE[q]
        elif edit == "K":
            q = FOLLOWS[q][tape[row] // 4]
        yield pos + min(row, len(tape) - 1), step, edit, role
        step += 1
        if edit != "I":
            row, step = row + 1, step if row + 1 == len(tape) else 0


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) spoiled by crc32("conv_id:turn") % 20, NULLs read as one space.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets role user.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.col("text")
    return (
        turns.select(
            F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"),
            shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"),
        )
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


@dataclass
class Repaired:
    """``conversations``: (key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit).

    ``rows``: the repaired conversations, (key, pos, step, conv_id, turn, edit,
    role, text) in the order of (key, pos, step); inserted rows have no turn and
    an empty text.
    """

    conversations: DataFrame
    rows: DataFrame


def _key() -> Column:
    """conv_id as text that no other conv_id has, NULL included."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _numbered(turns: DataFrame, work: Workspace) -> DataFrame:
    """The rows, numbered in the order of (conversation, turn, role, text hash)."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = turns.select(F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"), *shown)
    order = ["key", "turn", "role", "sha"]
    rows = rows.select(_key().alias("key"), "*", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return work.save(sorted_.withColumn("pos", F.monotonically_increasing_id()), "rows")


def _tapes(rows: DataFrame, work: Workspace) -> DataFrame:
    """(key, pos, tape) with one number per row; written in order of pos."""
    groups = rows.groupBy("key", "role", "sha").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1")
    first = small_side(work.save(groups.drop("n"), "repeated"), 256)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = rows.select(
        "key", "pos", "role", "sha", (trimmed == "").alias("blank"), F.right(trimmed, F.lit(1)).isin(".", "!", "?").alias("ended")
    ).join(first, ["key", "role", "sha"], "left")
    initial = F.left("role", F.lit(1))
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(F.col("ended"), SOUND).otherwise(CUT)
    )
    numbers = marked.select("key", "pos", (4 * code + fault).cast("int").alias("symbol"))
    return work.save(numbers.repartitionByRange("pos").sortWithinPartitions("pos"), "symbols")


def _blocks(symbols: DataFrame, size: int) -> DataFrame:
    """(key, pos, tape): runs of at most ``size`` rows of a conversation that lie side by side."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, bytes]] = []
        key, start, tape = None, 0, bytearray()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=["key", "pos", "tape"])

        for batch in batches:
            for k, pos, symbol in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tape and (k != key or pos != start + len(tape) or len(tape) == size):
                    out.append((key, start, bytes(tape)))
                    tape = bytearray()
                if not tape:
                    key, start = k, pos
                tape.append(symbol)
            if len(out) >= 1000:
                yield flush()
        if tape:
            out.append((key, start, bytes(tape)))
        if out:
            yield flush()

    return symbols.mapInArrow(rows, "key string, pos long, tape binary")


def _mapped(df: DataFrame, columns: list[str], one: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Each row of ``columns`` as a dict through ``one``, which yields rows of ``schema``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(fields)
        for batch in batches:
            found = [out for row in batch.to_pylist() for out in one(row)]
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    fields = StructType.fromDDL(schema)
    return df.select(*columns).mapInArrow(rows, fields)


def _streamed(df: DataFrame, ascending: bool, one: Callable[[], Callable[[dict], dict]], columns: list[str], schema: str) -> DataFrame:
    """The blocks of each conversation, in order or backwards, through a stepper made anew for each conversation."""
    pos = F.col("pos") if ascending else F.col("pos").desc()
    state: dict = {}

    def step(row: dict) -> Iterator[dict]:
        if state.get("key") != row["key"]:
            state["key"], state["step"] = row["key"], one()
        yield state["step"](row)

    return _mapped(df.select(*columns).repartition("key").sortWithinPartitions("key", pos), columns, step, schema)


def _backwards() -> Callable[[dict], dict]:
    """Cost left after each block, and whether its last row conflicts with the next block's first."""
    left, following = END, None

    def step(row: dict) -> dict:
        nonlocal left, following
        after, tape, last = left, row["tape"], following is None
        illegal = 0 if following is None else int(conflict(tape[-1] // 4, following))
        matrix = np.array(row["matrix"]).reshape(STATES, STATES)
        left = np.minimum((matrix + np.array(after)).min(axis=1), NEVER).tolist()
        following = tape[0] // 4
        return {k: row[k] for k in ("key", "pos", "tape", "first")} | {"last": last, "seam": illegal, "after": list(after)}

    return step


def _forwards() -> Callable[[dict], dict]:
    state = EMPTY

    def step(row: dict) -> dict:
        nonlocal state
        entry, found = state, row["found"][state]
        state = found["last"]
        return {k: row[k] for k in ("key", "pos", "tape", "seam")} | {"entry": entry, "cost": found["cost"], "audit": found["audit"]}

    return step


_FOUND = "struct<cost long, audit string, last int>"


def _solved(row: dict) -> Iterator[dict]:
    """The best repair of a block from each state it may be entered in, closed by inserts if it is the last."""
    found = []
    for entry in range(STATES):
        if row["first"] and entry != EMPTY:
            found.append({"cost": None, "audit": None, "last": None})
            continue
        cost, edits, last = search(row["tape"], entry, row["after"])
        if row["last"]:
            edits, cost = edits + "I" * (END[last] // INSERT), cost + END[last]
        found.append({"cost": cost, "audit": edits, "last": last})
    yield {k: row[k] for k in ("key", "pos", "tape", "seam")} | {"found": found}


def _chosen(blocks: DataFrame, work: Workspace) -> DataFrame:
    """(key, pos, tape, seam, entry, cost, audit): the edits of every block."""
    ends = blocks.groupBy("key").agg(F.count("*").alias("blocks"), F.min("pos").alias("begin"))
    counted = work.save(
        blocks.join(ends, "key").select("key", "pos", "tape", (F.col("pos") == F.col("begin")).alias("first"), "blocks"), "counted"
    )
    closing = F.array(*(F.lit(c).cast("long") for c in END)).alias("after")
    chosen = "key string, pos long, tape binary, seam int, entry int, cost long, audit string"
    solved = f"key string, pos long, tape binary, seam int, found array<{_FOUND}>"
    needs = ["key", "pos", "tape", "first", "last", "seam", "after"]

    alone = counted.where("blocks = 1").select("key", "pos", "tape", "first", F.lit(True).alias("last"), F.lit(0).alias("seam"), closing)
    alone = _mapped(alone, needs, _solved, solved).select(
        "key", "pos", "tape", "seam", F.lit(EMPTY).alias("entry"), F.col("found")[0]["cost"].alias("cost"),
        F.col("found")[0]["audit"].alias("audit"),
    )

    def with_matrix(row: dict) -> Iterator[dict]:
        yield row | {"matrix": transfer(row["tape"], row["first"])}

    parts = _mapped(
        counted.where("blocks > 1"), ["key", "pos", "tape", "first"], with_matrix,
        "key string, pos long, tape binary, first boolean, matrix array<long>",
    )
    left = _streamed(
        work.save(parts, "matrices"), False, _backwards, ["key", "pos", "tape", "first", "matrix"],
        "key string, pos long, tape binary, first boolean, last boolean, seam int, after array<long>",
    )
    solved_parts = work.save(_mapped(work.save(left, "left"), needs, _solved, solved), "solved")
    followed = _streamed(solved_parts, True, _forwards, ["key", "pos", "tape", "seam", "found"], chosen)
    return work.save(alone.unionByName(followed), "chosen")


def repair(turns: DataFrame, block: int = BLOCK) -> Repaired:
    """The cheapest repair of every conversation of ``turns`` (conv_id, turn, role, text)."""
    work = Workspace(turns.sparkSession, "repair")
    rows = _numbered(turns, work)
    symbols = _tapes(rows, work)
    chosen = _chosen(_blocks(symbols, block), work)

    def counted(row: dict) -> Iterator[dict]:
        tape = row["tape"]
        faults = [b % 4 for b in tape]
        initials = [b // 4 for b in tape]
        inside = sum(conflict(x, y) for x, y in zip(initials, initials[1:], strict=False))
        yield {
            "key": row["key"], "pos": row["pos"], "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(CUT), "illegal": inside + row["seam"], "cost": row["cost"], "audit": row["audit"],
        }

    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    per_block = _mapped(
        chosen, ["key", "pos", "tape", "seam", "cost", "audit"], counted,
        "key string, pos long, blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "audit"))), lambda s: s["audit"]), "")
    summed = per_block.groupBy("key").agg(*(F.sum(c).alias(c) for c in counts), audit.alias("audit"))
    turn_counts = rows.groupBy("key", "turn").agg(F.min("conv_id").alias("conv_id"))
    gaps = turn_counts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
    )
    conversations = gaps.join(summed, "key")

    def edited(row: dict) -> Iterator[dict]:
        for pos, step, edit, role in steps(row["pos"], row["tape"], row["entry"], row["audit"]):
            if edit != "D":
                yield {"key": row["key"], "pos": pos, "step": step, "edit": edit, "new_role": role}

    edits = _mapped(
        chosen, ["key", "pos", "tape", "entry", "audit"], edited, "key string, pos long, step int, edit string, new_role string"
    )
    left = edits.where("edit <> 'I'").join(rows.select("pos", "conv_id", "turn", "role", "text"), "pos")
    inserted = edits.where("edit = 'I'").select(
        "key", "pos", "step", F.expr("cast(nullif(substr(key, 2), '') as long)").alias("conv_id"),
        F.lit(None).cast("long").alias("turn"), "edit", F.col("new_role").alias("role"), F.lit("").alias("text"),
    )
    left = left.select(
        "key", "pos", "step", "conv_id", "turn", "edit", F.coalesce("new_role", "role").alias("role"), "text"
    )
    return Repaired(conversations, left.unionByName(inserted))


def digests(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of the rows of ``Repaired.rows``: SHA-256 of ``role:text`` lines, read as a stream."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "repaired_sha256"])

        for batch in batches:
            for k, role, text in zip(*(batch.column(c).to_pylist() for c in (0, 3, 4)), strict=True):
                if digest is None or k != key:
                    if digest is not None:
                        yield one()
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if digest is not None:
            yield one()

    ordered = repaired.select("key", "pos", "step", "role", "text").repartition("key").sortWithinPartitions("key", "pos", "step")
    return ordered.mapInArrow(rows, "key string, repaired_sha256 string")


def report(originals: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conv_id of ``originals``: faults, cost and edits of its rows in ``damaged``, and the repaired text's digest."""
    fixed = repair(damaged)
    ids = originals.select(F.col("`conv_id`").cast("long").alias("conv_id")).distinct().withColumn("key", _key())
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        ids.join(fixed.conversations.drop("conv_id"), "key", "left")
        .join(digests(fixed.rows), "key", "left")
        .select(
            "conv_id",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )
    )
