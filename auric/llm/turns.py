"""Conversation structure repair by depth-first branch-and-bound.

A conversation is read in the order of its turns. A search over edits (keep,
rerole, delete, insert) finds the cheapest ones that leave an optional system
turn and then user and assistant turns in alternation; of equal costs, the
ASCII-least string of edits' initials. The search keeps an explicit stack, an
incumbent (cost, edits), a lower bound of what the remaining rows must cost,
and for each (row, last role) the best prefix seen, against which others are
dropped. When the stack is empty the incumbent is proved.

Only roles and faults are searched over, not texts. Rows are range-partitioned
in their order, so a long conversation lies in several partitions: each
partition solves its share for every role that may stand before it, and the
shares are joined. A share of more than ``SPAN`` rows is solved in spans that are
joined the same way. Joining is exact: prefixes of one cost that read the same
rows and end in the same role differ before either ends, so the lesser stays
the lesser whatever follows. Texts meet their edits in a stream sorted by
conversation, which holds a batch of rows and one conversation's edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.common import SPACES, saved, shuffle_partitions

SPAN = 64                       # rows of one search
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT, OTHER = range(5)    # the last role; OTHER: of rows only
ROLES = {USER: "user", ASSISTANT: "assistant"}
BLANK, DUPLICATE, CUT = 1, 2, 3                     # faults; 0 is none
DONE = (START, ASSISTANT)                           # where a conversation may end
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _next(state: int) -> int:
    """The role that an insert or rerole takes after ``state``."""
    return ASSISTANT if state == USER else USER


def bounds(rows: list[tuple[int, int]]) -> list[list[int]]:
    """``bounds[state][i]``: a cost that rows i, i + 1, ... cannot go below
    after ``state``.

    Each row pays its least edit: a blank or repeated row its deletion, a cut
    row its penalty, a row of no usable role its rerole. Of two rows of one role
    with only deleted rows between, at most one is left as it is, or something
    is inserted; such pairs are counted where they share no row.
    """
    n = len(rows)
    # After: nothing known, a user row, an assistant row, and the same two where
    # that row is cut (deleting it then costs only one more than keeping it).
    free, after = [0] * (n + 1), {k: [0] * (n + 1) for k in ((USER, 0), (ASSISTANT, 0), (USER, 1), (ASSISTANT, 1))}
    start = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        role, fault = rows[i]
        if fault in (BLANK, DUPLICATE):
            free[i] = DELETE + free[i + 1]
            start[i] = DELETE + start[i + 1]
            for table in after.values():
                table[i] = DELETE + table[i + 1]
            continue
        cut = int(fault == CUT)
        own = TRUNCATED * cut
        if role not in (USER, ASSISTANT):
            own = min(DELETE, own + REROLE)
            free[i] = own + free[i + 1]
            for table in after.values():
                table[i] = own + free[i + 1]
            kept = TRUNCATED * cut if role == SYSTEM else own
            start[i] = min(kept + free[i + 1], DELETE + start[i + 1])
            continue
        free[i] = own + after[role, cut][i + 1]
        for (before, before_cut), table in after.items():
            if before == role:
                table[i] = own + (DELETE - TRUNCATED if cut or before_cut else REROLE) + free[i + 1]
            else:
                table[i] = free[i]
        start[i] = min(free[i], DELETE + start[i + 1])
    return [start, free, after[USER, 0], after[ASSISTANT, 0]]


def search(rows: list[tuple[int, int]], entry: int, targets: Iterable[int],
           lower: list[list[int]] | None = None) -> tuple[int, str] | None:
    """The cheapest (cost, edits) from role ``entry`` through all rows to one of
    ``targets``; None if there is none."""
    n, targets = len(rows), frozenset(targets)
    lower = lower or bounds(rows)
    best: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    stack = [(0, entry, 0, "")]
    incumbent: tuple[int, str] | None = None
    while stack:
        i, state, cost, edits = stack.pop()
        if best[i, state] != (cost, edits):
            continue                                    # a better prefix came since
        if incumbent is not None:
            bound = cost + lower[state][i]
            if bound > incumbent[0] or (bound == incumbent[0] and edits > incumbent[1][:len(edits)]):
                continue
        if i == n and state in targets and (incumbent is None or (cost, edits) < incumbent):
            incumbent = (cost, edits)
        following = _next(state)
        children = [(i, following, cost + INSERT, edits + "I")]
        if i < n:
            role, fault = rows[i]
            children.append((i + 1, state, cost + DELETE, edits + "D"))
            if fault not in (BLANK, DUPLICATE):
                extra = TRUNCATED if fault == CUT else 0
                if role == following or (role == SYSTEM and state == START):
                    children.append((i + 1, role, cost + extra, edits + "K"))
                children.append((i + 1, following, cost + extra + REROLE, edits + "R"))
        ready = []
        for child in children:
            at, known = child[:2], best.get(child[:2])
            if known is None or child[2:] < known:
                best[at] = child[2:]
                ready.append((-child[2] - lower[child[1]][child[0]], child))
        ready.sort(key=lambda c: (c[0], c[1][0], [-ord(x) for x in c[1][3][-1]]))
        stack.extend(c for _, c in ready)
    return incumbent


Table = dict[tuple[int, int], tuple[int, str]]


def _least(found: Iterable[tuple[int, str] | None]) -> tuple[int, str] | None:
    return min((f for f in found if f is not None), default=None)


def _joined(a: Table, b: Table) -> Table:
    """The best (cost, edits) for each (entry, exit) through both."""
    out: Table = {}
    for (entry, middle), (cost, edits) in a.items():
        for (again, end), (more, rest) in b.items():
            if again == middle:
                found = (cost + more, edits + rest)
                if (entry, end) not in out or found < out[entry, end]:
                    out[entry, end] = found
    return out


def transfer(rows: list[tuple[int, int]]) -> Table:
    """The best (cost, edits) from each role before the rows to each after."""
    pending: list[tuple[int, Table]] = []               # (spans held, table), in order
    for at in range(0, max(1, len(rows)), SPAN):
        span = rows[at:at + SPAN]
        lower = bounds(span)
        table = {(entry, end): found for entry in range(4) for end in range(4)
                 if (found := search(span, entry, (end,), lower)) is not None}
        pending.append((1, table))
        while len(pending) > 1 and pending[-1][0] >= pending[-2][0]:
            (n, right), (m, left) = pending.pop(), pending.pop()
            pending.append((n + m, _joined(left, right)))
    while len(pending) > 1:
        (n, right), (m, left) = pending.pop(), pending.pop()
        pending.append((n + m, _joined(left, right)))
    return pending[0][1]


def solve(rows: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, edits) of a whole conversation of (role, fault) rows."""
    if len(rows) <= SPAN:
        return search(rows, START, DONE)
    table = transfer(rows)
    return _least(table.get((START, end)) for end in DONE)


def edited(edits: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what is left of (role, text) rows, in order."""
    state, rows = START, iter(rows)
    for edit in edits:
        if edit == "I":
            state = _next(state)
            yield edit, ROLES[state], ""
            continue
        role, text = next(rows)
        if edit == "D":
            continue
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]] if edit == "K" else _next(state)
        yield edit, role if edit == "K" else ROLES[state], text


# --- on Spark ---------------------------------------------------------------

ORDER = ("conv", "turn", "role", "h1", "h2", "id")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one row in four harmed in a way that the
    CRC-32 of ``conv_id:turn`` picks: by remainder of 20, 0 drops the row, 1
    empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 makes the role
    user. Nulls count as one space in that text, and as role and text."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    harm = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), harm.alias("harm")).filter("harm <> 0").select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", ""))
         .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    ).drop("copy")


def _rows(conversations: DataFrame) -> DataFrame:
    """The rows with their faults but repetition, an id, and hashes of the text;
    written, so that ids and order stay as they are."""
    rows = conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    return saved(rows.select(
        "*", F.monotonically_increasing_id().alias("id"), F.xxhash64("text").alias("h1"),
        F.xxhash64("text", F.lit(1)).alias("h2"),
        F.when(solid == "", BLANK).when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0).alias("fault")),
        "turns")


def _found(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``a`` with the other columns of ``b`` where the keys agree, nulls
    included."""
    keys = list(keys)
    renamed = b.withColumnsRenamed({k: f"{k}_of_b" for k in keys})
    return a.join(renamed, reduce(and_, (F.col(k).eqNullSafe(F.col(f"{k}_of_b")) for k in keys)), "left") \
            .drop(*(f"{k}_of_b" for k in keys))


def _faults(rows: DataFrame) -> DataFrame:
    """Rows without texts; one whose role and text are in an earlier row of its
    conversation has the fault of repetition unless it is blank."""
    narrow = rows.drop("text")
    keys = ["conv", "role", "h1", "h2"]
    place = F.struct(F.col("turn").isNotNull().alias("later"), "turn", "id")
    first = narrow.filter(F.col("fault") != BLANK).groupBy(*keys).agg(F.min(place)["id"].alias("first"))
    return _found(narrow, first, keys).select(
        *ORDER, F.when((F.col("fault") != BLANK) & (F.col("first") != F.col("id")), DUPLICATE)
                 .otherwise(F.col("fault")).cast("int").alias("fault"))


_SHARE = ("blank long, duplicate long, truncated long, illegal long, first int, last int, cost long, edits string, "
          "shares array<struct<entry:int,exit:int,cost:long,edits:string>>")
_CODES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def _share(rows: list[tuple[int, int]], whole: bool) -> dict:
    out = {"blank": sum(f == BLANK for _, f in rows), "duplicate": sum(f == DUPLICATE for _, f in rows),
           "truncated": sum(f == CUT for _, f in rows),
           "illegal": sum((a, b) not in LEGAL for (a, _), (b, _) in zip(rows, rows[1:])),
           "first": rows[0][0], "last": rows[-1][0], "cost": None, "edits": None, "shares": None}
    if whole:
        out["cost"], out["edits"] = solve(rows)
    else:
        out["shares"] = [{"entry": e, "exit": x, "cost": c, "edits": s} for (e, x), (c, s) in transfer(rows).items()]
    return out


def _solved(conv_type: pa.DataType):
    """mapInArrow function over rows in order. The first and the last
    conversation of a partition may go on in others: they become shares."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId()
        schema = pa.schema([("conv", conv_type), ("piece", pa.int32()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                            ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.int32()),
                            ("last", pa.int32()), ("cost", pa.int64()), ("edits", pa.string()),
                            ("shares", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()),
                                                           ("cost", pa.int64()), ("edits", pa.string())])))])
        current, rows, first, out = None, [], True, []
        for batch in batches:
            for conv, role, fault in zip(*(batch[c].to_pylist() for c in ("conv", "role", "fault"))):
                if rows and conv != current:
                    out.append({"conv": current, "piece": piece, **_share(rows, whole=not first)})
                    rows, first = [], False
                current = conv
                rows.append((_CODES.get(role[:1], OTHER), fault))
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if rows:
            out.append({"conv": current, "piece": piece, **_share(rows, whole=False)})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _assembled(shares: pa.Table) -> pa.Table:
    """applyInArrow function: one conversation from its partitions' shares."""
    parts = shares.sort_by("piece").to_pylist()
    table = None
    for part in parts:
        own = {(s["entry"], s["exit"]): (s["cost"], s["edits"]) for s in part["shares"]}
        table = own if table is None else _joined(table, own)
    cost, edits = _least(table.get((START, end)) for end in DONE)
    illegal = sum(p["illegal"] for p in parts) + sum((a["last"], b["first"]) not in LEGAL
                                                     for a, b in zip(parts, parts[1:]))
    return pa.table({"conv": shares["conv"][:1], **{
        c: pa.array([sum(p[c] for p in parts)], pa.int64()) for c in ("blank", "duplicate", "truncated")},
        "illegal": pa.array([illegal], pa.int64()), "cost": pa.array([cost], pa.int64()),
        "edits": pa.array([edits], pa.string())})


_PLAN = "blank long, duplicate long, truncated long, illegal long, cost long, edits string"


def _plan(rows: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, edits), written."""
    conv = rows.schema["conv"].dataType
    name = conv.simpleString()
    n = shuffle_partitions(rows.sparkSession)
    ordered = _faults(rows).repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER)
    from pyspark.sql.pandas.types import to_arrow_type

    found = saved(ordered.select("conv", "role", "fault").mapInArrow(
        _solved(to_arrow_type(conv)), f"conv {name}, piece int, {_SHARE}"), "turns-shares")
    columns = ["conv", *(f.split()[0] for f in _PLAN.split(", "))]
    joined = found.filter("shares is not null").groupBy("conv").applyInArrow(_assembled, f"conv {name}, {_PLAN}")
    return saved(found.filter("shares is null").select(*columns).unionByName(joined.select(*columns)), "turns-plan")


def _with_edits(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each conversation's edits and then its rows in order, in one partition."""
    texts = rows.select(*ORDER, "text", F.lit(None).cast("string").alias("edits"), F.lit(1).alias("kind"))
    heads = plan.select("conv", *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ORDER[1:]),
                        F.lit(None).cast("string").alias("text"), "edits", F.lit(0).alias("kind"))
    order = ("conv", "kind", *ORDER[1:])
    return heads.unionByName(texts).repartition(shuffle_partitions(rows.sparkSession), "conv") \
        .sortWithinPartitions(*order).select("conv", "edits", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, Iterator[tuple[str, str]]]]:
    """(conv, edits, its rows) from a stream of heads and rows."""
    def stream():
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in ("conv", "edits", "role", "text")))

    rest = stream()
    head = next(rest, None)
    while head is not None:
        following = []

        def own():
            for row in rest:
                if row[1] is not None:
                    following.append(row)
                    return
                yield row[2], row[3]

        mine = own()
        yield head[0], head[1], mine
        for _ in mine:
            pass
        head = following[0] if following else None


def _digests(conv_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, digests = [], []
        for conv, edits, rows in _conversations(batches):
            digest, between = hashlib.sha256(), b""
            for _, role, text in edited(edits, rows):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            convs.append(conv)
            digests.append(digest.hexdigest())
            if len(convs) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(digests)], ["conv", "digest"])
                convs, digests = [], []
        if convs:
            yield pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(digests)], ["conv", "digest"])
    return run


def _applied(conv_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["conv_id", "place", "edit", "role", "text"], [conv_type, pa.int64(), *[pa.string()] * 3]
        out = []
        for conv, edits, rows in _conversations(batches):
            for place, row in enumerate(edited(edits, rows)):
                out.append((conv, place, *row))
                if len(out) == 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    return run


def repaired(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` (conv_id, turn, role, text) after repair:
    conv_id, place (from 0), edit (K, R or I), role, text.

    Rows are read by turn, null turns first; rows of one turn by role and then
    by a hash of the text, so that equal rows lie together. Null role or text
    is one space; rows with a null conv_id are one conversation. A row whose
    role is empty or does not begin with s, u or a is never kept as it is. An
    empty table gives no rows; other columns are dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = _rows(conversations)
    conv = rows.schema["conv"].dataType
    return _with_edits(rows, _plan(rows)).mapInArrow(
        _applied(to_arrow_type(conv)),
        f"conv_id {conv.simpleString()}, place long, edit string, role string, text string")


def repair(conversations: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit (the edits' initials) and repaired_sha256 (of the
    repaired ``role:text`` joined by line feeds).

    ``of`` names the conversations to report (its conv_id); one without rows has
    zeros, no edits and the digest of nothing. Rows are read as ``repaired``
    reads them. gaps counts the turns missing between the least and the
    greatest; null turns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = _rows(conversations)
    conv = rows.schema["conv"].dataType
    plan = _plan(rows)
    digests = _with_edits(rows, plan).mapInArrow(_digests(to_arrow_type(conv)),
                                                 f"conv {conv.simpleString()}, digest string")
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    every = (of if of is not None else conversations).select(F.col("conv_id").alias("conv")).distinct()
    return _found(_found(_found(every, plan, ["conv"]), turns, ["conv"]), digests, ["conv"]).select(
        F.col("conv").alias("conv_id"),
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("edits", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
