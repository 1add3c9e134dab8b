"""Conversations brought to ``system? (user assistant)+`` by the cheapest edits, found by branch and bound.

Order within a conversation: turn, nulls first, then the hash of role and text; equal rows are interchangeable.
The search sees one letter per row. Sorted rows lie in range partitions; a conversation that a partition's bound or
the greatest length of a segment cuts has each segment searched for every state it may begin and end in, and the
sixteen costs of its segments choose among the results. So no task gathers a conversation of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.sources.shared import discard, staged

# White space, and the costs of edits.
SPACE = " \t\n\x0b\x0c\r"
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3

# What a sequence of roles may be continued by: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT_ROLE = {EMPTY: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_NEXT = (USER, USER, ASSISTANT, USER)
# Inserts that end a sequence in each state, and what they cost.
ENDING = ("", "II", "I", "")
ENDING_COST = tuple(INSERT * len(x) for x in ENDING)
NEVER = 1 << 60

SEGMENT_ROWS = 4096


@dataclass(frozen=True)
class Item:
    """``n`` rows that are treated alike: to be deleted (letter X), or one row by its role's initial."""

    letter: str
    truncated: bool = False
    n: int = 1


# Search


def cheapest(items: Sequence[Item], start: int = EMPTY, end_costs: Sequence[int] = ENDING_COST, least=None) -> tuple[int, str, int]:
    """(cost, audit, state) of the cheapest edits of ``items``, of equal ones the least audit.

    ``end_costs`` are added by the state the items end in. Inserts come before a row; those after the last are the end's. Depth
    first with a stack, the most promising edit first: a prefix is dropped when its cost and the least cost of the rest
    (``least``, of ``least_rests``) exceed the best solution so far or equal it with a
    greater audit, or when another prefix came to the same row and state as cheaply or with a
    smaller audit. Two prefixes of equal cost there are never the beginning of one another, as each letter has its
    cost, so the smaller one stays smaller. The stack empties when nothing better is left.
    Without a way to an end that is allowed the cost is ``NEVER``.
    """
    least = least or least_rests(items, end_costs)
    best_cost, best_audit, best_state = NEVER, "", start
    seen: list[dict[int, tuple[int, str]]] = [{} for _ in range(len(items) + 1)]
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        total = cost + least[at][state]
        if total > best_cost or total >= NEVER or (total == best_cost and audit > best_audit[: len(audit)]):
            continue
        known = seen[at].get(state)
        if known is not None and known <= (cost, audit):
            continue
        seen[at][state] = (cost, audit)
        if at == len(items):
            if (total, audit) < (best_cost, best_audit):
                best_cost, best_audit, best_state = total, audit, state
            continue
        steps = [
            (cost + price + least[to_at][to], letters, to_at, to, cost + price)
            for letters, to_at, to, price in _edits(items[at], at, state)
        ]
        steps.sort(reverse=True)  # the most promising last, as it is taken first
        stack.extend((to_at, to, price, audit + letters) for _, letters, to_at, to, price in steps)
    return best_cost, best_audit, best_state


def _edits(item: Item, at: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letters, next row, next state, cost) of what may be done at a row."""
    found = [("D" * item.n, at + 1, state, DELETE * item.n), ("I", at, _NEXT[state], INSERT)]
    if item.letter != "X":
        extra = TRUNCATED if item.truncated else 0
        found.append(("R", at + 1, _NEXT[state], REROLE + extra))
        kept = _kept(item.letter, state)
        if kept is not None:
            found.append(("K", at + 1, kept, extra))
    return found


def _kept(letter: str, state: int) -> int | None:
    if letter == "s":
        return SYSTEM if state == EMPTY else None
    if letter == "u":
        return USER if state != USER else None
    return ASSISTANT if letter == "a" and state == USER else None


def least_rests(items: Sequence[Item], end_costs: Sequence[int]) -> list[tuple[int, ...]]:
    """For the rows from each one on, the least cost by state, without the edits that lead there."""
    rest = tuple(end_costs)
    found = [rest]
    for at in range(len(items) - 1, -1, -1):
        costs = [NEVER] * len(STATES)
        for state in STATES:
            costs[state] = min(price + rest[to] for letters, _, to, price in _edits(items[at], at, state) if letters != "I")
        for _ in range(2):  # two inserts lead through all states that inserts lead to
            costs = [min(costs[state], INSERT + costs[_NEXT[state]]) for state in STATES]
        rest = tuple(costs)
        found.append(rest)
    return found[::-1]


# Segments


def _in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in role and text, and the digest that breaks ties of a turn."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)))


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[tuple], bool]]:
    """Sorted (conv_id, ...) rows as segments of one conversation and at most ``size`` rows, each with whether it is the
    whole conversation: neither cut here nor perhaps cut by the task's own bounds."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    held: tuple[list[tuple], bool] | None = None
    first = True
    for _, group in groupby(rows, key=lambda row: row[0]):
        segment: list[tuple] = []
        cut = first
        if held is not None:
            yield held
        for row in group:
            if len(segment) == size:
                yield segment, False
                segment, cut = [], True
            segment.append(row)
        held, first = (segment, not cut), False
    if held is not None:
        yield held[0], False


_COUNTS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost")
_SEGMENT = {
    "conv_id": pa.int64(), "part": pa.int64(), "whole": pa.bool_(), **{name: pa.int64() for name in _COUNTS[:-1]},
    "first_letter": pa.string(), "last_letter": pa.string(),
    "costs": pa.list_(pa.int64()), "places": pa.list_(pa.int32()), "audits": pa.list_(pa.string()),
}
_SEGMENT_SCHEMA = (
    "conv_id long, part long, whole boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first_letter string, last_letter string, costs array<long>, places array<int>, audits array<string>"
)
_LEGAL = {"su", "ua", "au"}


def _searched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 32  # range partitions and the segments within are in order
    segments = (_segment_row(segment, part + i, whole) for i, (segment, whole) in enumerate(_segments(batches, size)))
    while out := list(islice(segments, 1024)):
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SEGMENT.values())], names=list(_SEGMENT))


def _segment_row(segment: list[tuple], part: int, whole: bool) -> tuple:
    """The counts of a segment's (conv_id, turn, letter, blank, truncated, seen, n) rows, and its searches."""
    items: list[Item] = []
    blank = duplicate = truncated = illegal = 0
    last = ""
    for _, _, letter, is_blank, is_truncated, seen, n in segment:
        illegal += n - 1 + (last != "" and last + letter not in _LEGAL)
        last = letter
        copies = n if is_blank or seen else n - 1
        if is_blank:
            blank += n
        else:
            duplicate += copies
        if copies < n:
            truncated += is_truncated
            items.append(Item(letter, is_truncated))
        if copies:
            items.append(Item("X", n=copies))
    if whole:
        cost, audit, state = cheapest(items)
        costs, places, audits = [cost], [0], [audit + ENDING[state]]
    else:
        costs, places, audits = _all_ways(items)
    turns = [row[1] for row in segment if row[1] is not None]
    bounds = (turns[0], turns[-1]) if turns else (None, None)
    return (
        segment[0][0], part, whole, *bounds, len(set(turns)), blank, duplicate, truncated, illegal,
        segment[0][2], last, costs, places, audits,
    )


def _all_ways(items: Sequence[Item]) -> tuple[list[int], list[int], list[str | None]]:
    """For each state before (slowest) and after the items: the least cost, the audit, and the audit's place among those from the same state (-1: none)."""
    only = [[0 if state == end else NEVER for state in STATES] for end in STATES]
    least = [least_rests(items, costs) for costs in only]
    costs, places, audits = [], [], []
    for start in STATES:
        found = [cheapest(items, start, only[end], least[end]) for end in STATES]
        in_order = sorted(audit for cost, audit, _ in found if cost < NEVER)
        costs += [cost for cost, _, _ in found]
        places += [in_order.index(audit) if cost < NEVER else -1 for cost, audit, _ in found]
        audits += [audit if cost < NEVER else None for cost, audit, _ in found]
    return costs, places, audits


def _joined(parts: pa.Table) -> pa.Table:
    """The counts of one conversation's segments together, and which of its searches each one takes (-1: its first row holds the sums)."""
    rows = sorted(parts.to_pylist(), key=lambda row: row["part"])
    ends = [list(ENDING_COST)]
    for row in reversed(rows[1:]):
        ends.append([min(row["costs"][4 * s + x] + ends[-1][x] for x in STATES) for s in STATES])
    state, chosen, cost = EMPTY, [], 0
    for row, end in zip(rows, reversed(ends)):
        options = [(row["costs"][4 * state + x] + end[x], row["places"][4 * state + x], x) for x in STATES if row["places"][4 * state + x] >= 0]
        _, _, to = min(options)
        chosen.append(4 * state + to)
        cost += row["costs"][4 * state + to]
        state = to
    total = {name: sum(row[name] for row in rows) for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
    total["illegal"] += sum(a["last_letter"] + b["first_letter"] not in _LEGAL for a, b in zip(rows, rows[1:]))
    known = [row for row in rows if row["low"] is not None]
    total["turns"] -= sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
    total |= {"low": known[0]["low"] if known else None, "high": known[-1]["high"] if known else None, "cost": cost + ENDING_COST[state]}
    return pa.table(
        {
            "conv_id": pa.array([row["conv_id"] for row in rows], pa.int64()),
            "part": pa.array([row["part"] for row in rows], pa.int64()),
            "taken": pa.array(chosen, pa.int32()),
            "ending": pa.array([""] * (len(rows) - 1) + [ENDING[state]], pa.string()),
            **{name: pa.array([total[name] if i == 0 else None for i in range(len(rows))], pa.int64()) for name in _COUNTS},
        }
    )


def repairs(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, ...): its faults, and the cheapest edits.

    conv_id, gaps (turns missing between the lowest and the highest), blank (no other
    than white space), duplicate (role and text seen earlier), truncated (the last character ends no sentence), illegal (neighbours that
    may not follow each other), cost and audit (the initials of Keep, Rerole, Delete and Insert in order).
    Each row's first fault counts. A null conv_id is a conversation like any other; a null role or text
    counts as one space, null turns come first and leave no gap; a row whose role begins with none of s, u, a cannot be
    kept as it is. Texts count whole and stay behind, repeated rows are counted
    together before the shuffle, an empty table gives an empty result.
    """
    rows = _in_order(rows)
    trimmed = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    letters = rows.select(
        "conv_id",
        "turn",
        "digest",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("letter"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    letters = staged(letters.groupBy(*letters.columns).agg(F.count(F.lit(1)).alias("n")), "turns")
    # a role and text are seen earlier where they have a lower turn; equal rows of one turn are one row of letters
    first = letters.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), F.col("first.turn").alias("first_turn"))
    alike = (F.col("conv_id").eqNullSafe(F.col("of"))) & (F.col("digest") == F.col("same"))
    order = ("conv_id", "turn", "digest")
    seen = letters.join(first, alike).withColumn("seen", ~F.col("turn").eqNullSafe(F.col("first_turn")))
    seen = staged(seen.select(*order, "letter", "blank", "truncated", "seen", "n"), "turns")
    sorted_rows = seen.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest")
    found = staged(sorted_rows.mapInArrow(lambda batches: _searched(batches, segment_rows), _SEGMENT_SCHEMA), "segments")
    discard(letters)
    discard(seen)

    whole = found.where("whole").select("conv_id", *_COUNTS[:-1], F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    cut = found.where("NOT whole")
    schema = "conv_id long, part long, taken int, ending string, " + ", ".join(f"{name} long" for name in _COUNTS)
    taken = cut.drop("audits").groupBy("conv_id").applyInArrow(_joined, schema).drop("conv_id")
    of_part = F.concat(F.col("audits")[F.col("taken")], "ending").alias("audit")
    pieces = cut.select("conv_id", "part", "audits").join(taken, "part").select("conv_id", "part", of_part, *_COUNTS)
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "")
    joined = pieces.groupBy("conv_id").agg(*(F.max(name).alias(name) for name in _COUNTS), audit.alias("audit"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
    return whole.unionByName(joined).select("conv_id", gaps, *_COUNTS[3:], "audit")


# Repaired rows


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The edits of ``repairs(rows)`` carried out: conv_id, place, edit, role, text, in order within each task.

    place counts the edits of a conversation from 0, edit is Keep, Rerole, Delete or Insert; deleted rows keep their role and text here, the rest
    is the repaired conversation. Rows are sorted and passed through one by one,
    so a conversation of any length needs no more memory than its audit.
    """
    order = ("conv_id", "is_row", "turn", "digest")
    given = _in_order(rows).withColumns({"is_row": F.lit(True), "audit": F.lit(None).cast("string")})
    audits = found.select("conv_id", "audit").withColumns(
        {"is_row": F.lit(False), "turn": F.lit(None).cast("long"), "digest": F.lit(None).cast("binary"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    )
    both = given.unionByName(audits).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "is_row", "audit", "role", "text").mapInArrow(_edited, "conv_id long, place long, edit string, role string, text string")


_EDIT_NAMES = {"K": "Keep", "R": "Rerole", "D": "Delete", "I": "Insert"}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows after their conversation's audit, as edits."""
    conv_id, audit, place, state = None, "", 0, EMPTY

    def inserts(out: list[tuple]) -> None:
        nonlocal place, state
        while place < len(audit) and audit[place] == "I":
            out.append((conv_id, place, "Insert", NEXT_ROLE[state], ""))
            place, state = place + 1, _NEXT[state]

    for batch in batches:
        out: list[tuple] = []
        for conversation, is_row, letters, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if not is_row:
                inserts(out)
                conv_id, audit, place, state = conversation, letters, 0, EMPTY
                continue
            inserts(out)
            edit = audit[place]
            if edit == "K":
                state = _kept(role[0], state)
            elif edit == "R":
                role, state = NEXT_ROLE[state], _NEXT[state]
            out.append((conv_id, place, _EDIT_NAMES[edit], role, text))
            place += 1
        if out:
            yield _edits_batch(out)
    out = []
    inserts(out)
    if out:
        yield _edits_batch(out)


def _edits_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def text_digests(turns: DataFrame) -> DataFrame:
    """``repaired_turns`` to conv_id, repaired_sha256: of the lines ``role:text`` that are not deleted, joined by line ends.

    ``turns`` must come as made, sorted within each task. A conversation with no edits has no row.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, content, lines = None, None, 0
        for batch in batches:
            done = []
            for conversation, place, edit, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if place == 0:
                    if content:
                        done.append((conv_id, content.hexdigest()))
                    conv_id, content, lines = conversation, hashlib.sha256(), 0
                if edit != "Delete":
                    content.update((("\n" if lines else "") + f"{role}:{text}").encode())
                    lines += 1
            if done:
                yield _digest_batch(done)
        if content:
            yield _digest_batch([(conv_id, content.hexdigest())])

    return turns.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "repaired_sha256"])


# Damage


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, ...) with some damaged, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user. A null counts as
    one space, also in what is hashed; other columns are not read, repeated rows
    are damaged alike, an empty table stays empty.
    """
    known = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *known[:2]).cast("binary")) % 20
    role = F.when(kind == 4, F.lit("user")).otherwise(known[2])
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(known[3], ".!?", "")).otherwise(known[3])
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    copied = F.explode(F.array_repeat(F.struct(role.alias("role"), text.alias("text")), copies)).alias("row")
    return rows.select("conv_id", "turn", copied).select("conv_id", "turn", "row.role", "row.text")
