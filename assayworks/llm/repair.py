"""Repair of conversations: the cheapest edits to a legal order of roles, by dynamic programming with square-root checkpoints."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayworks.llm.shared import written

# Costs of edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: A conversation of more rows or characters is repaired in spans of about so many.
SPAN, SPAN_BYTES = 16_384, 1 << 23

# What has been emitted so far: nothing, a system row, an open user row, a whole exchange. Nothing and whole exchanges may end.
NOTHING, SYSTEM, OPEN, WHOLE = range(4)
KEEPS = ({"s": SYSTEM, "u": OPEN}, {"u": OPEN}, {"a": WHOLE}, {"u": OPEN})
NEXT = (OPEN, OPEN, WHOLE, OPEN)
FAR = 1 << 60
LAST = (0, FAR, FAR, 0)
GOOD, BLANK, DUPLICATE, CUT = "", "blank", "duplicate", "truncated"

Vector = tuple[int, int, int, int]
Row = tuple[str, str, str]  # role, text, fault


def before(row: Row | None, after: Vector) -> Vector:
    """Least costs from each state before a row, given those behind it; with no row, at the end of the conversation."""
    if row is None:
        base = list(after)
    else:
        role, _, fault = row
        dropped = [min(FAR, DELETE + after[s]) for s in range(4)]
        base = dropped
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT else 0
            base = []
            for s in range(4):
                cost = min(dropped[s], REROLE + extra + after[NEXT[s]])
                kept = KEEPS[s].get(role[:1])
                if kept is not None:
                    cost = min(cost, extra + after[kept])
                base.append(cost)
    # Inserted rows only lead to OPEN and WHOLE, and going round costs more than it gains.
    opened, whole = min(base[OPEN], INSERT + base[WHOLE]), min(base[WHOLE], INSERT + base[OPEN])
    return (min(base[NOTHING], INSERT + opened), min(base[SYSTEM], INSERT + opened), opened, whole)


def end_costs(last: Vector) -> Vector:
    return before(None, last)


def checkpoints(rows: list[Row], last: Vector) -> tuple[int, list[Vector]]:
    """A step near the square root of the rows, and the cost vectors before every step-th row and behind the last one."""
    step = max(1, math.isqrt(len(rows)))
    kept, now = [last], last
    for i in range(len(rows) - 1, -1, -1):
        now = before(rows[i], now)
        if i % step == 0:
            kept.append(now)
    return step, kept[::-1]


def walk(rows: list[Row], last: Vector, state: int, at_end: bool) -> Iterator[tuple[str, int, str, str]]:
    """The ASCII-least cheapest edits from a state: edit, state behind it, role and text of the row it leaves.

    ``last`` are the costs behind the rows; only blocks between two checkpoints are held. With ``at_end`` the edits that
    end the conversation follow.
    """
    step, kept = checkpoints(rows, last)
    for k, low in enumerate(range(0, len(rows), step)):
        block = rows[low:low + step]
        vectors = [kept[k + 1]]
        for row in reversed(block):
            vectors.append(before(row, vectors[-1]))
        vectors.reverse()
        for row, now, after in zip(block, vectors, vectors[1:], strict=False):
            role, text, fault = row
            stays = fault not in (BLANK, DUPLICATE)
            extra = TRUNCATED if fault == CUT else 0
            while True:
                if now[state] == DELETE + after[state]:
                    yield "D", state, "", ""
                    break
                if now[state] == INSERT + now[NEXT[state]]:
                    state = NEXT[state]
                    yield "I", state, USER if state == OPEN else ASSISTANT, ""
                    continue
                kept_state = KEEPS[state].get(role[:1]) if stays else None
                if kept_state is not None and now[state] == extra + after[kept_state]:
                    state = kept_state
                    yield "K", state, role, text
                    break
                state = NEXT[state]
                yield "R", state, USER if state == OPEN else ASSISTANT, text
                break
    if at_end:
        while LAST[state]:
            state = NEXT[state]
            yield "I", state, USER if state == OPEN else ASSISTANT, ""


def transfer(rows: list[Row]) -> list[int]:
    """Least costs of passing the rows from each state to each, row by row of the matrix."""
    columns = []
    for target in range(4):
        now: Vector = tuple(0 if s == target else FAR for s in range(4))
        for row in reversed(rows):
            now = before(row, now)
        columns.append(now)
    return [min(columns[t][s], FAR) for s in range(4) for t in range(4)]


def passed(matrix: list[int], after: Vector) -> Vector:
    return tuple(min(FAR, *(matrix[4 * s + t] + after[t] for t in range(4))) for s in range(4))


# --- rows --------------------------------------------------------------------------------------


def fault_of(text: str, duplicate: bool) -> str:
    whole = text.strip(SPACES)
    if not whole:
        return BLANK
    if duplicate:
        return DUPLICATE
    return GOOD if whole[-1] in ENDS else CUT


def illegal(first: str | None, second: str) -> bool:
    return first is not None and first[:1] + second[:1] not in ("su", "ua", "au")


@dataclass
class Tally:
    """Counts over rows in order. Two tallies of neighbouring stretches can be added."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    def add(self, turn: int | None, row: Row) -> None:
        role, _, fault = row
        one = Tally(1, int(fault == BLANK), int(fault == DUPLICATE), int(fault == CUT), 0, int(turn is not None), turn, turn, role[:1], role[:1])
        self.join(one)

    def join(self, other: Tally) -> None:
        if not other.rows:
            return
        self.illegal += other.illegal + (self.rows > 0 and illegal(self.last_role, other.first_role))
        self.turns += other.turns - (self.high is not None and self.high == other.low)
        for name in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        self.low = other.low if self.low is None else self.low
        self.high = other.high if other.high is not None else self.high
        self.first_role = other.first_role if self.first_role is None else self.first_role
        self.last_role = other.last_role

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


@dataclass
class Digest:
    """The repaired conversation as one text, hashed as it comes."""

    state: object = field(default_factory=hashlib.sha256)
    started: bool = False

    def line(self, line: bytes) -> None:
        self.state.update(b"\n" + line if self.started else line)
        self.started = True


RESULT = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
          ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
          ("repaired_sha256", pa.string())]
RESULT_TYPE = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
               "repaired_sha256 string")


def _result(conv_id: int | None, tally: Tally, cost: int, audit: str, digest: Digest) -> tuple:
    return (conv_id, tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, audit,
            digest.state.hexdigest())


def _whole(conv_id: int | None, turns: list[int | None], texts: list[tuple[str, str]]) -> tuple:
    """The result of a conversation at hand."""
    seen, rows, tally = set(), [], Tally()
    for turn, (role, text) in zip(turns, texts, strict=True):
        row = (role, text, fault_of(text, (role, text) in seen))
        seen.add((role, text))
        rows.append(row)
        tally.add(turn, row)
    digest, edits = Digest(), []
    last = end_costs(LAST)
    for edit, _, role, text in walk(rows, last, NOTHING, True):
        edits.append(edit)
        if edit != "D":
            digest.line(f"{role}:{text}".encode())
    return _result(conv_id, tally, checkpoints(rows, last)[1][0][NOTHING], "".join(edits), digest)


# --- the table ---------------------------------------------------------------------------------


def _first_pass(span: int, span_bytes: int):
    """Streams sorted rows. A conversation that begins and ends within the partition and fits one span is settled at once;
    rows of others go on with their place in the order and the place where their span begins."""
    names = [n for n, _ in RESULT]
    more = [("place", pa.int64()), ("span", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]

    def batch_of(done: list[tuple], rest: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([*(r[i] for r in done), *([None] * len(rest))], t) for i, (_, t) in enumerate(RESULT)]
        columns[0] = pa.array([r[0] for r in done + rest], pa.int64())
        columns += [pa.array([*([None] * len(done)), *(r[i] for r in rest)], t) for i, (_, t) in enumerate(more, start=1)]
        return pa.RecordBatch.from_arrays(columns, [*names, *(n for n, _ in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of a conversation that may still prove short
        conv, started, open_ = None, False, True
        place = at = rows = size = 0
        for batch in batches:
            done: list[tuple] = []
            rest: list[tuple] = []
            for i, turn, role, text, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place += 1
                if not started or i != conv:
                    if not open_:
                        done.append(_whole(conv, [r[3] for r in held], [r[4:] for r in held]))
                    # The first conversation of a partition may have begun in the one before.
                    held, conv, open_, started = [], i, not started, True
                    at, rows, size = place, 0, 0
                elif rows >= span or size >= span_bytes:
                    rest += held
                    held, open_ = [], True
                    at, rows, size = place, 0, 0
                rows += 1
                size += len(role) + len(text)
                (rest if open_ else held).append((i, part << 40 | place, part << 40 | at, turn, role, text))
            if done or rest:
                yield batch_of(done, rest)
        if held:  # the last conversation may go on in the next partition
            yield batch_of([], held)

    return run


def _spans(rows: DataFrame) -> DataFrame:
    """Rows of long conversations, one row per span: conv_id, at (place of its first row) and its rows in order."""
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = rows.select("conv_id", "place", content.alias("content"))
    first = keyed.groupBy("conv_id", "content").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    later = _same(keyed, first, "content").filter("place > first").select("place", F.lit(True).alias("later"))
    row = F.struct("place", "turn", "role", "text", F.coalesce("later", F.lit(False)).alias("later"))
    return rows.join(later, "place", "left").groupBy("conv_id", F.col("span").alias("at")).agg(
        F.sort_array(F.collect_list(row)).alias("rows"))


def _rows_of(cell) -> tuple[list[int | None], list[Row]]:
    turns = [r["turn"] for r in cell]
    return turns, [(r["role"], r["text"], fault_of(r["text"], r["later"])) for r in cell]


_TALLY = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
_SUMMARY = ("conv_id long, at long, " + ", ".join(f"{n} long" for n in _TALLY) + ", first_role string, last_role string, matrix array<long>")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each span, its counts and the costs of passing it from each state to each."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            turns, rows = _rows_of(r["rows"])
            tally = Tally()
            for turn, row in zip(turns, rows, strict=True):
                tally.add(turn, row)
            out.append((r["conv_id"], r["at"], *(getattr(tally, n) for n in _TALLY), tally.first_role, tally.last_role, transfer(rows)))
        types = [pa.int64()] * (2 + len(_TALLY)) + [pa.string(), pa.string(), pa.list_(pa.int64())]
        names = ["conv_id", "at", *_TALLY, "first_role", "last_role", "matrix"]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)


def _behind(table: pa.Table) -> pa.Table:
    """The cost vector behind every span of a conversation, and its counts: the checkpoints of the whole conversation."""
    spans = sorted(table.to_pylist(), key=lambda r: r["at"])
    now, vectors = end_costs(LAST), []
    for r in reversed(spans):
        vectors.append(now)
        now = passed(r["matrix"], now)
    whole = Tally()
    for r in spans:
        whole.join(Tally(*(r[n] for n in _TALLY), r["first_role"], r["last_role"]))
    counts = (whole.gaps, whole.blank, whole.duplicate, whole.truncated, whole.illegal, now[NOTHING])
    rows = [(r["conv_id"], r["at"], list(v), k == 0, k == len(spans) - 1, *counts)
            for k, (r, v) in enumerate(zip(spans, reversed(vectors), strict=True))]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), *[pa.int64()] * 6]
    names = ["conv_id", "at", "behind", "is_first", "is_last", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


_BEHIND = ("conv_id long, at long, behind array<long>, is_first boolean, is_last boolean, gaps long, blank long, duplicate long, "
           "truncated long, illegal long, cost long")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which state the chosen edits of a span lead to from each state."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rows = _rows_of(r["rows"])[1]
            exits = []
            for state in range(4):
                for _, state, _, _ in walk(rows, tuple(r["behind"]), state, False):  # noqa: B020, PLW2901
                    pass
                exits.append(state)
            out.append((r["conv_id"], r["at"], exits))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], pa.list_(pa.int64()))], ["conv_id", "at", "exits"])


def _entries(table: pa.Table) -> pa.Table:
    state, rows = NOTHING, []
    for r in sorted(table.to_pylist(), key=lambda r: r["at"]):
        rows.append((r["conv_id"], r["at"], state))
        state = r["exits"][state]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["conv_id", "at", "entry"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits and the repaired lines of every span."""
    for batch in batches:
        for r in batch.to_pylist():
            edits, lines = [], []
            for edit, _, role, text in walk(_rows_of(r["rows"])[1], tuple(r["behind"]), r["entry"], r["is_last"]):
                edits.append(edit)
                if edit != "D":
                    lines.append(f"{role}:{text}")
            body = "\n".join(lines).encode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["conv_id"]], pa.int64()), pa.array([r["at"]], pa.int64()), pa.array(["".join(edits)]),
                 pa.array([body if lines else None], pa.binary())], ["conv_id", "at", "edits", "body"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one audit and digest a conversation; a piece is let go before the next is read."""
    conv, digest, edits, started = None, Digest(), [], False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.int64()), pa.array(["".join(edits)]), pa.array([digest.state.hexdigest()])],
            ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        for i, _, some, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not started or i != conv:
                if started:
                    yield out()
                conv, digest, edits, started = i, Digest(), [], True
            edits.append(some)
            if body is not None:
                digest.line(body)
    if started:
        yield out()


def _same(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """Inner join on conv_id, NULL included, and further columns; the key is kept once."""
    turned = right.withColumnRenamed("conv_id", "_c").withColumnsRenamed({m: f"_{m}" for m in more})
    met = F.col("conv_id").eqNullSafe(F.col("_c"))
    for m in more:
        met = met & (F.col(m) == F.col(f"_{m}"))
    return left.join(turned, met).drop("_c", *[f"_{m}" for m in more])


def _long(rows: DataFrame) -> DataFrame:
    spans = written(_spans(rows), "repair-spans")
    behind = written(spans.select("conv_id", "at", "rows").mapInArrow(_summaries, _SUMMARY)
                     .groupBy("conv_id").applyInArrow(_behind, _BEHIND), "repair-behind")
    placed = _same(spans, behind.select("conv_id", "at", "behind"), "at")
    entries = placed.select("conv_id", "at", "rows", "behind").mapInArrow(_exits, "conv_id long, at long, exits array<long>").groupBy(
        "conv_id").applyInArrow(_entries, "conv_id long, at long, entry long")
    ready = _same(_same(spans, behind.select("conv_id", "at", "behind", "is_last"), "at"), written(entries, "repair-entries"), "at")
    pieces = ready.select("conv_id", "at", "rows", "behind", "is_last", "entry").mapInArrow(
        _pieces, "conv_id long, at long, edits string, body binary")
    told = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(
        _joined, "conv_id long, audit string, repaired_sha256 string")
    counts = behind.filter("is_first").drop("at", "behind", "is_first", "is_last")
    return _same(counts, told).select(*[n for n, _ in RESULT])


def repaired(rows: DataFrame, span: int = SPAN, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows have conv_id, turn, role and text; others are ignored. A NULL role or text is one space; a NULL conv_id is a conversation
    of its own; NULL turns come first. Rows of one turn are ordered by role and text, and equal rows are interchangeable. Faults, edits and costs:
    see the README. An empty table gives no rows. ``span`` rows, or the row that
    reaches ``span_bytes``, end what a task holds of a conversation.

    Rows are sorted by range, so a conversation of any share of the table lies over many partitions. A conversation within one partition that
    fits one span is repaired in one pass. Of others, every span gives a matrix of costs between states; a pass over one small
    row per span gives the cost vectors behind the spans, the checkpoints; every span is then recomputed from its checkpoint
    and walked forward. Within a span checkpoints lie a square root apart.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" ")).alias(name)

    own = rows.select(F.col("`conv_id`").cast("long").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"), filled("role"), filled("text"))
    # Equal rows are told apart by a stored number, so that range bounds can cut between them.
    numbered = written(own.withColumn("copy", F.monotonically_increasing_id()), "repair-rows")
    order = ["conv_id", "turn", "role", "text", "copy"]
    ordered = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    settled = ordered.select("conv_id", "turn", "role", "text", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
        _first_pass(span, span_bytes), f"{RESULT_TYPE}, place long, span long, turn long, role string, text string")
    first = written(settled, "repair-first")
    names = [n for n, _ in RESULT]
    return first.filter("place IS NULL").select(*names).unionByName(
        _long(first.filter("place IS NOT NULL").select("conv_id", "place", "span", "turn", "role", "text")))


def with_everyone(results: DataFrame, conversations: DataFrame) -> DataFrame:
    """Adds conversations that have no row left: zeros, an empty audit and the digest of the empty text."""
    everyone = conversations.select(F.col("`conv_id`").cast("long").alias("id")).distinct()
    joined = everyone.join(results, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    fill = {"audit": F.lit(""), "repaired_sha256": F.lit(empty)}
    return joined.select(F.col("id").alias("conv_id"), *[
        F.coalesce(n, fill.get(n, F.lit(0).cast("long"))).alias(n) for n, _ in RESULT[1:]])


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that the contract of op13 lays down."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))
    changed = rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, USER).otherwise(F.col("role")).alias("role"), text.alias("text"), "kind")
    times = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changed.select("conv_id", "turn", "role", "text", F.explode(times).alias("time")).drop("time")
