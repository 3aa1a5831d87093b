"""Conversation structure repair: the cheapest edits by a bidirectional Dijkstra search over an edit lattice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, Scratch
from tidemark.session import session_settings

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: Messages of a conversation that one search spans; longer conversations are searched block by block.
BLOCK_ROWS = 256
#: Texts go to Python in batches of so many rows.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000}

# What was written so far: nothing, the system message, a user message last, an assistant message last.
START, SYSTEM, USER, ASSISTANT = range(4)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_KEEPS = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
_TURNS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
#: The inserts that end a conversation from each state: ``(s?(ua)+)?`` must be whole.
TAILS = {START: "", SYSTEM: INSERT * 2, USER: INSERT, ASSISTANT: ""}

# A step of the lattice: (must it be deleted, initial of its role, is its text truncated).
Step = tuple[bool, str, bool]


def _edges_out(steps: Sequence[Step], place: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """(place, state, cost, edit) of every edit that can follow."""
    yield place, _TURNS[state], COST[INSERT], INSERT
    if place < len(steps):
        forced, initial, truncated = steps[place]
        yield place + 1, state, COST[DELETE], DELETE
        if not forced:
            more = TRUNCATED_COST if truncated else 0
            yield place + 1, _TURNS[state], COST[REROLE] + more, REROLE
            if (state, initial) in _KEEPS:
                yield place + 1, _KEEPS[state, initial], COST[KEEP] + more, KEEP


def _edges_in(steps: Sequence[Step], place: int, state: int) -> Iterator[tuple[int, int, int, str]]:
    """(place, state, cost, edit) of every edit that can lead here."""
    for before, after in _TURNS.items():
        if after == state:
            yield place, before, COST[INSERT], INSERT
    if place > 0:
        forced, initial, truncated = steps[place - 1]
        yield place - 1, state, COST[DELETE], DELETE
        if not forced:
            more = TRUNCATED_COST if truncated else 0
            for before in range(4):
                if _TURNS[before] == state:
                    yield place - 1, before, COST[REROLE] + more, REROLE
                if _KEEPS.get((before, initial)) == state:
                    yield place - 1, before, COST[KEEP] + more, KEEP


def _goals(steps: Sequence[Step], exit_state: int, closed: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """Goals of a search with the cost and the edits that are due there.

    A closed block ends the conversation, in any state whose tail is added. An open one ends with the
    edit of its last row, so that inserts between two blocks belong to the later one.
    """
    if closed:
        return {(len(steps), state): (COST[INSERT] * len(tail), tail) for state, tail in TAILS.items()}
    goals: dict[tuple[int, int], tuple[int, str]] = {}
    for place, state, cost, edit in _edges_in(steps, len(steps), exit_state):
        if edit != INSERT:
            goals[place, state] = min(goals.get((place, state), (cost, edit)), (cost, edit))
    return goals


def search(steps: Sequence[Step], entry: int, exit_state: int = START, closed: bool = True) -> tuple[int, str] | None:
    """Cost and ASCII-least audit of the cheapest edits from ``entry`` to the goal, or None if there are none.

    A forward heap grows from the entry, a reverse heap from the goals. They stop once the sum of their
    least costs is above the best crossing found, so every crossing of that cost is settled on both
    sides; of those, the least concatenated audit is taken. Heaps are ordered by (cost, rows passed),
    as the only edit without cost passes a row: a node is popped after all that its audit depends on.
    No audit of a node is a proper beginning of another one of equal cost, so least parts make the least whole.
    """
    if not steps and not closed:
        return (0, "") if entry == exit_state else None
    begin = (0, entry)
    goals = _goals(steps, exit_state, closed)
    ahead: dict[tuple[int, int], tuple[int, str]] = {begin: (0, "")}
    behind = dict(goals)
    forward, reverse = [(0, 0, entry)], []
    for (place, state), (cost, _) in goals.items():
        heappush(reverse, (cost, -place, state))
    settled: set[tuple[int, int]] = set()
    closed_behind: set[tuple[int, int]] = set()
    best: int | None = None
    while forward or reverse:
        least_ahead = forward[0][0] if forward else None
        least_behind = reverse[0][0] if reverse else None
        if best is not None and (least_ahead is None or least_behind is None or least_ahead + least_behind > best):
            break
        if least_behind is None or (least_ahead is not None and least_ahead <= least_behind):
            cost, place, state = heappop(forward)
            if (place, state) in settled:
                continue
            settled.add((place, state))
            audit = ahead[place, state][1]
            for to, after, step, edit in _edges_out(steps, place, state):
                label = (cost + step, audit + edit)
                if (to, after) not in ahead or label < ahead[to, after]:
                    if (to, after) not in ahead or label[0] < ahead[to, after][0]:
                        heappush(forward, (label[0], to, after))
                    ahead[to, after] = label
            met = behind.get((place, state))
        else:
            cost, place, state = heappop(reverse)
            place = -place
            if (place, state) in closed_behind:
                continue
            closed_behind.add((place, state))
            audit = behind[place, state][1]
            for to, before, step, edit in _edges_in(steps, place, state):
                label = (cost + step, edit + audit)
                if (to, before) not in behind or label < behind[to, before]:
                    if (to, before) not in behind or label[0] < behind[to, before][0]:
                        heappush(reverse, (label[0], -to, before))
                    behind[to, before] = label
            met = ahead.get((place, state))
        if met is not None and (best is None or cost + met[0] < best):
            best = cost + met[0]
    if best is None:
        return None
    audits = []
    for node in settled:
        cost, audit = ahead[node]
        if node in goals and cost + goals[node][0] == best:
            audits.append(audit + goals[node][1])
        for to, after, step, edit in _edges_out(steps, *node):
            if (to, after) in closed_behind and cost + step + behind[to, after][0] == best:
                audits.append(audit + edit + behind[to, after][1])
    if begin in closed_behind and behind[begin][0] == best:
        audits.append(behind[begin][1])
    return best, min(audits)


def segments(steps: Sequence[Step], opens: bool, closes: bool) -> list[tuple[int, int, int, int, str]]:
    """(entry, exit, cost, rank, audit) of a block for every pair of states at its two ends.

    ``rank`` orders the audits of the block; equal audits share one. A block that opens the
    conversation starts with nothing written, one that closes it has the single exit ``START``.
    """
    found = []
    for entry in (START,) if opens else range(4):
        for exit_state in (START,) if closes else range(4):
            result = search(steps, entry, exit_state, closes)
            if result is not None:
                found.append((entry, exit_state, *result))
    rank = {audit: at for at, audit in enumerate(sorted({audit for *_, audit in found}))}
    return [(entry, exit_state, cost, rank[audit], audit) for entry, exit_state, cost, audit in found]


def choose(blocks: Sequence[Sequence[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """Entry and exit of each block on the cheapest way through all, of the least ranks from the first block on.

    The audits of a block from one entry are no beginnings of one another, so ranks block by block order whole
    audits, and from the one first entry an audit fixes the states between.
    """
    costs: list[dict[int, int]] = [{START: 0}]  # after the last block: what is still to pay
    for block in reversed(blocks):
        due: dict[int, int] = {}
        for entry, exit_state, cost, _ in block:
            if exit_state in costs[-1]:
                total = cost + costs[-1][exit_state]
                due[entry] = min(due.get(entry, total), total)
        costs.append(due)
    costs.reverse()
    state, chosen = START, []
    for at, block in enumerate(blocks):
        _, exit_state = min(
            (rank, exit_state)
            for entry, exit_state, cost, rank in block
            if entry == state and exit_state in costs[at + 1] and cost + costs[at + 1][exit_state] == costs[at][state]
        )
        chosen.append((state, exit_state))
        state = exit_state
    return chosen


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: conv_id, turn, role, text and ``copies``, how often the row is there.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (0 copies), 1 empties its text, 2 removes its sentence
    ends, 3 repeats it, 4 makes it the user's. Nulls in the key, the role and the text are one space.
    """
    code = F.crc32(
        F.concat_ws(
            ":",
            F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
            F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
        )
    )
    text = F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", "role", text.alias("text"), (code % 20).alias("code")).select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("code") == 1, "")
        .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def marked_rows(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Equal rows as one with their number, each with its first fault: blank, duplicate, truncated or null.

    Both steps are aggregates with a map-side part, so equal messages collapse before they meet, and the
    join that brings the first turn of a message back can be split by adaptive execution.
    """
    own = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    single = own.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (
        own.filter("copies > 0")
        .groupBy("conv_id", "role", F.md5("text").alias("text_md5"))
        .agg(F.min(turn).alias("first"))
        .select(
            F.col("conv_id").alias("first_conv"), F.col("role").alias("first_role"), "text_md5", F.col("first.turn").alias("first_turn")
        )
    )
    met = single.join(
        first,
        F.col("conv_id").eqNullSafe(F.col("first_conv"))
        & (F.col("role") == F.col("first_role"))
        & (F.md5("text") == F.col("text_md5")),
        "left",
    )
    trimmed = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(~F.col("turn").eqNullSafe(F.col("first_turn")), "duplicate")
        .when(~F.substring(trimmed, -1, 1).rlike("[.!?]"), "truncated")
    )
    return met.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def _steps_of(role: str, fault: str | None, copies: int) -> list[Step]:
    """The lattice steps of equal rows: all but the first are duplicates and share one step."""
    if copies == 0:
        return []
    if fault in ("blank", "duplicate"):
        return [(True, "", False)]
    own = (False, role[:1], fault == "truncated")
    return [own] if copies == 1 else [own, (True, "", False)]


_ROW = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("place", pa.int64()),
    ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()), ("fault", pa.string()),
    ("segments", pa.list_(pa.struct([
        ("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string()),
    ]))),
])
_ROW_SQL = (
    "conv_id bigint, part bigint, block bigint, place bigint, turn bigint, role string, text string, copies bigint, "
    "fault string, segments array<struct<entry: int, exit: int, cost: bigint, rank: int, audit: string>>"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _written(rows: Iterator[tuple], schema: pa.Schema, most_chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += 100 + sum(len(value) for value in row if isinstance(value, str))
        if chars >= most_chars:
            yield _columns(held, schema)
            held, chars = [], 0
    if held:
        yield _columns(held, schema)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
    )


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sorted rows cut into blocks, each headed by a row (place -1) with the segments of its search.

    Rows are dealt by ranges of conversation, turn, role and the first letters of the text, so a very long
    conversation is searched by many tasks. A task holds the steps of one block, not its texts.
    """
    key = ["conv_id", "turn", "role", F.substring("text", 1, 32)]
    ordered = rows.select("conv_id", "turn", "role", "text", "copies", "fault").repartitionByRange(*key)
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def cut() -> Iterator[tuple]:
            block, conv, place, opens = -1, (), 0, False
            steps: list[Step] = []
            first = True

            def head(closes: bool) -> tuple:
                found = segments(steps, opens, closes)
                names = ("entry", "exit", "cost", "rank", "audit")
                return (*conv, part, block, -1, None, None, None, None, None, [dict(zip(names, one, strict=True)) for one in found])

            for conv_id, turn, role, text, copies, fault in _read(batches):
                if conv != (conv_id,) or place >= block_rows:
                    if conv:
                        yield head(conv != (conv_id,))
                    # the first conversation of a task may have begun in the task before
                    opens = conv != (conv_id,) and not first
                    block, conv, place, steps, first = block + 1, (conv_id,), 0, [], False
                steps += _steps_of(role, fault, copies)
                yield conv_id, part, block, place, turn, role, text, copies, fault, None
                place += 1
            if conv:  # it may go on in the next task
                yield head(False)

        yield from _written(cut(), _ROW)

    return ordered.mapInArrow(run, _ROW_SQL)


def _chosen(heads: DataFrame) -> DataFrame:
    """(part, block, audit, cost) of the segment that the cheapest way through its conversation takes."""
    lean = F.transform("segments", lambda one: F.struct(one["entry"], one["exit"], one["cost"], one["rank"]))
    ordered = (
        heads.select("conv_id", "part", "block", lean.alias("lean"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block")
    )
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ways() -> Iterator[tuple]:
            conv: tuple = ()
            keys: list[tuple] = []
            blocks: list[list[tuple]] = []
            for conv_id, part, block, lean in _read(batches):
                if conv != (conv_id,):
                    yield from finish(keys, blocks)
                    conv, keys, blocks = (conv_id,), [], []
                keys.append((part, block))
                blocks.append([tuple(one.values()) for one in lean])
            yield from finish(keys, blocks)

        def finish(keys: list[tuple], blocks: list[list[tuple]]) -> Iterator[tuple]:
            if not keys:
                return
            if all(entry == START for entry, *_ in blocks[0]) and len(keys) == 1 and len(blocks[0]) == 1:
                yield (*keys[0], *blocks[0][0][:2])
                return
            blocks = [*blocks, [(state, START, COST[INSERT] * len(tail), 0) for state, tail in TAILS.items()]]
            for key, (entry, exit_state) in zip(keys, choose(blocks), strict=False):
                yield (*key, entry, exit_state)

        yield from _written(ways(), schema)

    ways = ordered.mapInArrow(run, "part bigint, block bigint, entry int, exit int")
    one = F.filter("segments", lambda s: (s["entry"] == F.col("entry")) & (s["exit"] == F.col("exit")))[0]
    return (
        heads.join(ways, ["part", "block"])
        .withColumn("one", one)
        .select("conv_id", "part", "block", F.col("one.audit").alias("audit"), F.col("one.cost").alias("cost"))
    )


def repair_edits(spark: SparkSession, rows: DataFrame, copies: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The edit of every message: conv_id, part, block, place, turn, role, text, copies, fault, audit, cost.

    Rows of ``place`` -1 head a block and carry its part of the audit; the others are messages in order.
    """
    scratch = Scratch(spark, "repair")
    with session_settings(spark, BATCHES):
        marked = scratch.write(marked_rows(rows, copies))
        ordered = scratch.write(blocks_of(marked, block_rows))
        scratch.drop(marked)
        heads = scratch.write(_chosen(scratch.again(ordered).filter("place = -1")))
    names = ("turn", "role", "text", "copies", "fault")
    messages = ordered.filter("place >= 0").select(
        "conv_id", "part", "block", "place", *names, F.lit(None).cast("string").alias("audit"), F.lit(None).cast("long").alias("cost")
    )
    empty = [F.lit(None).cast(messages.schema[name].dataType).alias(name) for name in names]
    return messages.unionByName(heads.select("conv_id", "part", "block", F.lit(-1).cast("long").alias("place"), *empty, "audit", "cost"))


class _Conversation:
    """Running totals and the repaired text of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.rows = self.turns = 0
        self.least = self.most = None
        self.audit: list[str] = []
        self.state, self.initial = START, None
        self.written, self.digest = False, hashlib.sha256()
        self.edits: Iterator[str] = iter(())

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{'\n' if self.written else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written = True

    def insert(self) -> None:
        self.state = _TURNS[self.state]
        self.put(_ROLES[self.state], "")
        self.audit.append(INSERT)

    def head(self, audit: str, cost: int) -> None:
        self.edits = iter(audit)
        self.cost += cost

    def next_edit(self) -> str:
        for edit in self.edits:
            if edit != INSERT:
                return edit
            self.insert()
        raise ValueError("an audit ends before its rows")

    def delete(self, copies: int) -> None:
        """Equal rows are one step of the search, which has paid for one of them."""
        self.audit.append(self.next_edit() * copies)
        self.cost += COST[DELETE] * (copies - 1)

    def message(self, turn: int | None, role: str, text: str, copies: int, fault: str | None) -> None:
        if copies == 0:
            return
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1
        self.initial = initial
        self.rows += copies
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        if fault in ("blank", "duplicate"):
            self.counts[fault] += copies
            self.delete(copies)
            return
        self.counts["truncated"] += fault == "truncated"
        edit = self.next_edit()
        self.audit.append(edit)
        if edit == KEEP:
            self.state = _KEEPS[self.state, initial]
            self.put(role, text)
        elif edit == REROLE:
            self.state = _TURNS[self.state]
            self.put(_ROLES[self.state], text)
        if copies > 1:
            self.counts["duplicate"] += copies - 1
            self.delete(copies - 1)

    def result(self) -> tuple:
        for _ in self.edits:  # inserts after the last row of a block that closes
            self.insert()
        for _ in TAILS[self.state]:
            self.insert()
            self.cost += COST[INSERT]
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.conv_id, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest(),
        )


_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired_sha256", pa.string()),
])
_RESULT_SQL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def repair_conversations(
    spark: SparkSession, rows: DataFrame, copies: Column | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per conversation: faults, the cheapest edits and a digest of what they leave.

    ``rows`` has conv_id, turn, role, text; ``copies`` may say how often a row is there, 0 being a row that was
    dropped but whose conversation is returned. Rows are taken by turn, nulls first, those of one turn by role and
    text. The first fault of a row counts: blank, duplicate (role and text seen earlier), truncated (the last
    character that is no space is none of ``.!?``). Keep costs 0, rerole and insert 3, delete 4 (required for blank and
    duplicate rows), and a truncated row that stays 3 more; roles must end as ``(s?(ua)+)?``. Of the
    cheapest edits the ASCII-least audit is taken.

    Null roles and texts are one space, so such a text is blank; an empty role does not stay. A null id is a conversation of its own. Other columns
    are ignored. Repeated rows are one step of the search. No rows give no conversations; a conversation
    without rows has zeros, an empty audit and the digest of nothing.

    Searches run in blocks of ``block_rows`` rows over many tasks, with the cheapest way from every state to every
    other; a fold over the blocks, a few numbers each, chooses among them. Only the digest, a sequential hash,
    reads a conversation in one task, message by message.
    """
    ordered = (
        repair_edits(spark, rows, copies, block_rows)
        .select("conv_id", "part", "block", "place", "turn", "role", "text", "copies", "fault", "audit", "cost")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "block", "place")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def totals() -> Iterator[tuple]:
            current: _Conversation | None = None
            for row in _read(batches):
                conv_id, _, _, place, turn, role, text, copies, fault, audit, cost = row
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        yield current.result()
                    current = _Conversation(conv_id)
                if place == -1:
                    current.head(audit, cost)
                else:
                    current.message(turn, role, text, copies, fault)
            if current is not None:
                yield current.result()

        yield from _written(totals(), _RESULT)

    with session_settings(spark, BATCHES):
        return Scratch(spark, "repaired").write(ordered.mapInArrow(run, _RESULT_SQL))


def _add(label: str, cost: int, edit: str) -> str:
    """SQL of a label (12 digits of cost, then the audit) with one edit more; null stays null."""
    return f"(printf('%012d', left({label}, 12)::BIGINT + {cost}) || substr({label}, 13) || '{edit}')"


def oracle_sql() -> str:
    """DuckDB SQL of the damage and the repair: the least label of each state, row after row."""
    ins = {state: _add(state, COST[INSERT], INSERT) for state in ("z", "s", "u", "a", "u1", "a1")}
    stays = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"

    def kept(label: str, initial: str) -> str:
        return f"CASE WHEN free AND initial = '{initial}' THEN {_add(label, stays, KEEP)} END"

    def reroled(label: str) -> str:
        return f"CASE WHEN free THEN {_add(label, f'3 + {stays}', REROLE)} END"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(b))),
coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 20 AS code
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, range(2) copy(n) WHERE code <> 0 AND (n = 0 OR code = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS initial, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM ordered),
steps AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS free FROM faults),
way AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, '000000000000' AS z, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM ordered
  UNION ALL
  SELECT conv_id, pos, {_add("z", 4, DELETE)}, least({_add("s", 4, DELETE)}, {kept("z", "s")}),
    least({_add("u2", 4, DELETE)}, {kept("z", "u")}, {kept("s", "u")}, {kept("a1", "u")}, {reroled("z")}, {reroled("s")}, {reroled("a1")}),
    least({_add("a1", 4, DELETE)}, {kept("u2", "a")}, {reroled("u2")})
  FROM (
    SELECT *, least(u1, {ins["a1"]}) AS u2 FROM (
      SELECT *, least(a, {ins["u1"]}) AS a1 FROM (
        SELECT w.z, w.s, w.a, least(w.u, {ins["z"].replace("z,", "w.z,")}, {ins["s"].replace("s,", "w.s,")}, {ins["a"].replace("a,", "w.a,")}) AS u1,
          r.conv_id, r.pos, r.initial, r.fault, r.free
        FROM way w JOIN steps r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1)))),
ends AS (
  SELECT conv_id, least(z, a, {ins["u"]}, {_add(ins["z"], 3, INSERT)}, {_add(ins["s"], 3, INSERT)}) AS label
  FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
edits AS (
  SELECT conv_id, n, edit, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY n) AS pos
  FROM (SELECT conv_id, unnest(string_split(substr(label, 13), '')) AS edit,
    unnest(range(length(label) - 12)) AS n FROM ends)),
written AS (
  SELECT e.conv_id, e.n, e.edit, r.role, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY e.n) AS nth,
    max(CASE WHEN e.edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
  FROM edits e LEFT JOIN steps r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.pos WHERE e.edit <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY n) AS repaired FROM written GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM steps GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(label, 12)::BIGINT, 0) AS cost,
  coalesce(substr(label, 13), '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""
