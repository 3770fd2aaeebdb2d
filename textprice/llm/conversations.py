"""Repair of conversations: the cheapest edits that give turns in the order ``(system? (user assistant)+)?``.

Faults.  A row is blank (no character but white space ``[\\x20\\x09-\\x0D]``), else a duplicate (its role and text
stand in an earlier row of the conversation), else truncated (its last such character is none of ``.!?``).
Edits of rows, by their initials: Keep (free), Rerole to user or assistant (1), Delete (2; must be for blank
rows and duplicates), and Insert of an empty user or assistant row anywhere (5); a truncated row that is not deleted
costs 5 more.  The initials of the roles that result must read ``(s?(ua)+)?``.  Of cheapest edits the string of
initials that is least in ASCII is taken.

Method (secondary-sorted streams, dynamic programming).

1. Duplicates are found by a window over (conversation, role, SHA-256 of the text), on narrow rows.
2. The narrow rows go to their conversation's task sorted from the last to the first.  A stream over Arrow
   batches carries the costs to go from the four states (nothing, system, user, assistant), whose differences are
   bounded, so that a step is a lookup.  Each row leaves one byte: the least cheapest edit in each state.  These
   backpointers leave the task in blocks of ``BLOCK`` rows, so a giant conversation never gathers there.
3. Blocks and full rows meet again, sorted: a conversation's blocks, from its first row on, then its rows by
   turn.  The second stream reads rows against their bytes and makes the result as it goes.

Texts cross one exchange and are never gathered; a task holds of a conversation one byte and one edit a row, which
the result (``audit``) holds as well.  A conversation is one task's work in step 2 and 3, as streams.

Rows are taken by turn, nulls first; rows of one turn by role and SHA-256 of the text.

Results for special inputs: null role or text is one space, so a null text is blank and a null role neither s,
u nor a; null conversations are one conversation; repeated rows are duplicates; the least letter counts of a role, so
any role in ``u`` can be kept as user's; a very long text is hashed as it passes; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted

BLOCK = 1 << 20  # rows of one block of backpointers
DELETE, RENAME, INSERT, CUT = 2, 1, 5, 5  # costs
EDITS = "DIKR"  # by number, in ASCII order
NONE, SYSTEM, USER, ASSISTANT = range(4)  # the last role that was put out
NEXT = (USER, USER, ASSISTANT, USER)  # state after one more user or assistant row
GIVEN = {USER: "user", ASSISTANT: "assistant"}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
END = (0, 2 * INSERT, INSERT, 0)  # cost after the last row
LEGAL = {"su", "ua", "au"}


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a row of that initial, if it may be kept there."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


@lru_cache(maxsize=1 << 14)
def step(costs: tuple, initial: str, fault: int):
    """One row more, before those that ``costs`` to go are for: (costs, what was taken off them, the row's byte)."""
    ways = []
    for state in range(4):
        own = {0: DELETE + costs[state]}
        if fault in (SOUND, TRUNCATED):
            more = CUT if fault == TRUNCATED else 0
            after = kept_state(state, initial)
            if after is not None:
                own[2] = more + costs[after]
            own[3] = more + RENAME + costs[NEXT[state]]
        ways.append(own)
    best = [min(own.values()) for own in ways]
    for _ in range(3):  # inserts before the row, one after another
        best = [min(best[s], INSERT + best[NEXT[s]]) for s in range(4)]
    byte = 0
    for state, own in enumerate(ways):
        own[1] = INSERT + best[NEXT[state]]
        byte |= min(e for e, c in own.items() if c == best[state]) << 2 * state
    low = min(best)
    return tuple(c - low for c in best), low, byte


class Costs:
    """A conversation read from its last row: costs to go, counts of faults, backpointers not yet sent."""

    def __init__(self, conv):
        self.conv, self.costs, self.base, self.bytes, self.block = conv, END, 0, bytearray(), 0
        self.faults, self.illegal, self.later = [0] * 4, 0, None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, initial: str, fault: int) -> None:
        self.costs, low, byte = step(self.costs, initial if initial in "sua" else "", fault)
        self.base += low
        self.bytes.append(byte)
        self.faults[fault] += 1
        if self.later is not None and initial + self.later not in LEGAL:
            self.illegal += 1
        self.later = initial
        if turn is not None and turn != self.first:
            self.turns += 1
            self.last = turn if self.last is None else self.last
            self.first = turn

    def facts(self) -> list[int]:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return [gaps, *self.faults[1:], self.illegal, self.base + self.costs[NONE]]


def backpointers(narrow: DataFrame, conv_type) -> DataFrame:
    """(conv, block, choices, facts) from (conv, turn, initial, fault) sorted from the last row to the first: the bytes
    of each block of rows, first row first, blocks numbered from the end; the first rows' block has the facts."""
    spec = T.StructType([T.StructField("conv", conv_type), T.StructField("block", T.LongType()),
                         T.StructField("choices", T.BinaryType()), T.StructField("facts", T.ArrayType(T.LongType()))])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, out, size = to_arrow_schema(spec), [], 0

        def close(c: Costs, facts):
            out.append({"conv": c.conv, "block": c.block, "choices": bytes(c.bytes[::-1]), "facts": facts})
            c.block, c.bytes = c.block + 1, bytearray()
            return len(out[-1]["choices"]) + 64

        now = None
        for batch in batches:
            for conv, turn, initial, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        size += close(now, now.facts())
                    now = Costs(conv)
                elif len(now.bytes) >= BLOCK:
                    size += close(now, None)
                now.add(turn, initial, fault)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out.clear()
                    size = 0
        if now is not None:
            close(now, now.facts())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return narrow.mapInArrow(run, spec)


class Repair:
    """A conversation read from its first row against its backpointers."""

    def __init__(self, conv):
        from collections import deque
        from hashlib import sha256
        self.conv, self.state, self.audit, self.blocks, self.at, self.facts = conv, NONE, bytearray(), deque(), 0, None
        self.sha, self.lines = sha256(), 0

    def put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def insert(self):
        self.audit.append(ord("I"))
        self.state = NEXT[self.state]
        self.put(GIVEN[self.state], "")
        return GIVEN[self.state], "", "I"

    def row(self, role: str, text: str):
        """The rows put out for one row: (role, text, edit)."""
        if self.at >= len(self.blocks[0]):
            self.blocks.popleft()
            self.at = 0
        byte, self.at = self.blocks[0][self.at], self.at + 1
        out = []
        while (edit := byte >> 2 * self.state & 3) == 1:
            out.append(self.insert())
        self.audit.append(ord(EDITS[edit]))
        if edit == 2:
            self.state = kept_state(self.state, role[:1])
        elif edit == 3:
            self.state = NEXT[self.state]
            role = GIVEN[self.state]
        if edit:
            self.put(role, text)
            out.append((role, text, EDITS[edit]))
        return out

    def rest(self):
        out = []
        while self.state in (SYSTEM, USER):
            out.append(self.insert())
        return out


def sorted_streams(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Backpointers and rows in one table, each conversation's together: its blocks from the first row on, then
    its rows by turn.  (conv, choices, facts, role, text)."""
    space = F.lit(" ")
    rows = rows.select(quoted(conv).alias("conv"), quoted(turn).alias("turn"), F.coalesce(quoted(role), space).alias("role"),
                       F.coalesce(quoted(text), space).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    narrow = rows.select("conv", "turn", "role", "digest", (bare == "").alias("blank"),
                         (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    again = F.row_number().over(Window.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = (F.when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND))
    narrow = (narrow.withColumn("again", again).repartition("conv")
              .sortWithinPartitions(F.desc("conv"), F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"), F.desc("again"))
              .select("conv", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")))
    blocks = backpointers(narrow, rows.schema["conv"].dataType)
    return (blocks.withColumn("block", -F.col("block")).unionByName(rows, allowMissingColumns=True)
            .repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("block"), F.asc_nulls_first("turn"), "role", "digest")
            .select("conv", "choices", "facts", "role", "text"))


def read_along(batches, on_row, on_end):
    """Go through the streams' table; ``on_row(repair, put_out)`` and ``on_end(repair, put_out)``."""
    now = None
    for batch in batches:
        for conv, choices, facts, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    on_end(now, now.rest())
                now = Repair(conv)
            if choices is not None:
                now.blocks.append(choices)
                now.facts = now.facts or facts
            else:
                on_row(now, now.row(role, text))
        yield
    if now is not None:
        on_end(now, now.rest())
    yield


def repair_report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    streams = sorted_streams(rows, conv, turn, role, text)
    spec = T.StructType([T.StructField("conv", streams.schema["conv"].dataType), *[T.StructField(n, T.LongType()) for n in FACTS],
                         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, out = to_arrow_schema(spec), []

        def end(c: Repair, _):
            out.append({"conv": c.conv, **dict(zip(FACTS, c.facts, strict=True)), "audit": c.audit.decode(),
                        "repaired_sha256": c.sha.hexdigest()})

        for _ in read_along(batches, lambda c, put: None, end):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

    return streams.mapInArrow(run, spec).withColumnRenamed("conv", conv)


def repaired_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: ``conv``, position (from 0), ``role``, ``text`` and the edit (K, R or I) of each row."""
    streams = sorted_streams(rows, conv, turn, role, text)
    spec = T.StructType([T.StructField("conv", streams.schema["conv"].dataType), T.StructField("position", T.LongType()),
                         T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("edit", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, out = to_arrow_schema(spec), []

        def rows_out(c: Repair, put):
            for i, (r, t, e) in enumerate(put, start=c.lines - len(put)):
                out.append({"conv": c.conv, "position": i, "role": r, "text": t, "edit": e})

        for _ in read_along(batches, rows_out, rows_out):
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

    return streams.mapInArrow(run, spec).withColumnsRenamed({"conv": conv, "role": role, "text": text})


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    ``.!?`` out, 3 repeats it, 4 makes its role user.  Null columns are one space (role and text stay so)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(quoted(conv).cast("string"), space), F.lit(":"), F.coalesce(quoted(turn).cast("string"), space))
    rows = rows.select(quoted(conv).alias(conv), quoted(turn).alias(turn), F.coalesce(quoted(role), space).alias(role),
                       F.coalesce(quoted(text), space).alias(text), (F.crc32(key.cast("binary")) % 20).alias("_fault"))
    f = F.col("_fault")
    times = F.explode(F.when(f == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.where(f != 0)
            .withColumn(text, F.when(f == 1, "").when(f == 2, F.regexp_replace(quoted(text), "[.!?]", "")).otherwise(quoted(text)))
            .withColumn(role, F.when(f == 4, "user").otherwise(quoted(role)))
            .withColumn("_again", times).drop("_fault", "_again"))
