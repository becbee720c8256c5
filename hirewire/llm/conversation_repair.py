"""Conversation structure repair: the cheapest edits that make roles alternate (target alignment).

A repaired conversation has role initials (s?(ua)+)?: empty, or an optional system turn and then pairs of a user and an
assistant turn. Its length fixes it, so each feasible length is one target string, and Wagner-Fischer aligns the turns
to it. Column k of the matrix stands for the last k symbols of a target, which are the same in every longer one: one matrix
serves all feasible lengths. Cells further from the diagonal than the incumbent cost allows are left out (Ukkonen's band);
if nothing within the incumbent is found it is doubled. The audits of all cheapest lengths are traced back and the ASCII-least one counts.

Conversations of more than ``WRITTEN_OUT`` turns are aligned to the grammar's cycle instead: columns that are two apart
have the same symbol and are merged, which is exact as well and takes time and memory in proportion to the turns.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant turn 5; a truncated turn that
isn't deleted costs 5 more; blank turns and duplicates must be deleted.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirewire.llm.common import small_batches, written

# What edits cost, white space, sentence ends and the role initials that may follow each other.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}

WRITTEN_OUT = 1024  # turns up to which targets are written out
NEVER = 1 << 60
DEAD = "d"  # a turn that must go; others are their initial (x: none that may be kept), as a capital if truncated
NAMES = {"u": "user", "a": "assistant"}


def _use(turn: str, symbol: str) -> int:
    """The cost of a turn in the place of a user or assistant symbol."""
    if turn == DEAD:
        return NEVER
    return (TRUNCATED if turn.isupper() else 0) + (0 if turn.lower() == symbol else REROLE)


def _symbol(left: int) -> str:
    """The target's symbol when ``left`` symbols are to come, it included."""
    return "a" if left % 2 else "u"


class Matrix:
    """Suffix costs within a band: ``at(i, k)`` aligns turns i, i + 1 ... to the last k symbols of a target."""

    def __init__(self, turns: str, incumbent: int):
        n = len(turns)
        self.turns, self.low, self.rows = turns, [0] * (n + 1), [[]] * (n + 1)
        self.fewer, self.more = incumbent // DELETE, incumbent // INSERT
        for i in range(n, -1, -1):
            low, row = max(0, n - i - self.fewer), []
            self.low[i] = low
            for k in range(low, n - i + self.more + 1):
                if i == n:
                    row.append(INSERT * k)
                    continue
                best = DELETE + self.at(i + 1, k)
                if k:
                    if row and (c := INSERT + row[-1]) < best:
                        best = c
                    if (c := _use(turns[i], _symbol(k)) + self.at(i + 1, k - 1)) < best:
                        best = c
                row.append(best)
            self.rows[i] = row

    def at(self, i: int, k: int) -> int:
        j = k - self.low[i]
        return self.rows[i][j] if 0 <= j < len(self.rows[i]) else NEVER

    def trace(self, i: int, k: int) -> str:
        """The ASCII-least of the cheapest audits: D before I before K before R wherever the cost allows it."""
        out, n = [], len(self.turns)
        while i < n or k:
            cost = self.at(i, k)
            if i < n and DELETE + self.at(i + 1, k) == cost:
                out.append("D")
                i += 1
            elif k and INSERT + self.at(i, k - 1) == cost:
                out.append("I")
                k -= 1
            else:
                out.append("K" if self.turns[i].lower() == _symbol(k) else "R")
                i, k = i + 1, k - 1
        return "".join(out)


def _written_out(turns: str) -> tuple[int, str]:
    """By targets: (cost, audit)."""
    n, incumbent = len(turns), DELETE * turns.count(DEAD) + 2
    while True:
        m = Matrix(turns, incumbent)
        lengths = range(n + m.more + 1)
        # (cost, turns deleted before a kept system turn or -1, symbols after it)
        found = [(m.at(0, k), -1, k) for k in lengths if k % 2 == 0]
        for i, turn in enumerate(turns):
            if turn in "sS" and DELETE * i <= incumbent:
                head = DELETE * i + (TRUNCATED if turn == "S" else 0)
                found += [(head + m.at(i + 1, k), i, k) for k in lengths if k and k % 2 == 0]
        cost = min(c for c, _, _ in found)
        if cost <= incumbent:  # whatever costs no more lies within the band, ties included
            return cost, min(m.trace(0, k) if i < 0 else "D" * i + "K" + m.trace(i + 1, k) for c, i, k in found if c == cost)
        incumbent *= 2


#: After (nothing, s, u, a): the symbol that comes next, and the state after it.
NEXT, AFTER = "uuau", (2, 2, 3, 2)


def _folded(turns: str) -> tuple[int, str]:
    """By the grammar's cycle: (cost, audit), in time and memory in proportion to the turns."""
    n = len(turns)
    left = [array("q", bytes(8 * (n + 1))) for _ in range(4)]  # the cost still to come in each state
    step = [0, 2 * INSERT, INSERT, 0]
    for i in range(n, -1, -1):
        if i < n:
            turn, after = turns[i], step
            step = [min(DELETE + after[e], _use(turn, NEXT[e]) + after[AFTER[e]]) for e in range(4)]
            if turn in "sS":
                step[0] = min(step[0], (TRUNCATED if turn == "S" else 0) + after[1])
            step[2], step[3] = min(step[2], INSERT + step[3]), min(step[3], INSERT + step[2])
            step[0], step[1] = min(step[0], INSERT + step[2]), min(step[1], INSERT + step[2])
        for e in range(4):
            left[e][i] = step[e]
    cost, i, e, out = left[0][0], 0, 0, []
    while i < n or left[e][i]:
        now = left[e][i]
        if i < n and DELETE + left[e][i + 1] == now:
            out.append("D")
            i += 1
        elif INSERT + left[AFTER[e]][i] == now:
            out.append("I")
            e = AFTER[e]
        else:
            turn = turns[i]
            if e == 0 and turn in "sS" and (TRUNCATED if turn == "S" else 0) + left[1][i + 1] == now:
                out.append("K")
                e = 1
            else:
                out.append("K" if turn.lower() == NEXT[e] else "R")
                e = AFTER[e]
            i += 1
    return cost, "".join(out)


@lru_cache(maxsize=1 << 14)
def _short(turns: str) -> tuple[int, str]:
    return _written_out(turns)


def cheapest(turns: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation, a character for each turn; ties: the ASCII-least audit."""
    return _short(turns) if len(turns) <= 16 else _written_out(turns) if len(turns) <= WRITTEN_OUT else _folded(turns)


# --- over tables ----------------------------------------------------------------------

AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: Column | None) -> DataFrame:
    """conv, turn, role, text, same (a digest of role and text) and gone, under names of our own. Nulls in role and text
    are one space."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    cols = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"),
                     (F.lit(False) if gone is None else gone).alias("gone"))
    return cols.withColumn("same", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))


ORDER = ["turn", "role", "same"]  # nulls first


class _Conversation:
    """What the first pass gathers of one conversation: 17 bytes a turn."""

    def __init__(self, conv):
        self.conv, self.codes, self.same = conv, bytearray(), bytearray()
        self.first = self.last = None
        self.distinct = self.illegal = 0
        self.before = None

    def add(self, turn, initial: str, blank: bool, ended: bool, same: bytes) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.distinct += 1
            self.last = turn
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        code = initial if initial in ("s", "u", "a") else "x"
        self.codes += (DEAD if blank else code if ended else code.upper()).encode()
        self.same += same

    def result(self) -> tuple:
        n, turns = len(self.codes), self.codes.decode()
        blank = turns.count(DEAD)
        if n > 1:
            firsts = np.unique(np.frombuffer(bytes(self.same), "V16"), return_index=True)[1]
            if len(firsts) < n:
                again = np.ones(n, bool)
                again[firsts] = False
                codes = np.frombuffer(self.codes, np.uint8).copy()
                codes[again] = ord(DEAD)
                turns = codes.tobytes().decode()
        duplicate = turns.count(DEAD) - blank
        truncated = sum(turns.count(c) for c in "SUAX")
        cost, audit = cheapest(turns)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return self.conv, gaps, blank, duplicate, truncated, self.illegal, cost, audit


def audits(turns: DataFrame) -> DataFrame:
    """conv and ``AUDIT``: one row for each conversation, those without a turn left too. Narrow rows are shuffled, no
    texts; a task streams them in order and keeps 17 bytes a turn of the conversation at hand."""
    core = F.rtrim("text", F.lit(SPACES))
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def flush(rows):
            cols = list(zip(*rows)) or [()] * 8
            names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            return pa.RecordBatch.from_arrays([pa.array(c, key_type if k == 0 else pa.string() if k == 7 else pa.int64()) for k, c in enumerate(cols)], names)

        key_type = pa.null()
        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, turn, initial, blank, ended, gone, same in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(conv)
                if not gone:
                    now.add(turn, initial, blank, ended, same)
            if len(out) >= 1000:
                yield flush(out)
                out = []
        if now is not None:
            yield flush([*out, now.result()])

    narrow = turns.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), (core == "").alias("blank"),
                          F.right(core, F.lit(1)).isin(*ENDS).alias("ended"), "gone", "same", "role")
    ordered = narrow.repartition("conv").sortWithinPartitions("conv", *ORDER).drop("role")
    return ordered.select("conv", "turn", "initial", "blank", "ended", "gone", "same").mapInArrow(run, f"conv {kind}, {AUDIT}")


class _Replay:
    """Follows an audit while the turns come in order; each step gives the (role, text) pairs that it adds."""

    def __init__(self, audit: str):
        self.audit, self.at, self.next = audit, 0, "u"

    def _inserted(self) -> Iterator[tuple[bytes, bytes]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield NAMES[self.next].encode(), b""
            self.next = "a" if self.next == "u" else "u"

    def turn(self, role: bytes, text: bytes) -> Iterator[tuple[bytes, bytes]]:
        yield from self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return
        yield (NAMES[self.next].encode() if edit == "R" else role), text
        if edit == "R" or role[:1] != b"s":
            self.next = "a" if self.next == "u" else "u"

    end = _inserted


def _replay(turns: DataFrame, found: DataFrame, emit: str, run) -> DataFrame:
    """Sends each conversation's audit and after it its turns in order to ``run``, as one stream."""
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("text"), F.lit(None).cast("binary").alias("same"), F.struct(*[c.split()[0] for c in AUDIT.split(", ")]).alias("found"))
    rows = turns.where(~F.col("gone")).select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "same", F.lit(None).cast(heads.schema["found"].dataType).alias("found"))
    stream = heads.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
    return stream.select("conv", "kind", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "found").mapInArrow(run, emit)


def audit_and_digest(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                     gone: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row for each conversation of
    ``df``, in which rows with ``gone`` (a column) count as lost.

    A conversation's turns are taken by turn number, nulls first, then by role and text; null roles and texts are one space;
    a null conv_id is a conversation of its own; repeated rows are duplicates; empty texts are blank; a conversation without
    rows has zeros, an empty audit and the digest of nothing; an empty table gives no rows; other columns aren't read. The
    digest of a conversation is one sequential computation over its texts; its task streams them and holds one batch."""
    small_batches(df.sparkSession)
    turns = _turns(df, conv_col, turn_col, role_col, text_col, gone)
    found = written(audits(turns), "conversation-audits")
    kind = turns.schema["conv"].dataType.simpleString()
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = replay = sha = None
        started, out, key_type = False, [], pa.null()

        def feed(pairs):
            nonlocal started
            for role, text in pairs:
                sha.update(b"\n" * started + role + b":" + text)
                started = True

        def close():
            if head is not None:
                feed(replay.end())
                out.append((*head, sha.hexdigest()))

        def flush():
            cols = list(zip(*out)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, key_type if k == 0 else pa.string() if k > 6 else pa.int64()) for k, c in enumerate(cols)], names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, which, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if which == 0:
                    close()
                    head, replay, sha, started = (conv, *audit.values()), _Replay(audit["audit"]), hashlib.sha256(), False
                else:
                    feed(replay.turn(role, text))
            if len(out) >= 1000:
                yield flush()
        close()
        yield flush()

    result = _replay(turns, found, f"conv {kind}, {AUDIT}, repaired_sha256 string", run)
    return result.withColumnRenamed("conv", conv_col)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           gone: Column | None = None) -> DataFrame:
    """conv_id, place (from 0), role, text: the repaired turns; cases as in ``audit_and_digest``. Conversations of
    which nothing stays have no rows."""
    small_batches(df.sparkSession)
    turns = _turns(df, conv_col, turn_col, role_col, text_col, gone)
    found = written(audits(turns), "conversation-audits")
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = replay = None
        place, out, key_type = 0, [], pa.null()

        def feed(pairs):
            nonlocal place
            for role, text in pairs:
                out.append((now, place, role.decode(), text.decode()))
                place += 1

        def flush():
            cols = list(zip(*out)) or [()] * 4
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (key_type, pa.int64(), pa.string(), pa.string()))], ["conv", "place", "role", "text"])

        for batch in batches:
            key_type = batch.schema.field(0).type
            for conv, which, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if which == 0:
                    if replay is not None:
                        feed(replay.end())
                    now, replay, place = conv, _Replay(audit["audit"]), 0
                else:
                    feed(replay.turn(role, text))
            yield flush()
        if replay is not None:
            feed(replay.end())
        yield flush()

    return _replay(turns, found, f"conv {kind}, place long, role string, text string", run).withColumnRenamed("conv", conv_col)


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, lost: known faults by crc32('conv_id:turn') mod 20, for measuring a repair. 0 loses the row, 1
    empties its text, 2 takes away its sentence ends, 3 repeats it, 4 makes it a user's. Nulls are one space, but a null
    turn stays null as a number."""
    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col)).cast("binary")) % 20
    rows = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), part(role_col).alias("role"), part(text_col).alias("text"),
                     fault.alias("fault"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("fault") == 0).alias("lost"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")
