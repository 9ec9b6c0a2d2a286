"""Conversation structure repair by alignment with an alternating grammar.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: nothing, or an
optional system turn and then user and assistant in turn. Its rows are taken by turn
(nulls first), and a row's first fault counts: blank (no character outside white
space), duplicate (its role and text were seen earlier) or truncated (its last such
character is none of ``.!?``). Edits: K keeps a row (0), R makes its role user or
assistant (3), D deletes it (4; blank and duplicate rows must go), I inserts an empty
user or assistant turn (3); a truncated row that stays adds 3. The audit is the
cheapest sequence of edits, by their letters; of equally cheap ones the ASCII-least.

Method: Wagner-Fischer tables of rows against the target ``uaua..`` and, where a system
row can lead, ``suaua..``. Targets of all feasible lengths are beginnings of these two
strings, so the cells of a table's last row end the alignments with each of them; each
alignment is traced and the audits of equal cost are compared. Ukkonen's band leaves out
cells that deletions and insertions alone put over the incumbent cost, that of a plain
repair from left to right. Long conversations are cut every ``SEGMENT`` rows: a cell
of a segment's last row goes on with the cost of the rest of the conversation from the
phase of the grammar that it has reached, so the parts give the exact optimum of the
whole in linear time.

On Spark: faults and counts are DataFrame functions; first sightings are an aggregate of
text hashes. The rows then lie sorted by conversation and place, first their one-letter
kinds, then their texts, and are read as a stream: of a conversation a task holds one byte
a row and no text, however long it is. The repaired turns of one conversation are hashed
in order, which is why one task reads all of them.

Defined results: null roles, texts, ids and turns count as one space in hashes of
damage; a null role or text is one space; rows with a null ``conv_id`` are one
conversation; rows of one turn follow by role and the hash of their text, and equal rows
repeat; gaps leave null turns out; a conversation that loses all rows has zeros, an empty
audit and the hash of an empty text; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SEGMENT = 256                   # rows that one table aligns
_INF = 1 << 40
START, SYSTEM, USER, DONE = range(4)   # what the grammar has read: nothing, s, ..u, ..a
_NAMES = {"u": "user", "a": "assistant"}
_PAIRS = {"su", "ua", "au"}
KINDS = "suaxSUAXd"             # role initial (x: another), upper case when truncated; d: must go
_NULL_TURN = -(1 << 63)
REPORT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
TURNS = "place long, edit string, turn long, role string, text string"
ROWS_OUT, CHARACTERS_OUT = 4000, 1 << 20
_WHITE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------- alignment

def _target(phase: int, system: bool, length: int) -> str:
    """What the grammar reads next from a phase, ``length`` letters of it."""
    if system:
        return ("s" + "ua" * (length // 2 + 1))[:length]
    return (("a" if phase == USER else "") + "ua" * (length // 2 + 1))[:length]


def _phase(phase: int, system: bool, read: np.ndarray) -> np.ndarray:
    """The phase after ``read`` letters of the target."""
    shift = 1 if phase == USER else 0
    if system:
        return np.where(read == 0, START, np.where(read == 1, SYSTEM, np.where(read % 2 == 0, USER, DONE)))
    reached = np.where((read + shift) % 2 == 1, USER, DONE)
    return np.where(read == 0, phase, reached)


def _plain_cost(kinds: str, phase: int, rest: list[int]) -> int:
    """Cost of a repair from left to right: required rows go, every other row stays under the role that it
    has if the grammar reads it next, under the next one otherwise; at last what is missing is inserted."""
    cost = 0
    for kind in kinds:
        if kind == "d":
            cost += DELETE
            continue
        letter = kind.lower()
        cost += TRUNCATED if kind != letter else 0
        if phase == START and letter == "s":
            phase = SYSTEM
            continue
        due = "a" if phase == USER else "u"
        cost += 0 if letter == due else REROLE
        phase = DONE if due == "a" else USER
    ends = [cost + rest[phase]]
    after = {SYSTEM: USER, USER: DONE, DONE: USER, START: USER}
    for inserted in (1, 2):                               # a further user or assistant, if the end needs it
        phase = after[phase]
        ends.append(cost + inserted * INSERT + rest[phase])
    return min(ends)


class _Table:
    """Costs of aligning the rows from each one on with the rest of one target, and of what follows."""

    def __init__(self, kinds: str, phase: int, system: bool, rest: list[int], most: int):
        n = len(kinds)
        self.phase, self.system, self.kinds = phase, system, kinds
        # Ukkonen: more than this many insertions (or deletions) over the required ones alone cost over ``most``
        forced = np.concatenate(([0], np.cumsum([k == "d" for k in kinds])))
        spare = max(0, most - DELETE * int(forced[-1]) - min(rest))
        self.width = n + spare // INSERT + 1
        self.target = _target(phase, system, self.width)
        read = np.arange(self.width + 1)
        steps = INSERT * read
        letters = np.array(list(self.target))
        last = np.array([rest[p] for p in _phase(phase, system, read).tolist()], dtype=np.int64)
        self.last = last                                  # what follows, by the letters read
        no_insert = np.zeros(self.width + 1, dtype=np.int64)
        if system:                                        # the leading s cannot be inserted
            no_insert[0] = _INF
        self.cost = np.full((n + 1, self.width + 1), _INF, dtype=np.int64)

        def with_insertions(row: np.ndarray) -> np.ndarray:
            # row[j] = min over j' >= j of row[j'] + INSERT * (j' - j), by a running minimum from the right
            best = np.minimum.accumulate((row + steps)[::-1])[::-1] - steps
            return np.minimum(row, np.concatenate((best[1:] + INSERT, [_INF])) + no_insert)

        self.cost[n] = with_insertions(last)
        for i in range(n - 1, -1, -1):
            kept = i - int(forced[i])                     # rows before this one that need not go
            lo, hi = max(0, kept - spare // DELETE), min(self.width, kept + spare // INSERT)
            row = np.full(self.width + 1, _INF, dtype=np.int64)
            row[lo:hi + 1] = self.cost[i + 1][lo:hi + 1] + DELETE
            if kinds[i] != "d" and lo < self.width:
                stop = min(hi, self.width - 1)
                there = letters[lo:stop + 1]
                change = np.where(there == kinds[i].lower(), 0, np.where(there == "s", _INF, REROLE))
                stays = self.cost[i + 1][lo + 1:stop + 2] + change + (0 if kinds[i].islower() else TRUNCATED)
                row[lo:stop + 1] = np.minimum(row[lo:stop + 1], stays)
            self.cost[i, lo:hi + 1] = with_insertions(row)[lo:hi + 1]

    def trace(self) -> tuple[str, int]:
        """(the ASCII-least audit of least cost, the phase that it reaches): D before I before K before R."""
        out, i, j, n = [], 0, 0, len(self.kinds)
        while True:
            here = int(self.cost[i, j])
            if i == n and here == self.last[j]:
                return "".join(out), int(_phase(self.phase, self.system, np.array([j]))[0])
            if i < n and here == self.cost[i + 1, j] + DELETE:
                out.append("D")
                i += 1
            elif j < self.width and not (self.system and j == 0) and here == self.cost[i, j + 1] + INSERT:
                out.append("I")
                j += 1
            else:
                out.append("K" if self.kinds[i].lower() == self.target[j] else "R")
                i, j = i + 1, j + 1


def _aligned(kinds: str, phase: int, rest: list[int]) -> list[_Table]:
    """The tables of least cost from a phase, over the targets that it allows."""
    most = _plain_cost(kinds, phase, rest)
    tables = []
    for system in (False, True) if phase == START and "s" in kinds.lower() else (False,):
        tables.append(_Table(kinds, phase, system, rest, most))
    least = min(t.cost[0, 0] for t in tables)
    return [t for t in tables if t.cost[0, 0] == least]


@lru_cache(maxsize=20_000)
def _align_short(kinds: str) -> tuple[int, str]:
    return align(kinds)


def align(kinds: str, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, audit) of a conversation by the letters of its rows (``KINDS``)."""
    parts = [kinds[i:i + segment] for i in range(0, len(kinds), segment)] or [""]
    rests = [[0, _INF, _INF, 0]]                          # cost of what follows a segment, by phase
    for part in reversed(parts[1:]):
        rests.append([min(_INF, int(_aligned(part, phase, rests[-1])[0].cost[0, 0])) for phase in range(4)])
    cost, phase, audit = None, START, []
    for part, rest in zip(parts, reversed(rests), strict=True):
        tables = _aligned(part, phase, rest)
        if cost is None:
            cost = int(tables[0].cost[0, 0])
        letters, phase = min(t.trace() for t in tables)
        audit.append(letters)
    return cost, "".join(audit)


# ------------------------------------------------------------- on Spark

class _Reader:
    """Reads the sorted rows of conversations; gives each conversation's report, or its repaired turns."""

    def __init__(self, turns: bool):
        self.turns = turns
        self.out: list[tuple] = []
        self.conv, self.open = None, False

    def begin(self, conv) -> None:
        self.conv, self.open = conv, True
        self.kinds = bytearray()
        self.previous = self.initial = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.distinct = 0
        self.audit = None

    def kind_of(self, at: int, role: str, digest: bytes, fault: int, first_at: int | None) -> None:
        """A row of the first pass. ``fault``: 0 none, 1 blank, 2 truncated."""
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _PAIRS:
            self.illegal += 1
        if at != _NULL_TURN and at != self.last_turn:
            self.first_turn = at if self.first_turn is None else self.first_turn
            self.last_turn = at
            self.distinct += 1
        letter = initial if initial in ("s", "u", "a") else "x"
        if fault == 1:
            self.blank += 1
            letter = "d"
        elif (first_at is not None and first_at < at) or (at, role, digest) == self.previous:
            self.duplicate += 1
            letter = "d"
        elif fault == 2:
            self.truncated += 1
            letter = letter.upper()
        self.kinds += letter.encode()
        self.previous, self.initial = (at, role, digest), initial

    def settle(self) -> None:
        """All rows are known: align them."""
        kinds = self.kinds.decode()
        self.cost, self.audit = _align_short(kinds) if len(kinds) <= 32 else align(kinds)
        self.step, self.phase, self.place = 0, START, 0
        self.digest = hashlib.sha256()

    def add(self, edit: str, turn: int | None, role: str, text: str) -> None:
        if self.turns:
            self.out.append((self.conv, self.place, edit, turn, role, text))
        else:
            self.digest.update(b"\n" if self.place else b"")
            self.digest.update(f"{role}:{text}".encode())
        self.place += 1

    def due(self) -> str:
        letter = "a" if self.phase == USER else "u"
        self.phase = DONE if letter == "a" else USER
        return _NAMES[letter]

    def insertions(self) -> None:
        while self.step < len(self.audit) and self.audit[self.step] == "I":
            self.add("I", None, self.due(), "")
            self.step += 1

    def text_of(self, at: int, role: str, text: str) -> None:
        """A row of the second pass."""
        if self.audit is None:
            self.settle()
        self.insertions()
        edit = self.audit[self.step]
        self.step += 1
        if edit == "D":
            return
        if edit == "R":
            role = self.due()
        else:
            self.phase = SYSTEM if role[0] == "s" else USER if role[0] == "u" else DONE
        self.add(edit, None if at == _NULL_TURN else at, role, text)

    def end(self) -> None:
        if not self.open:
            return
        if self.audit is None:
            self.settle()
        self.insertions()
        self.open = False
        if not self.turns:
            gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
            self.out.append((self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                             self.audit, self.digest.hexdigest()))


def _stream(turns: bool):
    names = ["conv_id", *[c.split()[0] for c in (TURNS if turns else REPORT).split(", ")]]
    types = [pa.int64() if c.endswith(" long") else pa.string() for c in (TURNS if turns else REPORT).split(", ")]

    def read(batches) -> Iterator[pa.RecordBatch]:
        reader, key = _Reader(turns), None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*reader.out, strict=True)) or [()] * len(names)
            reader.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [key, *types], strict=True)], names)

        for batch in batches:
            key = batch.column("conv_id").type
            rows = zip(*[batch.column(c).to_pylist() for c in _SORTED], strict=True)
            size = 0
            for conv, step, at, role, digest, fault, first_at, text in rows:
                if not reader.open or conv != reader.conv:
                    reader.end()
                    reader.begin(conv)
                if step == 0:
                    reader.kind_of(at, role, digest, fault, first_at)
                elif step == 1:
                    reader.text_of(at, role, text)
                    size += len(text)
                if len(reader.out) >= ROWS_OUT or size >= CHARACTERS_OUT:
                    yield flush()
                    size = 0
            if reader.out:
                yield flush()
        reader.end()
        if reader.out:
            yield flush()
    return read


_SORTED = ["conv_id", "step", "at", "role", "digest", "fault", "first_at", "text"]


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of ``rows`` after the damage that crc32 of ``conv_id:turn`` picks, modulo 20:
    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's. Nulls read as one space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    spin = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    return (rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), spin.alias("_spin"))
            .filter("_spin != 0")
            .select("conv_id", "turn", F.when(F.col("_spin") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_spin") == 1, "").when(F.col("_spin") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("_spin") == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))


def _sorted_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    trimmed = F.rtrim("text", F.lit(_WHITE))
    known = (rows.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(_NULL_TURN)).alias("at"),
                         F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
             .withColumn("digest", F.unhex(F.sha2("text", 256)))
             .withColumn("fault", F.when(trimmed == "", 1).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 2)
                         .otherwise(0)))
    light = known.select("conv_id", "at", "role", "digest", "fault")
    first = (light.filter("fault != 1").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first_at"))
             .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first_at"))
    same = (F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
            & (F.col("digest") == F.col("_digest")))
    none = F.lit(None)
    kinds = light.join(first, same, "left").select(
        "conv_id", F.lit(0).alias("step"), "at", "role", "digest", "fault", "first_at", none.cast("string").alias("text"))
    texts = known.select("conv_id", F.lit(1).alias("step"), "at", "role", "digest", none.cast("int").alias("fault"),
                         none.cast("long").alias("first_at"), "text")
    heads = ids.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).alias("step"), none.cast("long").alias("at"), none.cast("string").alias("role"),
        none.cast("binary").alias("digest"), none.cast("int").alias("fault"), none.cast("long").alias("first_at"),
        none.cast("string").alias("text"))
    return heads.union(kinds).union(texts).repartition("conv_id").sortWithinPartitions(*_SORTED[:5])


def _key(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``ids`` (of ``rows``, if None): ``conv_id`` and ``REPORT``."""
    return _sorted_rows(rows, rows if ids is None else ids).mapInArrow(_stream(False), f"{_key(rows)}, {REPORT}")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of every conversation after its repair: ``conv_id`` and ``TURNS``. ``place`` counts from 0,
    ``edit`` is K, R or I, an inserted turn has no ``turn``."""
    return _sorted_rows(rows, rows).mapInArrow(_stream(True), f"{_key(rows)}, {TURNS}")
