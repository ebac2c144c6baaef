"""Repair of conversations: the cheapest edits that make the roles alternate, found in one secondary-sorted stream.

Rows are dealt by conversation and sorted by turn inside partitions; a stream over Arrow batches carries the state of a dynamic program from row to row and from
batch to batch, so a task holds one batch and one state, however long a conversation is. States are those of the automaton of ``(s?(ua)+)?``:
nothing yet, after s, after u, after a. For each state the program keeps the cheapest edits that lead to it, of equally cheap ones
the least by ASCII. Edit strings of different states differ at some place before either ends (each ends with an edit that takes the same row), so their order is a rank,
and the next row's order follows from the ranks and the new edits. Costs are kept relative to the least; states that cannot win any more are
dropped, so there are few distinct (state, kind of row) and each is worked out once. Each row leaves four bytes of backpointers, which
go to a file in the shared folder when a conversation has many.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsieve.operators.sizing import shared_folder

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3  # costs; undeleted truncated rows add the last
BLANKS = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
OTHER = 3  # kind of roles that start with none of s, u, a
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(NOTHING, 0): AFTER_S, (NOTHING, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
NEXT_ROLE = {NOTHING: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
NEXT_STATE = {NOTHING: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
ENDING = {NOTHING: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}  # inserts at the end
OPS = "DKR"
HOPELESS = 8  # a state dearer by more cannot win: any of its futures costs at most 7 more from another state
SPILL_BYTES = 1 << 20
LEGAL = {(0, 1), (1, 2), (2, 1)}

Program = tuple[tuple[int, int], ...]  # (state, cost above the least), by rank
_steps: dict[tuple[Program, int, int], tuple[Program, int, bytes, tuple]] = {}


def step(program: Program, kind: int, fault: int) -> tuple[Program, int, bytes, tuple]:
    """After one more row: the program, what the least cost rose by, the row's backpointers (a byte for each state: state before, inserts, edit), and for
    each state (state, state before, inserts, edit)."""
    known = _steps.get((program, kind, fault))
    if known is not None:
        return known
    best: dict[int, tuple] = {}
    for rank, (state, cost) in enumerate(program):
        now = state
        for inserts in range(3):
            moves = [("D", now, DELETE)]
            if fault in (OK, TRUNCATED):
                more = CUT_SHORT if fault == TRUNCATED else 0
                moves.append(("R", NEXT_STATE[now], REROLE + more))
                if (now, kind) in STEP:
                    moves.append(("K", STEP[now, kind], KEEP + more))
            for op, to, price in moves:
                found = (cost + inserts * INSERT + price, rank, "I" * inserts + op, state)
                if to not in best or found[:3] < best[to][:3]:
                    best[to] = found
            now = NEXT_STATE[now]
    least = min(f[0] for f in best.values())
    order = sorted((s for s in best if best[s][0] <= least + HOPELESS), key=lambda s: best[s][1:3])
    back, moves = bytearray(4), []
    for s in order:
        _, _, edits, before = best[s]
        back[s] = before | (len(edits) - 1) << 2 | OPS.index(edits[-1]) << 4
        moves.append((s, before, len(edits) - 1, edits[-1]))
    out = tuple((s, best[s][0] - least) for s in order), least, bytes(back), tuple(moves)
    _steps[program, kind, fault] = out
    return out


class Backpointers:
    """Bytes that are appended and then read from the end; beyond ``SPILL_BYTES`` they go to an unnamed file in the folder, or, without one, are compressed."""

    def __init__(self, folder: str | None):
        self.folder, self.tail, self.sizes, self.packed = folder, bytearray(), [], []
        self.file = None

    def add(self, back: bytes) -> None:
        self.tail += back
        if len(self.tail) >= SPILL_BYTES:
            block = zlib.compress(bytes(self.tail), 1)
            if self.folder is None:
                self.packed.append(block)
            else:
                self.file = self.file or tempfile.TemporaryFile(dir=self.folder)
                self.file.write(block)
                self.sizes.append(len(block))
            self.tail = bytearray()

    def backwards(self) -> Iterator[bytes]:
        """The blocks, last first."""
        yield bytes(self.tail)
        for block in reversed(self.packed):
            yield zlib.decompress(block)
        end = sum(self.sizes)
        for size in reversed(self.sizes):
            end -= size
            self.file.seek(end)
            yield zlib.decompress(self.file.read(size))
        if self.file is not None:
            self.file.close()


class Conversation:
    """What the stream carries for the conversation that it is in."""

    def __init__(self, key: str | None, folder: str | None):
        self.key, self.back = key, Backpointers(folder)
        self.program: Program = ((NOTHING, 0),)
        self.cost = self.illegal = self.distinct = 0
        self.faults = [0, 0, 0, 0]
        self.kind = self.low = self.turn = None
        self.hashes = {NOTHING: hashlib.sha256()}

    def row(self, turn: int | None, role: str, text: str, kind: int, fault: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.turn
            self.turn = turn
        if self.kind is not None and (self.kind, kind) not in LEGAL:
            self.illegal += 1
        self.kind = kind
        self.faults[fault] += 1
        self.program, rise, back, moves = step(self.program, kind, fault)
        self.cost += rise
        self.back.add(back)
        hashes = {}
        for state, before, inserts, op in moves:
            if not inserts and op == "D" and state == before:
                hashes[state] = self.hashes[before]
                continue
            own, at = self.hashes[before].copy(), before
            for _ in range(inserts):
                own.update(f"{'' if at == NOTHING else '\n'}{NEXT_ROLE[at]}:".encode())
                at = NEXT_STATE[at]
            if op != "D":
                own.update(f"{'' if at == NOTHING else '\n'}{role if op == 'K' else NEXT_ROLE[at]}:{text}".encode("utf-8", "surrogatepass"))
            hashes[state] = own
        self.hashes = hashes

    def close(self) -> tuple:
        """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        _, _, state = min((cost + ENDING[s] * INSERT, rank, s) for rank, (s, cost) in enumerate(self.program))
        cost = self.cost + dict(self.program)[state] + ENDING[state] * INSERT
        repaired = self.hashes[state].copy()
        at, audit = state, ["I" * ENDING[state]]
        for _ in range(ENDING[state]):
            repaired.update(f"\n{NEXT_ROLE[at]}:".encode())
            at = NEXT_STATE[at]
        for block in self.back.backwards():
            for i in range(len(block) - 4, -1, -4):
                b = block[i + state]
                audit.append("I" * (b >> 2 & 3) + OPS[b >> 4])
                state = b & 3
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.distinct
        return self.key, gaps, *self.faults[1:], self.illegal, cost, "".join(reversed(audit)), repaired.hexdigest()


FIELDS = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
DDL = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by the CRC-32 of ``conv:turn`` modulo 20 (0 drops, 1 empties the text, 2 takes its sentence ends,
    3 repeats the row, 4 makes it the user's). Dropped rows stay as marks (``gone``), so that no conversation is lost. Nulls are one blank."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col(f"`{conv}`").cast("string"), blank), F.lit(":"), F.coalesce(F.col(f"`{turn}`").cast("string"), blank))
    code = F.pmod(F.crc32(name.cast("binary")), F.lit(20)).cast("int")
    said = F.coalesce(F.col(f"`{text}`").cast("string"), blank)
    rows = conversations.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), code.alias("code"),
        F.when(code == 4, "user").otherwise(F.coalesce(F.col(f"`{role}`").cast("string"), blank)).alias("role"),
        F.when(code < 2, "").when(code == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
    )
    twice = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", "role", "text", (F.col("code") == 0).alias("gone"), twice.alias("copy")).drop("copy")


def plain(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns without damage."""
    blank = F.lit(" ")
    return conversations.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"), F.lit(False).alias("gone"),
    )


def judged(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted by turn, with ``kind`` (of the role's initial) and ``fault``. One exchange: the window that looks for
    earlier equal rows and the last sort both use it."""
    rows = rows.withColumns({"e1": F.xxhash64("role", "text"), "e2": F.xxhash64(F.lit(1), "role", "text")}).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "gone", "e1", "e2").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(bare == "", BLANK)
        .when(F.row_number().over(earlier) > 1, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(OK)
    )
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    rows = rows.select("conv_id", "turn", "role", "text", "gone", kind.alias("kind"), fault.alias("fault"))
    return rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def mounted(spark) -> str | None:
    parts = urlparse(shared_folder(spark))
    return parts.path if parts.scheme in ("", "file") else None


def repair(rows: DataFrame) -> DataFrame:
    """Rows of ``damaged`` or ``plain`` -> one row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Cases: null conversations are one conversation; null turns are first and leave no gaps; null roles and texts are one blank (so the row is blank and its role
    illegal); an empty role cannot be kept; rows of one turn follow role and text; repeated rows are duplicates; texts count whole; a conversation
    whose rows are all gone has zeros and the hash of nothing; empty table: no rows; further columns are left out.
    """
    folder = mounted(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for frame in frames:
            done = []
            for key, has_turn, turn, role, text, gone, what, fault in zip(*[frame[c].tolist() for c in frame.columns], strict=True):
                if now is None or key != now.key:
                    if now is not None:
                        done.append(now.close())
                    now = Conversation(key, folder)
                if not gone:
                    now.row(turn if has_turn else None, role, text, what, fault)
            yield pd.DataFrame(done, columns=FIELDS)
        if now is not None:
            yield pd.DataFrame([now.close()], columns=FIELDS)

    has = F.col("turn").isNotNull()
    stream = judged(rows).select(
        F.col("conv_id").cast("string").alias("conv"), has.alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "gone", "kind", "fault"
    )
    return stream.mapInPandas(run, DDL).select(F.col("conv").cast(kind).alias("conv_id"), *FIELDS[1:])


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place (from 0), role, text, edit, from rows and what ``repair`` found for them. Inserted turns have empty text."""
    numbered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    own = rows.filter("NOT gone").select(F.col("conv_id").alias("own_conv"), "role", "text", F.row_number().over(numbered).alias("own_row"))
    edits = found.select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).filter("edit != ''")
    upto = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.withColumn("row", F.count_if(F.col("edit") != "I").over(upto)).withColumn("place", F.count_if(F.col("edit") != "D").over(upto) - 1)
    met = F.col("conv_id").eqNullSafe(F.col("own_conv")) & (F.col("row") == F.col("own_row")) & (F.col("edit") != "I")
    turns = edits.filter("edit != 'D'").join(own, met, "left")
    system = F.max(F.when((F.col("place") == 0) & (F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(Window.partitionBy("conv_id"))
    named: Column = F.when((F.col("place") - system) % 2 == 0, "user").otherwise("assistant")
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(named)
    return turns.select("conv_id", "place", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit")
