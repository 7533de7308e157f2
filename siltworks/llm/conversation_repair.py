"""Repair of the role structure of conversations: cheapest edits by the auction algorithm for shortest paths.

The nodes of the lattice are (rows read, state); a state says which role was written last. From each node a row may be
kept, given another role or deleted, or a row may be inserted. The auction algorithm keeps a price for every node,
never above what any arc costs plus the price of the node it leads to. A path from an origin is extended along an arc
that meets this exactly, or contracted and the price of its last node raised, until it reaches a node whose price is final.
Origins are taken from the last layer to the first, with prices started at the least final price of the layer behind. The
final prices are the costs that are left, so the arcs that meet them exactly are those of the cheapest paths, and the
one with the least letters in order is traced along them.

Conversations of any length: rows are put in order by a range partitioning and cut into blocks of 4,096. Each block has a
matrix of costs between its states at both ends; prices at the ends of blocks follow from these, and every block is
then traced by itself from each state it may be entered in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .mixing import SPACE

BLOCK_BITS = 12
#: States: nothing written yet, or the last role was system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
#: What may end a conversation for nothing; elsewhere rows are inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: The state after a row written next: by the row's own role, or by the role that is due.
DUE = (USER, USER, ASSISTANT, USER)
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
LEGAL = {(SYSTEM - 1, USER - 1), (USER - 1, ASSISTANT - 1), (ASSISTANT - 1, USER - 1)}
CLEAN, TRUNCATED, BLANK, DUPLICATE = range(4)


def code(role: int, fault: int) -> str:
    """A row of the lattice as one letter: first letter of its role (s, u, a, another) and its first fault."""
    return chr(65 + 4 * role + fault)


def _arcs(row: str, state: int) -> list[tuple[str, int, bool, int]]:
    """(letter, cost, whether the row is read, next state), by letter."""
    role, fault = divmod(ord(row) - 65, 4)
    out = [("D", DELETE, True, state), ("I", INSERT, False, DUE[state])]
    if fault in (CLEAN, TRUNCATED):
        more = CUT_SHORT if fault == TRUNCATED else 0
        if KEPT[state][role] is not None:
            out.append(("K", KEEP + more, True, KEPT[state][role]))
        out.append(("R", REROLE + more, True, DUE[state]))
    return out


@lru_cache(1 << 16)
def _auction(row: str, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Final prices of a layer, given those of the layer behind it: path extension and contraction."""
    low = min(behind)
    price = [low] * 4
    if min(behind[USER], behind[ASSISTANT]) >= FAR:  # no way leads back to the states before
        price[USER] = price[ASSISTANT] = FAR
    arcs = [_arcs(row, s) for s in range(4)]
    for origin in range(4):
        path = [origin]
        while price[path[-1]] < FAR:
            node = path[-1]
            best, read, to = min((min(FAR, c + (behind[x] if read else price[x])), not read, x) for _, c, read, x in arcs[node])
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif read:  # an insertion: the path goes on in this layer
                path.append(to)
            else:
                break
    return tuple(price)


def _relative(prices: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(prices)
    return tuple(p if p >= FAR else p - low for p in prices), low if low < FAR else 0


def prices(rows: str, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Final prices before each row, and behind the last: what is left to pay from there."""
    out, (now, paid) = [end], _relative(end)
    for row in reversed(rows):
        now, more = _relative(_auction(row, now))
        paid += more
        out.append(tuple(p if p >= FAR else p + paid for p in now))
    return out[::-1]


def trace(rows: str, price: list[tuple[int, ...]], state: int) -> tuple[str, int]:
    """(letters, last state) of the cheapest path whose letters come first in order."""
    letters = []
    for k, row in enumerate(rows):
        read = False
        while not read:
            for letter, cost, read, to in _arcs(row, state):
                ahead = price[k + 1][to] if read else price[k][to]
                if ahead < FAR and price[k][state] == cost + ahead:
                    letters.append(letter)
                    state = to
                    break
            else:
                raise AssertionError("no arc meets the prices")
    return "".join(letters), state


def matrix(rows: str) -> list[int]:
    """Costs from each state before the rows to each state behind them."""
    to = [prices(rows, tuple(0 if s == end else FAR for s in range(4)))[0] for end in range(4)]
    return [to[b][a] for a in range(4) for b in range(4)]


@lru_cache(1 << 14)
def _short(rows: str) -> tuple[str, int]:
    price = prices(rows, END)
    letters, last = trace(rows, price, START)
    return letters + "I" * (END[last] // INSERT), price[0][START]


def solve(rows: str) -> tuple[str, int]:
    """(letters, cost) of a whole conversation."""
    return _short(rows) if len(rows) <= 32 else _short.__wrapped__(rows)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32(conv_id:turn) mod 20: dropped, emptied, without full stops, repeated, or by a user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    times = F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), body.alias("text"), times.alias("n"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("n")))).drop("col")


@dataclass(frozen=True)
class Repair:
    """``conversations``: conv, blank, duplicate, truncated, illegal, cost, audit. Also what ``rows`` and ``digests`` need."""

    conversations: DataFrame
    ordered: DataFrame
    segments: DataFrame


def _class(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _illegal(rows: str) -> int:
    roles = [(ord(c) - 65) // 4 for c in rows]
    return sum(p not in LEGAL for p in zip(roles, roles[1:], strict=False))


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        done = [solve(c) for c in b["codes"]]
        yield b.assign(state=START, audit=[a for a, _ in done], cost=[c for _, c in done], illegal=[_illegal(c) for c in b["codes"]])


def _weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield b.assign(matrix=[matrix(c) for c in b["codes"]])


def _priced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Prices at the end of each segment, from the last one of a conversation to its first."""
    conv, price = object(), END
    for b in batches:
        ends, last = [], []
        for c, m in zip(b["conv"], b["matrix"], strict=True):
            last.append(c != conv)
            if c != conv:
                conv, price = c, END
            ends.append(list(price))
            price = tuple(min(FAR, min(int(m[4 * a + x]) + price[x] for x in range(4))) for a in range(4))
        yield b.drop(columns="matrix").assign(ends=ends, last=last)


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each segment from every state in which it may be entered."""
    for b in batches:
        audits, costs, exits = [], [], []
        for codes, end, last in zip(b["codes"], b["ends"], b["last"], strict=True):
            end = tuple(map(int, end))
            price = prices(codes, end)
            found = [trace(codes, price, s) if price[0][s] < FAR else ("", 0) for s in range(4)]
            audits.append([a + ("I" * (END[x] // INSERT) if last else "") for a, x in found])
            costs.append([0 if price[0][s] >= FAR else price[0][s] - (0 if last else end[x]) for s, (_, x) in enumerate(found)])
            exits.append([x for _, x in found])
        yield b.drop(columns=["ends", "last"]).assign(audits=audits, costs=costs, exits=exits)


def _chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From the first segment of a conversation on: the state each one is entered in picks its letters."""
    conv, state, before = object(), START, ""
    for b in batches:
        states, audits, costs, illegal = [], [], [], []
        for c, codes, a, n, x in zip(b["conv"], b["codes"], b["audits"], b["costs"], b["exits"], strict=True):
            if c != conv:
                conv, state, before = c, START, ""
            states.append(state)
            audits.append(a[state])
            costs.append(int(n[state]))
            illegal.append(_illegal(before + codes))
            state, before = int(x[state]), codes[-1]
        yield b[["conv", "block", "at", "codes", "alone"]].assign(state=states, audit=audits, cost=costs, illegal=illegal)


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS) -> Repair:
    """The cheapest edits of each conversation in ``rows`` (conv_id, turn, role, text).

    Rows count by turn, nulls first; rows of one turn by role and a digest of the text (equal rows may change places). A
    row's first fault counts: blank (only white space), duplicate (role and text were there before), truncated (does not
    end in ``.!?``). Keeping costs 0, another role 2, deleting 3, inserting an empty user or assistant row 2; blank and
    duplicate rows must be deleted, a truncated row that stays adds 1. Roles then are nothing, or user and assistant in turn,
    ending with the assistant, after at most one system row (by first letters; a role without one is never kept). Of
    the cheapest edits those whose letters (K, R, D, I) come first in order are taken.

    Null texts and roles are one space; null ids are one conversation. An empty table gives an empty result; other
    columns play no part. Conversations come back as text in ``conv``. One of more than 2^31 edits is too long for ``audit``.
    """
    spark = rows.sparkSession
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    solid = F.rtrim(text, F.lit(SPACE))
    held = rows.select(F.col("conv_id").cast("string").alias("conv"), "turn", role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("tie"), (F.length(solid) == 0).alias("blank"), (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    keys = (F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("tie"))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = held.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered = common.written(ordered.select("conv", "role", "text", "digest", "blank", "truncated", F.monotonically_increasing_id().alias("at")))
    first = ordered.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    block = F.shiftright("at", block_bits).alias("block")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("truncated"), TRUNCATED).otherwise(CLEAN)
    known = ordered.select("conv", "at", _class(F.col("role")).alias("class"), "blank", "truncated").join(first, "at", "left")
    known = known.select("conv", block, "at", F.char(65 + 4 * F.col("class") + fault).alias("code"))
    packed = known.groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("r"))  # no more rows than a block
    segments = common.written(packed.select("conv", "block", F.element_at("r", 1)["at"].alias("at"), F.array_join("r.code", "").alias("codes")))
    whole = segments.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("block", "at", "codes")).alias("s"))
    base = "conv string, block long, at long, codes string, alone boolean"
    result = f"{base}, state int, audit string, cost long, illegal long"
    alone = whole.where("n = 1").select("conv", "s.*", F.lit(True).alias("alone")).mapInPandas(_solved, result)
    many = segments.join(whole.where("n > 1").select(F.col("conv").alias("c")), F.col("conv").eqNullSafe(F.col("c")), "left_semi").withColumn("alone", F.lit(False))
    many = common.written(many.mapInPandas(_weighed, f"{base}, matrix array<long>"))  # those that lie over the end of a block
    back = many.repartition(parts, "conv").sortWithinPartitions("conv", F.desc("block")).mapInPandas(_priced, f"{base}, ends array<long>, last boolean")
    forth = common.written(back.repartition(parts, "conv", "block").mapInPandas(_traced, f"{base}, audits array<string>, costs array<long>, exits array<int>"))
    chosen = forth.repartition(parts, "conv").sortWithinPartitions("conv", "block").mapInPandas(_chosen, result)
    done = common.written(alone.unionByName(chosen))
    count = lambda kind: F.sum(F.length("codes") - F.length(F.translate("codes", "".join(code(r, kind) for r in range(4)), ""))).cast("long")
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], "")
    per = done.groupBy("conv").agg(count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"), F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    return Repair(per, ordered.withColumn("block", block), done)


def _edited(digest: bool):
    """Rows of a block after the edits of their segment; with ``digest`` a hash instead of rows where a conversation is whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, edits, alone, sha, first = START, iter(()), False, None, True
        for b in batches:
            out: list[tuple] = []
            for conv, at, segment, role, text, audit, entered, whole in zip(b["conv"], b["at"], b["segment"], b["role"], b["text"], b["audit"], b["state"], b["alone"], strict=True):
                if segment:
                    state, edits, alone, sha, first = int(entered), iter(re.findall(r"I*[DKR](?:I+$)?", audit)), bool(whole), hashlib.sha256(), True
                    left = len(re.findall("[DKR]", audit))
                    continue
                for sub, letter in enumerate(next(edits)):
                    made = None
                    if letter == "K":
                        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                        made = role, text
                    elif letter != "D":
                        state = DUE[state]
                        made = "user" if state == USER else "assistant", text if letter == "R" else ""
                    if made and digest and alone:
                        sha.update(("" if first else "\n").encode() + f"{made[0]}:{made[1]}".encode())
                        first = False
                    elif made:
                        out.append((conv, at, sub, *made, letter, None))
                left -= 1
                if digest and alone and not left:
                    out.append((conv, at, 0, None, None, None, sha.hexdigest()))
            yield pd.DataFrame(out, columns=["conv", "at", "sub", "role", "text", "edit", "sha256"])

    return run


def _stream(done: Repair, digest: bool) -> DataFrame:
    rows = done.ordered.select("conv", "block", "at", F.lit(False).alias("segment"), "role", "text", F.lit(None).cast("string").alias("audit"), F.lit(0).alias("state"), F.lit(False).alias("alone"))
    marks = done.segments.select("conv", "block", "at", F.lit(True).alias("segment"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", "state", "alone")
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.unionByName(marks).repartition(parts, "block").sortWithinPartitions("block", "at", F.desc("segment"))
    return dealt.mapInPandas(_edited(digest), "conv string, at long, sub int, role string, text string, edit string, sha256 string")


def rows(done: Repair) -> DataFrame:
    """The repaired conversations: conv, at and sub (which give the order), role, text, edit (K, R or I). No conversation is held in one task."""
    return _stream(done, False).drop("sha256")


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, sha = object(), None
    for b in batches:
        out = []
        for c, role, text in zip(b["conv"], b["role"], b["text"], strict=True):
            if c != conv:
                if sha:
                    out.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield pd.DataFrame(out, columns=["conv", "sha256"])
    if sha:
        yield pd.DataFrame([(conv, sha.hexdigest())], columns=["conv", "sha256"])


def digests(done: Repair) -> DataFrame:
    """(conv, sha256) of ``role:text`` of all repaired rows, joined by line feeds; of conversations with any row left.

    A hash reads a conversation in order, so one that lies over blocks is streamed through one task, a batch at a time.
    """
    mixed = common.written(_stream(done, True))
    cross = mixed.where("sha256 is null").repartition("conv").sortWithinPartitions("conv", "at", "sub").select("conv", "role", "text")
    return mixed.where("sha256 is not null").select("conv", "sha256").unionByName(cross.mapInPandas(_hashed, "conv string, sha256 string"))


def report(conversations: DataFrame) -> DataFrame:
    """The damaged conversations and their repair: one row for each conv_id of the table, also where no row is left."""
    bad = damaged(conversations)
    done = repair(bad)
    id_type = conversations.schema["conv_id"].dataType
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    parts = [
        conversations.select(F.col("conv_id").cast("string").alias("conv")).distinct(),
        bad.groupBy(F.col("conv_id").cast("string").alias("conv")).agg(gaps.alias("gaps")),
        done.conversations,
        digests(done),
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    number = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = every.groupBy("conv").agg(*number, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
    return out.select(F.col("conv").cast(id_type).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
