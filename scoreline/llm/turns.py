"""Repair of conversations by aligning their turns to the grammar of roles.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles: nothing, or users and
assistants in turn, after a system turn or not. The edits are Keep (0), Rerole to user or assistant (3),
Delete (4, and the only edit of a blank or repeated turn) and Insert of an empty user or
assistant turn (3); a truncated turn that is not deleted adds 3.

All targets of one ending are suffixes of one alternating string. So one Wagner-Fischer table, filled from
the last turn backwards, holds the costs for every feasible length. Ukkonen's argument bounds
its band: no cell whose unavoidable inserts or deletes cost more than a known repair (the
incumbent: rerole in place) can lie on a cheapest path. The lengths of least cost are then traced from
the front, at each step by the least letter that keeps the cost, and their audits compared.

A conversation is read as a stream of blocks of ``BLOCK`` turns. Between blocks only four things can be expected
next (the first turn, a user after the system turn, an assistant, a user or the end), so a block is
aligned for each pair of such states and the best repair up to each state goes on: cost, audit and a running
digest. Two repairs of equal cost that end alike never begin one another, so the
smaller audit stays smaller whatever follows. Memory is that of a block, whatever a conversation's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK = 128
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
#: What is expected next.
FIRST, USER_MUST, ASSISTANT, USER_OR_END = range(4)
_NEVER = 1 << 40
_ROLES = {"u": "user", "a": "assistant"}
_OTHER = {"u": "a", "a": "u"}


class Turn(NamedTuple):
    role: str
    text: str
    removed: bool  # blank or repeated: can only be deleted
    truncated: bool


class _Suffixes:
    """Costs of aligning the turns from each place on to the last k symbols of an alternating string."""

    def __init__(self, turns: list[Turn], last: str, incumbent: int) -> None:
        n, self.last, self.turns = len(turns), last, turns
        width = n + incumbent // INSERT + 1
        symbols = np.array([self.symbol(k) for k in range(1, width + 1)])
        places = np.arange(width + 1)
        self.cost = np.full((n + 1, width + 1), _NEVER)
        self.cost[n] = INSERT * places
        for i in range(n - 1, -1, -1):
            # The band: more symbols than turns left must be inserted, fewer deleted.
            low, high = max(0, n - i - incumbent // DELETE), min(width, n - i + incumbent // INSERT)
            turn = turns[i]
            row = self.cost[i + 1, low:high + 1] + DELETE
            if not turn.removed:
                begin = max(low, 1)
                own = np.where(symbols[begin - 1:high] == turn.role[:1], 0, REROLE) + TRUNCATED * turn.truncated
                row[begin - low:] = np.minimum(row[begin - low:], self.cost[i + 1, begin - 1:high] + own)
            inserts = INSERT * places[low:high + 1]
            self.cost[i, low:high + 1] = np.minimum(np.minimum.accumulate(row - inserts) + inserts, _NEVER)

    def symbol(self, k: int) -> str:
        """The symbol that k symbols before the end of the string begins with."""
        return self.last if k % 2 else _OTHER[self.last]

    def trace(self, i: int, k: int) -> str:
        """The least audit of the cheapest alignments of the turns from ``i`` on to the last ``k`` symbols."""
        made, n = [], len(self.turns)
        while i < n or k:
            cost = self.cost[i, k]
            turn = self.turns[i] if i < n else None
            if turn and self.cost[i + 1, k] + DELETE == cost:
                made.append("D")
                i += 1
            elif k and self.cost[i, k - 1] + INSERT == cost:
                made.append("I")
                k -= 1
            else:
                made.append("K" if turn.role[:1] == self.symbol(k) else "R")
                i, k = i + 1, k - 1
        return "".join(made)


def _incumbent(turns: list[Turn]) -> int:
    """What it costs at most to keep the turns that may stay in place, with other roles where needed, whatever is expected before and after."""
    most = 0
    for due in "ua":
        cost = 2 * INSERT
        for turn in turns:
            if turn.removed:
                cost += DELETE
            else:
                cost += TRUNCATED * turn.truncated + REROLE * (turn.role[:1] != due)
                due = _OTHER[due]
        most = max(most, cost)
    return most


def align(turns: list[Turn], states: set[int]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest cost and least audit from each of ``states`` to each state after the turns."""
    n, best = len(turns), {}
    incumbent = _incumbent(turns)

    def offer(state: int, end: int, cost: int, audit: str) -> None:
        if cost < _NEVER:
            best[state, end] = min(best.get((state, end), (cost, audit)), (cost, audit))

    for end, last in ((USER_OR_END, "a"), (ASSISTANT, "u")):
        table = _Suffixes(turns, last, incumbent)
        costs = table.cost[0]
        for state in states:
            first = "a" if state == ASSISTANT else "u"
            lengths = [k for k in range(len(costs)) if k and table.symbol(k) == first or not k and state == end]
            least = min((int(costs[k]) for k in lengths), default=_NEVER)
            for k in lengths:
                if costs[k] == least < _NEVER:
                    offer(state, end, least, table.trace(0, k))
            if state == FIRST:
                _after_system(turns, table, end, offer)
    if FIRST in states:
        offer(FIRST, FIRST, DELETE * n, "D" * n)
        for i, turn in enumerate(turns):
            if turn.role[:1] == "s" and not turn.removed:
                offer(FIRST, USER_MUST, DELETE * (n - 1) + TRUNCATED * turn.truncated, "D" * i + "K" + "D" * (n - 1 - i))
    if USER_MUST in states:
        offer(USER_MUST, USER_MUST, DELETE * n, "D" * n)
    return best


def _after_system(turns: list[Turn], table: _Suffixes, end: int, offer) -> None:
    """Alignments that keep a system turn first: turns before it are deleted, a user follows."""
    begin = 1 if table.symbol(1) == "u" else 2
    costs = {i: table.cost[i + 1, begin::2] + DELETE * i + TRUNCATED * turn.truncated
             for i, turn in enumerate(turns) if turn.role[:1] == "s" and not turn.removed}
    least = min((int(c.min()) for c in costs.values()), default=_NEVER)
    for i, own in costs.items():
        for place in np.flatnonzero(own == least).tolist():
            offer(FIRST, end, least, "D" * i + "K" + table.trace(i + 1, begin + 2 * place))


def repaired(turns: list[Turn], audit: str, state: int) -> Iterator[str]:
    """The lines ``role:text`` that an audit leaves of the turns, from ``state`` on."""
    due, rest = "a" if state == ASSISTANT else "u", iter(turns)
    for edit in audit:
        turn = None if edit == "I" else next(rest)
        if edit == "D":
            continue
        if edit == "K" and turn.role[:1] == "s":
            yield f"{turn.role}:{turn.text}"
            continue
        yield f"{turn.role if edit == 'K' else _ROLES[due]}:{turn.text if turn else ''}"
        due = _OTHER[due]


@dataclass
class _Path:
    """The best repair so far that ends in one state; the audit in pieces."""

    cost: int = 0
    audit: str = ""
    lines: int = 0
    digest: object = field(default_factory=hashlib.sha256)

    def then(self, cost: int, audit: str, turns: list[Turn], state: int) -> _Path:
        made = _Path(self.cost + cost, self.audit + audit, self.lines, self.digest.copy())
        for line in repaired(turns, audit, state):
            made.digest.update(("\n" if made.lines else "").encode() + line.encode())
            made.lines += 1
        return made


class Conversation:
    """One conversation read turn by turn."""

    def __init__(self) -> None:
        self.paths, self.block = {FIRST: _Path()}, []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = self.first = self.last = None
        self.distinct = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        """The next turn after damage; ``fault`` is blank, duplicate, truncated or nothing."""
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in LEGAL
        self.before = role[:1]
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.block.append(Turn(role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        if len(self.block) == BLOCK:
            self._close()

    def _close(self) -> None:
        found, made = align(self.block, set(self.paths)), {}
        for (state, end), (cost, audit) in found.items():
            path = self.paths[state]
            rank = (path.cost + cost, path.audit + audit)
            if end not in made or rank < made[end][0]:
                made[end] = (rank, state, cost, audit)
        self.paths = {end: self.paths[state].then(cost, audit, self.block, state) for end, (_, state, cost, audit) in made.items()}
        self.block = []

    def result(self) -> dict:
        if self.block:
            self._close()
        # The two ends that the grammar allows.
        path = min((self.paths[state] for state in (FIRST, USER_OR_END) if state in self.paths), key=lambda p: (p.cost, p.audit))
        return {"gaps": 0 if self.first is None else self.last - self.first + 1 - self.distinct, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "cost": path.cost, "audit": path.audit, "repaired_sha256": path.digest.hexdigest()}


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its faults, the cheapest repair as an audit, and the digest of the repaired turns.

    Turns are taken by number, NULL first; of one number by role, then text. A NULL role or text counts
    as one blank. A blank turn has nothing but blanks; a repeated one has a role and text seen earlier in its
    conversation; a truncated one does not end in a full stop, question or exclamation mark; the first fault counts.
    Rows whose boolean column ``gone`` is true (if there is one) only say that their conversation exists: without
    other rows it has zeros, an empty audit and the digest of nothing. A NULL conversation is one too. Repeated rows
    are repeated turns; texts of any length are read whole; an empty input gives no rows; other columns are not read.
    A conversation is streamed through one task in sorted order and need not fit in memory, but for its audit.
    """
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in turns.columns else F.lit(False)
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("text"), gone.alias("gone"))
    earlier = Window.partitionBy("conv", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    content = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = (F.when(content == "", "blank").when(F.row_number().over(earlier) > 1, "duplicate")
             .when(~F.substring(content, -1, 1).isin(".", "!", "?"), "truncated"))
    kind = dict(rows.dtypes)["conv"]
    ship_package(turns.sparkSession)
    marked = rows.withColumn("fault", fault)
    ordered = marked.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")

    def rows_of(batch: pa.RecordBatch):
        return zip(*[batch.column(n).to_pylist() for n in ("conv", "turn", "role", "text", "gone", "fault")], strict=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, current, done = None, None, []
        for batch in batches:
            for key, number, who, said, is_gone, wrong in rows_of(batch):
                if own is None or key != current:
                    if own is not None:
                        done.append({"conv": current} | own.result())
                    own, current = Conversation(), key
                if not is_gone:
                    own.add(number, who, said, wrong)
            schema = pa.schema([batch.schema.field("conv"), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
        if own is not None:
            yield pa.RecordBatch.from_pylist([{"conv": current} | own.result()], schema)

    made = ordered.mapInArrow(work, f"conv {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string")
    return made.withColumnRenamed("conv", conv)


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Harm turns by the hash of ``conv:turn``: one in twenty each is dropped (``gone``), emptied, loses its sentence ends, is repeated, is given to the user."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    harm = F.crc32(F.concat(known(conv), F.lit(":"), known(turn)).cast("binary")) % 20
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), known(role).alias("role"), known(text).alias("text"), harm.alias("harm"))
    said = F.when(F.col("harm") <= 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"),
                       (F.col("harm") == 0).alias("gone"), F.explode(copies).alias("_copy")).drop("_copy")


def op12_turns(turns: DataFrame) -> DataFrame:
    return repair(damage(turns))
