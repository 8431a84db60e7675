"""Conversation structure repair by iterative-deepening A*.

A conversation is a sequence of rows (turn, role, text). It is well formed
when its rows' role initials read ``(s?(ua)+)?`` and no row is blank or a
duplicate. ``repair`` finds the cheapest edits that make it so:

* ``K`` keeps a row (0), ``R`` gives it the role user or assistant (2), ``D``
  deletes it (3; the only edit of a blank or duplicate row), ``I`` inserts a
  user or assistant row without text (2);
* a truncated row that isn't deleted adds 1.

Search: depth first in ASCII order of the edits (D, I, K, R) under a cost
bound that grows by one until a path is accepted, so the first accepted path
is the cheapest and, of the cheapest, the ASCII-least. The bound starts at
the heuristic (3 per row that must go, 1 per truncated row); states (row,
automaton state) that failed with a budget are not entered again with that
budget or less.

A long conversation is searched in chunks of ``CHUNK`` rows: one search per
state before and after a chunk, and the best path into each of the four
states is carried on. That is exact: within one chunk two paths of equal cost
between the same two states can't be prefixes of one another (the longer one
would have more inserts), so least cost first, then ASCII-least, holds chunk
by chunk. Rows are read as a sorted stream: what is held is a chunk, and per
state the audit since the paths part and a running SHA-256.

Defined results. Null role or text: one space (so a null text is blank).
Rows are taken by turn, nulls first; rows of one turn by role, then text.
Rows with a null id are one conversation whose id is null. A conversation
that only has rows marked as absent: zeros, empty audit, digest of nothing.
Repeated rows are duplicates. Empty table: no rows. Other columns are ignored.

One text shuffle, by conversation; both windows and the sort reuse it. A
conversation is one sorted stream in one task, because its SHA-256 is
sequential; nothing is collected, and sorts spill.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
CHUNK = 32
OUT_ROWS = 2_000

# Automaton of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}          # the role an insert or a new role can have
ROLE = {"u": "user", "a": "assistant"}
ACCEPT = (0, 3)


@lru_cache(maxsize=200_000)
def search(symbols: str, start: int, goals: tuple) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest, then ASCII-least path from state
    ``start`` over all symbols into one of ``goals``; None if there is none.

    Symbols: initial ``s u a x`` (x: any other) of a row, upper case when it
    is truncated, ``#`` for a row that must go.
    """
    n = len(symbols)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (3 if symbols[i] == "#" else 1 if symbols[i].isupper() else 0)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def visit(i: int, state: int, left: int) -> bool:
        if least[i] > left or failed.get((i, state), -1) >= left:
            return False
        if i == n and state in goals:
            return True
        for edit, j, into, cost in _edits(symbols, i, state):
            path.append(edit)
            if cost <= left and visit(j, into, left - cost):
                return True
            path.pop()
        failed[i, state] = left
        return False

    for bound in range(least[0], 3 * n + 5):       # all rows deleted and two inserts cost no more
        if visit(0, start, bound):
            return bound, "".join(path)
    return None


def _edits(symbols: str, i: int, state: int):
    """(edit, next row, next state, cost) in ASCII order of the edits."""
    wanted = WANTED[state]
    given = i < len(symbols)
    if given:
        yield "D", i + 1, state, 3
    yield "I", i, STEP[state, wanted], 2
    if given and symbols[i] != "#":
        more = int(symbols[i].isupper())
        into = STEP.get((state, symbols[i].lower()))
        if into is not None:
            yield "K", i + 1, into, more
        yield "R", i + 1, STEP[state, wanted], 2 + more


class _Path:
    """The best path into a state: its cost, its edits since the paths
    part, and the digest of the rows it has given."""

    def __init__(self, cost=0, edits="", sha=None, lines=0):
        self.cost, self.edits, self.sha, self.lines = cost, edits, sha or hashlib.sha256(), lines

    def then(self, state: int, cost: int, edits: str, rows: list) -> _Path:
        out = _Path(self.cost + cost, self.edits + edits, self.sha.copy(), self.lines)
        rows = iter(rows)
        for e in edits:
            role, text = next(rows) if e != "I" else ("", "")
            if e == "D":
                continue
            if e != "K":
                role = ROLE[WANTED[state]]
            state = STEP[state, role[:1]]
            out.sha.update((("\n" if out.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            out.lines += 1
        return out


class Conversation:
    """Reads one conversation's rows in order."""

    def __init__(self, chunk: int = CHUNK):
        self.chunk = chunk
        self.paths = {0: _Path()}
        self.settled: list[str] = []               # edits that all paths share
        self.rows: list = []
        self.symbols: list[str] = []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns = None                          # smallest, largest, number of distinct ones
        self.last = None

    def add(self, turn, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        if len(self.rows) == self.chunk:
            self._flush(None)
        if turn is not None:
            a, z, n = self.turns or (turn, None, 0)
            self.turns = (a, turn, n + (turn != z))
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = initial
        fault = "blank" if blank else "duplicate" if duplicate else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        symbol = "#" if fault in ("blank", "duplicate") else initial if initial in ("s", "u", "a") else "x"
        self.symbols.append(symbol.upper() if fault == "truncated" else symbol)
        self.rows.append((role, text))

    def _flush(self, goals) -> None:
        """Carry the paths over the rows held: into ``goals`` at the end,
        into each state between chunks."""
        symbols, best = "".join(self.symbols), {}
        for start, path in self.paths.items():
            for into in ((goals,) if goals else ((0,), (1,), (2,), (3,))):
                if into == (0,) and start or into == (1,) and start not in (0, 1):
                    continue                       # no edit leads back there
                found = search(symbols, start, into)
                if found is None:
                    continue
                held = best.get(into)
                key = (path.cost + found[0], path.edits + found[1])
                if held is None or key < held[0]:
                    best[into] = (key, start, found)
        self.paths = {into[-1]: self.paths[start].then(start, *found, self.rows) for into, (_, start, found) in best.items()}
        shared = os.path.commonprefix([p.edits for p in self.paths.values()])
        self.settled.append(shared)
        for p in self.paths.values():
            p.edits = p.edits[len(shared):]
        self.rows, self.symbols = [], []

    def result(self) -> dict:
        self._flush(ACCEPT)
        path, = self.paths.values()
        a, z, n = self.turns or (0, -1, 0)
        return {"gaps": z - a + 1 - n, **self.counts, "cost": path.cost, "audit": "".join(self.settled) + path.edits,
                "repaired_sha256": path.sha.hexdigest()}


OUT = T.StructType([T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                   + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")])


def _stream(schema: T.StructType, key: str, chunk: int):
    """Sorted rows -> one result per conversation, across batches."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, conv, started = [], None, None, False
        for batch in batches:
            for at, present, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not started or at != conv:
                    if started:
                        done.append({key: conv, **current.result()})
                    current, conv, started = Conversation(chunk), at, True
                if present:
                    current.add(*row)
            if len(done) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if started:
            done.append({key: conv, **current.result()})
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return run


def repair(rows: DataFrame, *, id_col="conv_id", turn_col="turn", role_col="role", text_col="text",
           present: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256. ``present``: false for rows that
    only name their conversation."""
    src = rows.select(
        F.col(id_col).alias("_c"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("_p"),
        F.col(turn_col).cast("long").alias("_t"), F.coalesce(F.col(role_col), F.lit(" ")).alias("_r"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("_x")).repartition("_c")
    order = [F.asc("_p"), F.asc_nulls_first("_t"), F.asc("_r"), F.asc("_x")]
    same = Window.partitionBy("_c", "_p", "_r", "_x").orderBy(F.asc_nulls_first("_t"))
    ending = F.rtrim(F.col("_x"), F.lit(BLANKS))
    src = src.select("*", (F.row_number().over(same) > 1).alias("_d"), ending.alias("_e"))
    src = src.select("_c", "_p", "_t", "_r", "_x", (F.col("_e") == "").alias("_b"), "_d",
                     (~F.substring("_e", -1, 1).isin(".", "!", "?")).alias("_u"))
    src = src.sortWithinPartitions("_c", *order)
    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), *OUT.fields])
    return src.mapInArrow(_stream(schema, id_col, chunk), schema)
