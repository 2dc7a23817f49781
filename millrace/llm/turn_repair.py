"""Repair of the turn structure of conversations by Four-Russians block tables.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``. Every row is
kept (free), given the role that is due (3) or deleted (4); an empty turn of the role that
is due may be put in anywhere (3). Blank and duplicate rows have to go; a row whose text
breaks off costs 3 more unless it goes.

What the rest of a conversation costs from each of the four states of that pattern differs
by small amounts only, so after subtracting its least entry a cost vector is one of a few
dozen. For each of them and each block of ``BLOCK`` row symbols the vector before the block
is worked out beforehand; a conversation is then solved from its end by one lookup a block.
Tracing goes forward: the vectors inside a block are expanded backward from its right edge,
and at each row the ASCII-least of the cheapest edits is taken, which gives the least audit
string, as every edit leaves one state only.

A conversation may be of any length. Rows are put in order by range, so a long conversation
lies in several partitions, and packed into chunks of bounded size. A chunk of a conversation
that goes on elsewhere is summed up as a map from the vector at its right edge to that at its
left; these maps are run through from right to left, one small row a chunk, and the chunks
then edited in order. That last run, in which the hash of the repaired text grows, holds one
chunk and the audit at a time; a hash over a whole conversation cannot be split.

Defined results: NULL roles and texts count as one space. Rows go by turn, NULL first, then
role and text; repeated rows stand side by side, and ``copies`` rows may be given as one. A
row with 0 copies adds no turn but names its conversation, which then has a result. A NULL
conv_id is a conversation like others. A role is known by its first character; an empty one
fits nowhere. Columns other than those named are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.rows import durable

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
CUT_SHORT = 3

# Symbols: the role's initial, plus 4 if the text breaks off; or a row that has to go.
_SYMBOL_OF = {"s": 0, "u": 1, "a": 2}
_OTHER, _CUT, _GONE, _SYMBOLS = 3, 4, 8, 9
# States: nothing yet, after s, after u, after a. Where an initial leads, and what is due.
_STATES = 4
_START, _AFTER_A = 0, 3
_LEADS = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_DUE = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
_LEGAL = frozenset({"su", "ua", "au"})

BLOCK = 4
CHUNK_ROWS = 4_096
CHUNK_CHARS = 4 << 20
_LONG = (1 << 63) - 1

# Characters between words.
SPACE = " \t\n\x0b\x0c\r"


def _settle(costs: list[int]) -> list[int]:
    """Costs once turns may be put in first."""
    for _ in range(_STATES):
        costs = [min(c, COST[INSERT] + costs[_DUE[q][0]]) for q, c in enumerate(costs)]
    return costs


def _choices(symbol: int, state: int, after: list[int]) -> Iterator[tuple[str, int, int]]:
    """Edits of a row in a state: letter, cost from there on, next state."""
    yield DELETE, COST[DELETE] + after[state], state
    if symbol != _GONE:
        extra = CUT_SHORT if symbol >= _CUT else 0
        to = _LEADS.get((state, symbol % _CUT))
        if to is not None:
            yield KEEP, COST[KEEP] + extra + after[to], to
        to = _DUE[state][0]
        yield REROLE, COST[REROLE] + extra + after[to], to


def _before(symbol: int, after: list[int]) -> list[int]:
    """Cheapest cost from each state before a row, given those after it."""
    return _settle([min(c for _, c, _ in _choices(symbol, q, after)) for q in range(_STATES)])


class Tables:
    """The vectors that occur, and how rows and blocks of rows lead from one to another."""

    def __init__(self, block: int = BLOCK):
        end = _settle([0 if q in (_START, _AFTER_A) else 99 for q in range(_STATES)])
        self.block = block
        self.vectors, known = [], {}

        def number(vector: list[int]) -> tuple[int, int]:
            least = min(vector)
            key = tuple(c - least for c in vector)
            if key not in known:
                known[key] = len(self.vectors)
                self.vectors.append(key)
            return known[key], least

        self.end, self.end_cost = number(end)
        to, cost, at = [], [], 0
        while at < len(self.vectors):
            step = [number(_before(s, list(self.vectors[at]))) for s in range(_SYMBOLS)]
            to.append([v for v, _ in step])
            cost.append([c for _, c in step])
            at += 1
        one, one_cost = np.array(to, np.int32), np.array(cost, np.int32)
        self.one = to
        # Blocks are numbered by their symbols as digits; the leftmost is passed last.
        self.to, self.cost = [None, one], [None, one_cost]
        for _ in range(1, block):
            rest, rest_cost = self.to[-1], self.cost[-1]
            longer = one[rest]  # vector, rest, first symbol
            total = rest_cost[:, :, None] + one_cost[rest]
            self.to.append(longer.transpose(0, 2, 1).reshape(len(one), -1))
            self.cost.append(total.transpose(0, 2, 1).reshape(len(one), -1))
        self.to_list = [None, *(t.tolist() for t in self.to[1:])]
        self.cost_list = [None, *(t.tolist() for t in self.cost[1:])]
        # Edits of a row with what is put in before it, by vector after it, symbol, state.
        self.edits = [
            [[self._edit(list(v), s, q) for q in range(_STATES)] for s in range(_SYMBOLS)] for v in self.vectors
        ]
        self.last = [self._last(end, q) for q in range(_STATES)]

    @staticmethod
    def _edit(after: list[int], symbol: int, state: int) -> tuple[str, int]:
        costs, out = _before(symbol, after), ""
        while True:
            best = [(edit, to) for edit, cost, to in _choices(symbol, state, after) if cost == costs[state]]
            due = _DUE[state][0]
            if COST[INSERT] + costs[due] == costs[state]:
                best.append((INSERT, due))
            edit, state = min(best)
            out += edit
            if edit != INSERT:
                return out, state

    @staticmethod
    def _last(end: list[int], state: int) -> str:
        """Turns put in after the last row."""
        out = ""
        while end[state]:
            out, state = out + INSERT, _DUE[state][0]
        return out

    def codes(self, symbols: bytes) -> tuple[list[int], int]:
        """Block numbers of the symbols, and the length of the first block, the short one."""
        first = len(symbols) % self.block
        code = 0
        for s in symbols[:first]:
            code = code * _SYMBOLS + s
        digits = np.frombuffer(symbols, np.uint8)[first:].reshape(-1, self.block).astype(np.int64)
        whole = digits @ (_SYMBOLS ** np.arange(self.block - 1, -1, -1))
        return ([code] if first else []) + whole.tolist(), first

    def solve(self, symbols: bytes, right: int) -> tuple[int, int, list[int]]:
        """Vector before the symbols, the cost passed, and the vector right of each block."""
        codes, first = self.codes(symbols)
        to, cost = self.to_list[self.block], self.cost_list[self.block]
        total, edges = 0, []
        for n in range(len(codes) - 1, -1, -1):
            edges.append(right)
            if n == 0 and first:
                to, cost = self.to_list[first], self.cost_list[first]
            code = codes[n]
            total += cost[right][code]
            right = to[right][code]
        edges.reverse()
        return right, total, edges

    def summed(self, symbols: bytes) -> tuple[list[int], list[int]]:
        """What ``solve`` gives for each vector on the right: vector before, cost passed."""
        at = np.arange(len(self.vectors))
        total = np.zeros(len(at), np.int64)
        codes, first = self.codes(symbols)
        for n in range(len(codes) - 1, -1, -1):
            length = first if n == 0 and first else self.block
            total += self.cost[length][at, codes[n]]
            at = self.to[length][at, codes[n]]
        return at.tolist(), total.tolist()

    def trace(self, symbols: bytes, right: int, state: int) -> Iterator[tuple[str, int]]:
        """Edits of each row, inserted turns before it first, and the state before these."""
        _, _, edges = self.solve(symbols, right)
        n = len(symbols) % self.block
        blocks = ([symbols[:n]] if n else []) + [symbols[i : i + self.block] for i in range(n, len(symbols), self.block)]
        for block, edge in zip(blocks, edges):
            after = [edge] * len(block)
            for i in range(len(block) - 1, 0, -1):
                after[i - 1] = self.one[after[i]][block[i]]
            for symbol, vector in zip(block, after):
                edits, to = self.edits[vector][symbol][state]
                yield edits, state
                state = to


@functools.lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# Faults and rows ----------------------------------------------------------------------------


def _turns(turns: DataFrame, copies: str | None) -> DataFrame:
    """Distinct rows with their number, what their text ends in, and whether they came before."""
    many = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    own = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), many.alias("copies")
    )
    empty = F.col("copies") <= 0
    bare = [F.when(~empty, F.col(c)).alias(c) for c in ("turn", "role", "text")]
    rows = own.select("conv_id", *bare, "copies").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    rows = rows.select("*", F.md5("text").alias("digest"), end.alias("end"))
    # Most texts stand in one turn only; the others are told their first.
    firsts = rows.filter("role IS NOT NULL").groupBy("conv_id", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("first")
    )
    firsts = firsts.filter("n > 1").select(
        F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), "unnumbered", "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    seen = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    return rows.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", "end", F.coalesce(seen, F.lit(False)).alias("seen")
    )


class _Chunk:
    """Rows of one conversation side by side."""

    def __init__(self, conv):
        self.conv = conv
        self.symbols, self.roles, self.texts = bytearray(), [], []
        self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = None
        self.first = self.last = None  # initials

    def full(self) -> bool:
        return len(self.symbols) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def _note(self, turn, initial, n=1):
        if self.first is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        # Two equal initials in a row are never right.
        self.illegal += n - 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn

    def gone(self, turn, role, n, blank):
        self._note(turn, role[:1], n)
        self.symbols += bytes([_GONE]) * n
        if blank:
            self.blank += n
        else:
            self.duplicate += n

    def add(self, turn, role, text, end):
        self._note(turn, role[:1])
        cut = end not in ".!?"
        self.truncated += cut
        self.symbols.append(_SYMBOL_OF.get(role[:1], _OTHER) + _CUT * cut)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)


_NUMBERS = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
_PACKED = (
    "part int, seq long, whole boolean, symbols binary, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, "
    "first string, last string, to array<int>, cost array<long>"
)
_KINDS = {
    "part": pa.int32(), "seq": pa.int64(), "whole": pa.bool_(), "symbols": pa.binary(),
    "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
    **{n: pa.int64() for n in _NUMBERS},
    "first": pa.string(), "last": pa.string(), "to": pa.list_(pa.int32()), "cost": pa.list_(pa.int64()),
}


def _batch(rows: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kinds.items()], names=list(kinds))


def _bounded(rows: Iterable[dict], kinds: dict, size) -> Iterator[pa.RecordBatch]:
    held, out = 0, []
    for row in rows:
        out.append(row)
        held += size(row)
        if held >= CHUNK_CHARS or len(out) >= 2_000:
            yield _batch(out, kinds)
            held, out = 0, []
    yield _batch(out, kinds)


def _cells(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _pack(rows: DataFrame) -> DataFrame:
    """Chunks of all conversations in order; ``whole`` ones are all of theirs."""
    field, names = rows.schema["conv_id"].dataType, rows.columns
    kinds = {"conv_id": to_arrow_type(field)} | _KINDS

    def chunks(batches) -> Iterator[tuple[_Chunk, bool, int]]:
        """Each chunk with whether its conversation lies in it alone, for all we can see here."""
        chunk, begun, n = None, True, 0  # begun: the conversation may have begun before
        for conv, turn, role, text, copies, end, seen in _cells(batches, names):
            if chunk is not None and conv != chunk.conv:
                yield chunk, not begun, n
                chunk, begun, n = None, False, n + 1
            if chunk is None:
                chunk = _Chunk(conv)
            if role is None:
                continue
            if end and not seen:
                if chunk.full():
                    yield chunk, False, n
                    chunk, begun, n = _Chunk(conv), True, n + 1
                chunk.add(turn, role, text, end)
                copies -= 1
            while copies:
                if chunk.full():
                    yield chunk, False, n
                    chunk, begun, n = _Chunk(conv), True, n + 1
                take = min(copies, CHUNK_ROWS - len(chunk.symbols)) if len(chunk.symbols) < CHUNK_ROWS else 1
                chunk.gone(turn, role, take, blank=not end)
                copies -= take
        if chunk is not None:
            yield chunk, False, n  # it may go on in the next partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table = TaskContext.get().partitionId(), tables()

        def packed():
            for c, whole, n in chunks(batches):
                to, cost = (None, None) if whole else table.summed(bytes(c.symbols))
                yield {
                    "conv_id": c.conv, "part": part, "seq": n, "whole": whole, "symbols": bytes(c.symbols),
                    "roles": c.roles, "texts": c.texts, "first": c.first, "last": c.last, "to": to, "cost": cost,
                    "_chars": c.chars + 50 * len(c.symbols),
                } | {k: getattr(c, k) for k in _NUMBERS}

        yield from _bounded(packed(), kinds, lambda r: r["_chars"])

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, f"conv_id {field.simpleString()}, {_PACKED}")


def _right_edges(chunks: DataFrame) -> DataFrame:
    """The vector right of each chunk and the cost from there to the conversation's end."""
    field = chunks.schema["conv_id"].dataType
    kinds = {"r_part": pa.int32(), "r_seq": pa.int64(), "right": pa.int32(), "beyond": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tables()

        def edges():
            conv, fresh = None, True
            for c, part, seq, to, cost in _cells(batches, ["conv_id", "part", "seq", "to", "cost"]):
                if fresh or c != conv:
                    conv, fresh, right, beyond = c, False, table.end, table.end_cost
                yield {"r_part": part, "r_seq": seq, "right": right, "beyond": beyond}
                beyond += cost[right]
                right = to[right]

        yield from _bounded(edges(), kinds, lambda r: 16)

    ordered = chunks.select("conv_id", "part", "seq", "to", "cost").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    return ordered.mapInArrow(run, "r_part int, r_seq long, right int, beyond long")


class _Digest:
    """What becomes of a conversation, summed up."""

    kinds = {n: pa.int64() for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {
        "audit": pa.string(), "repaired_sha256": pa.string()
    }
    schema = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def __init__(self, conv, cost: int):
        self.conv, self.cost = conv, cost
        self.audit, self.hash, self.any = [], hashlib.sha256(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def chunk(self, c: dict) -> None:
        for n in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, n, getattr(self, n) + c[n])
        if c["first"] is not None:
            self.illegal += self.last is not None and self.last + c["first"] not in _LEGAL
            self.last = c["last"]
        if c["low"] is not None:
            self.turns += c["turns"] - (c["low"] == self.high)
            self.low = c["low"] if self.low is None else self.low
            self.high = c["high"]

    def edits(self, letters: str) -> None:
        self.audit.append(letters)

    def line(self, role: str, text: str, edit: str) -> Iterator[dict]:
        if self.any:
            self.hash.update(b"\n")
        self.any = True
        self.hash.update(f"{role}:{text}".encode())
        return iter(())

    def close(self) -> Iterator[dict]:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, _LONG)
        yield {
            "conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(), "_size": 300,
        }


class _Lines:
    """The repaired turns of a conversation."""

    kinds = {"position": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}
    schema = "position long, role string, text string, edit string"

    def __init__(self, conv, cost: int):
        self.conv, self.n = conv, 0

    def chunk(self, c: dict) -> None:
        pass

    def edits(self, letters: str) -> None:
        pass

    def line(self, role: str, text: str, edit: str) -> Iterator[dict]:
        yield {"conv_id": self.conv, "position": self.n, "role": role, "text": text, "edit": edit, "_size": 50 + len(text)}
        self.n += 1

    def close(self) -> Iterator[dict]:
        return iter(())


def _follow(chunks: Iterable[dict], table: Tables, kind: type) -> Iterator[dict]:
    """Edit chunks that come conversation by conversation and in order."""
    sink, state = None, _START

    def put_in(letters):
        nonlocal state
        for _ in letters:
            state, role = _DUE[state]
            yield from sink.line(role, "", INSERT)

    def finish():
        sink.edits(table.last[state])
        yield from put_in(table.last[state])
        yield from sink.close()

    for c in chunks:
        if sink is None or c["conv_id"] != sink.conv:
            if sink is not None:
                yield from finish()
            left, passed, _ = table.solve(c["symbols"], c["right"])
            state = _START
            sink = kind(c["conv_id"], table.vectors[left][_START] + passed + c["beyond"])
        sink.chunk(c)
        stay = zip(c["roles"], c["texts"])
        for (edits, at), symbol in zip(table.trace(c["symbols"], c["right"], state), c["symbols"]):
            role, text = next(stay) if symbol != _GONE else (None, None)
            sink.edits(edits)
            state = at
            yield from put_in(edits[:-1])
            if edits[-1] == KEEP:
                state = _LEADS[state, symbol % _CUT]
                yield from sink.line(role, text, KEEP)
            elif edits[-1] == REROLE:
                state, role = _DUE[state]
                yield from sink.line(role, text, REROLE)
    if sink is not None:
        yield from finish()


def _solved(turns: DataFrame, copies: str | None, kind: type) -> DataFrame:
    chunks = _pack(_turns(turns, copies)).transform(durable)
    field = turns.schema["conv_id"].dataType
    kinds = {"conv_id": to_arrow_type(field)} | kind.kinds
    names = ["conv_id", "symbols", "roles", "texts", *_NUMBERS, "first", "last", "right", "beyond"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(names, cells)) for cells in _cells(batches, names))
        yield from _bounded(_follow(rows, tables(), kind), kinds, lambda r: r["_size"])

    table = tables()
    end = [F.lit(table.end).alias("right"), F.lit(table.end_cost).cast("long").alias("beyond")]
    whole = chunks.filter("whole").select("*", *end).select(*names)
    parted = chunks.filter("NOT whole")
    edges = _right_edges(parted)
    parted = parted.join(edges, (F.col("part") == F.col("r_part")) & (F.col("seq") == F.col("r_seq")))
    parted = parted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select(*names)
    schema = f"conv_id {field.simpleString()}, {kind.schema}"
    return whole.mapInArrow(run, schema).unionByName(parted.mapInArrow(run, schema))


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): its faults and its repair.

    gaps (turn numbers left out), blank, duplicate and truncated (rows by first fault),
    illegal (neighbours out of order), cost and audit (the edits), and the SHA-256 of the
    repaired ``role:text`` lines.
    """
    return _solved(turns, copies, _Digest)


def repaired_turns(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired turns themselves: conv_id, position from 0, role, text, edit."""
    return _solved(turns, copies, _Lines)
