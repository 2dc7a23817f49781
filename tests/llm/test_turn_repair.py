"""Turn repair against a search over all edits, row by row in plain Python."""

import hashlib
import heapq
import itertools
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import given
from pyspark.sql import functions as F

from millrace.llm import turn_repair as repair
from millrace.llm.queries import damaged

LEADS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Cost and audit of rows (initial, has to go, breaks off): least cost, then least audit."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, at = heapq.heappop(heap)
        if (i, at) in seen:
            continue
        seen.add((i, at))
        if i == len(rows) and at in ("", "a"):
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, DUE[at]))
        if i < len(rows):
            initial, goes, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, at))
            if not goes:
                if (at, initial) in LEADS:
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, LEADS[at, initial]))
                heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, DUE[at]))


def expected(turns):
    """Results of damaged rows (conv, turn, role, text, copies), as the operator gives them."""
    convs = defaultdict(list)
    for conv, turn, role, text, copies in turns:
        convs[conv].extend([(turn, " " if role is None else role, " " if text is None else text)] * copies)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, counts = set(), [], defaultdict(int)
        for _, role, text in rows:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(kinds))
        cost, audit = cheapest(kinds)
        at, lines, rest = "", [], iter(rows)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rest)[1:]
            if edit == "K":
                at = LEADS[at, role[:1]]
                lines.append((role, text))
            elif edit in "RI":
                at = DUE[at]
                lines.append((NAMES[at], text))
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest), lines
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, copies int"


def check(spark, turns):
    want = expected(turns)
    df = spark.createDataFrame(turns, SCHEMA)
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair.repair(df, "copies").collect()}
    assert got == {c: w[0] for c, w in want.items()}
    lines = defaultdict(list)
    for r in repair.repaired_turns(df, "copies").orderBy("conv_id", "position").collect():
        assert r.position == len(lines[r.conv_id])
        lines[r.conv_id].append((r.role, r.text))
    assert dict(lines) == {c: w[1] for c, w in want.items() if w[1]}


def some_turns(n, seed, convs, most_turn):
    pick = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "u"]
    texts = ["Fine.", "Well!", "Is it?", "cut", "", " \t", None, "End. \n", "é.", "a\nb."]
    out = []
    for _ in range(n):
        text = pick.choice(texts) if pick.random() < 0.6 else f"Text {pick.randrange(n)}" + pick.choice([".", ""])
        out.append(
            (pick.choice(convs), pick.choice([None, *range(most_turn)]), pick.choice(roles), text, pick.choice([0, 1, 1, 1, 2]))
        )
    return out


def test_tables_hold_every_short_sequence():
    table = repair.Tables()
    for n in range(4):
        for symbols in itertools.product(range(9), repeat=n):
            rows = [("suax"[s % 4], s == 8, 4 <= s < 8) for s in symbols]
            left, passed, _ = table.solve(bytes(symbols), table.end)
            traced = list(table.trace(bytes(symbols), table.end, 0))
            cost, audit = cheapest(rows)
            assert table.vectors[left][0] + passed + table.end_cost == cost
            assert audit.startswith("".join(e for e, _ in traced))
            to, total = table.summed(bytes(symbols))
            assert to[table.end] == left and total[table.end] == passed


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_block_length_does_not_matter(block):
    pick, one, other = random.Random(block), repair.Tables(), repair.Tables(block)
    for _ in range(200):
        symbols = bytes(pick.randrange(9) for _ in range(pick.randrange(40)))
        assert list(one.trace(symbols, one.end, 0)) == list(other.trace(symbols, other.end, 0))


def test_odd_conversations(spark):
    check(
        spark,
        [
            (1, 0, "system", "Be kind.", 1), (1, 1, "user", "Hi.", 1), (1, 2, "assistant", "Hello.", 1),
            (2, 5, "user", "All gone.", 0),
            (3, None, None, None, 1), (3, None, "user", "Who?", 1), (3, 9, "user", "Who?", 1),
            (None, 1, "assistant", "No number.", 2), (None, None, "user", "same.", 3), (None, 7, "assistant", "cut", 1),
            (4, -(2**62), "user", "far.", 1), (4, 2**62, "assistant", "away.", 1),
            (5, 1, "user", "long. " * 5000, 1), (5, 2, "user", "x" * 20000, 1),
        ],
    )


def test_random_conversations(spark):
    check(spark, some_turns(600, 1, [1, 2, 3, 4, 5, 6, 7, None], 12))
    check(spark, some_turns(300, 2, list(range(60)), 6))


def test_conversations_longer_than_a_chunk(spark, monkeypatch):
    """One conversation holds most rows and lies in many chunks and partitions."""
    monkeypatch.setattr(repair, "CHUNK_ROWS", 7)
    monkeypatch.setattr(repair, "CHUNK_CHARS", 60)
    check(spark, some_turns(1500, 3, [1, 1, 1, 1, 2, None], 900))
    check(spark, [(1, 1, "user", "again.", 50), (1, 2, "assistant", "", 40), (2, 1, "user", "ok.", 1)])


def test_a_hot_conversation_is_split(spark):
    hot = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('Text ', id, '.') AS text"
    )
    chunks = repair._pack(repair._turns(hot, None)).filter("conv_id = 0")
    assert chunks.count() >= 20_000 / repair.CHUNK_ROWS and chunks.filter("whole").count() == 0
    row = repair.repair(hot).filter("conv_id = 0").first()
    assert (row.audit, row.cost, row.illegal, row.gaps) == ("K" * 20_000, 0, 0, 59_998 - 20_000)


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty, "copies").count() == 0
    turns = [(1, 1, "user", "Hi.", 1), (1, 2, "assistant", "Ho", 2)]
    more = spark.createDataFrame(turns, SCHEMA)
    for name in ("digest", "end", "seen", "first", "part", "seq", "right", "audit", "f_conv", "n"):
        more = more.withColumn(name, F.lit(1))
    row = repair.repair(more, "copies").first()
    assert tuple(row[f] for f in FIELDS) == expected(turns)[1][0]


def test_the_given_conversations(spark):
    turns = given(spark, "conversations", "/root/testdata/sf0.01")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    hurt = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text, role = " " if text is None else text, "user" if fault == 4 else " " if role is None else role
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        hurt.append((conv, turn, role, text, {0: 0, 3: 2}.get(fault, 1)))
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair.repair(damaged(turns), "copies").collect()}
    assert got == {c: w[0] for c, w in expected(hurt).items()}
