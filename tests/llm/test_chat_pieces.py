"""Transcripts cut by lines: long turns, rows without a turn number, hot conversations."""

import random

import pytest
from llm_helpers import given
from pyspark.sql import functions as F

from millrace.llm import chat_format as chat
from millrace.llm.queries import transcripts

LINES = "conv_id long, turn long, line int, text string, truth string"


def odd_lines(seed=3):
    """One conversation with most lines, long turns, no turn numbers, repeated rows."""
    pick, lines = random.Random(seed), []
    for t in range(40):
        head = pick.choice(["User: ", "Assistant: ", ""])
        lines += [(1, t, k, f"{head if k == 0 else ''}line {t} {k}{'?' * (k % 2)}", None) for k in range(pick.choice([1, 2, 60]))]
    lines += [(2, None, 0, f"{pick.choice(['User: ', 'AI: ', ''])}no turn {i}", "user") for i in range(150)]
    lines += [(3, 5, 0, "User: the same", "user")] * 40 + [(4, 0, 0, None, None), (None, None, None, "", None)]
    lines += [(None, 2, k, f"unknown {k}", "user") for k in range(30)]
    return lines


def turns(spark, lines, model):
    """Turns with those that a piece cuts put together again."""
    glued = []
    rows = chat.recover(spark.createDataFrame(lines, LINES), model).collect()
    for r in sorted(rows, key=lambda r: (str(r.conv_id), r.chunk, r.piece, r.n)):
        if r.continues:
            conv, role, text, n, right = glued[-1]
            assert (conv, role) == (r.conv_id, r.role)
            glued[-1] = (conv, role, f"{text}\n{r.text}", n + r.n_lines, right + r.n_right)
        else:
            glued.append((r.conv_id, r.role, r.text, r.n_lines, r.n_right))
    return glued, max(r.n_lines for r in rows), max(r.piece for r in rows)


@pytest.mark.parametrize("most", [1, 7, 64])
def test_pieces_change_nothing(spark, monkeypatch, most):
    model = chat.learn(transcripts(given(spark, "conversations")))
    lines = odd_lines()
    monkeypatch.setattr(chat, "PIECE_LINES", 10_000)
    whole, _, last = turns(spark, lines, model)
    assert last == 0 and sum(t[3] for t in whole) == len(lines)
    monkeypatch.setattr(chat, "PIECE_LINES", most)
    got, longest, last = turns(spark, lines, model)
    assert got == whole
    assert longest <= most and last >= 150 // most - 1


def test_lines_of_one_conversation_are_dealt_to_all_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")  # of so few bytes
    rows = spark.range(20_000).selectExpr("1L AS conv_id", "CAST(NULL AS LONG) AS turn", "0 AS line", "concat('t', id) AS text", "'user' AS truth")
    rows = chat.with_features(rows).withColumn("chunk", F.lit(0).cast("long"))
    out = chat._numbered(rows)
    pos = out.agg(F.countDistinct("pos").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high")).first()
    assert (pos.n, pos.low, pos.high) == (20_000, 0, 19_999)
    assert out.groupBy("piece").count().agg(F.max("count")).first()[0] == chat.PIECE_LINES
    shares = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(shares) < 10_000


def test_roles_of_conversations_that_taught_nothing(spark):
    raw = transcripts(given(spark, "conversations", "/root/testdata/sf0.01"))
    held_out = F.crc32(F.col("conv_id").cast("string")) % 3 == 0
    model = chat.learn(raw.filter(~held_out))
    out = chat.recover(chat.split_lines(raw.filter(held_out).withColumnRenamed("role", "truth")), model)
    r = out.agg(F.sum("n_lines").alias("n"), F.sum("n_right").alias("right")).first()
    assert r.n > 500 and r.right >= 0.93 * r.n
