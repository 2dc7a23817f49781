"""Files replaced by newer content, and spikes of daily counts."""

import os
import random
from datetime import date, timedelta
from statistics import median

import pytest
from helpers import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import spikes as S
from millrace.streaming.replaced import ReplaceableTable

LINE = T.StructType([T.StructField("value", T.StringType())])


def lines(spark, files):
    return spark.read.text(files)


def write(folder, name, text, at):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    os.utime(path, (at, at))
    return path


def shown(table, spark):
    return sorted(r.value for r in table.current(spark).collect())


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


def test_newer_content_of_a_path_replaces_the_older(spark, landing, tmp_path):
    table = ReplaceableTable(str(tmp_path / "table"), lines, LINE)
    assert shown(table, spark) == []
    write(landing, "a.txt", "a1\na2\n", 1000)
    write(landing, "sub dir/b+%41.txt", "b1\n", 1000)
    assert table.take_up(spark, landing) == 2
    assert table.take_up(spark, landing) == 0
    assert shown(table, spark) == ["a1", "a2", "b1"]
    write(landing, "a.txt", "a3\n", 2000)
    write(landing, "c.txt", "", 2000)
    assert table.take_up(spark, landing) == 1
    assert shown(table, spark) == ["a3", "b1"]
    # Older by its time, the same length: still other content.
    write(landing, "a.txt", "a4\n", 500)
    assert table.take_up(spark, landing) == 1
    assert shown(table, spark) == ["a4", "b1"]
    assert table.read_ledger(spark).count() == 4


def test_a_run_killed_before_its_note_does_not_count(spark, landing, tmp_path, monkeypatch):
    table = ReplaceableTable(str(tmp_path / "table"), lines, LINE)
    write(landing, "a.txt", "a1\n", 1000)
    table.take_up(spark, landing)
    write(landing, "a.txt", "a2\n", 2000)
    real = spark.createDataFrame

    def killed(data, schema=None, **kw):
        if isinstance(schema, str) and schema.startswith("file"):
            raise KeyboardInterrupt
        return real(data, schema, **kw)

    monkeypatch.setattr(spark, "createDataFrame", killed)
    with pytest.raises(KeyboardInterrupt):
        table.take_up(spark, landing)
    monkeypatch.undo()
    assert shown(table, spark) == ["a1"]
    assert table.take_up(spark, landing) == 1
    assert shown(table, spark) == ["a2"]


@pytest.mark.parametrize(("mirror", "emptied"), [(False, False), (True, False), (False, True), (True, True)])
def test_vanished_and_emptied_files(spark, landing, tmp_path, mirror, emptied):
    table = ReplaceableTable(str(tmp_path / "table"), lines, LINE, mirror)
    path = write(landing, "a.txt", "a1\n", 1000)
    write(landing, "b.txt", "b1\n", 1000)
    table.take_up(spark, landing)
    if emptied:
        write(landing, "a.txt", "", 2000)
    else:
        os.remove(path)
    assert table.take_up(spark, landing) == 0
    assert shown(table, spark) == (["b1"] if mirror else ["a1", "b1"])
    write(landing, "a.txt", "a1\n", 1000)
    assert table.take_up(spark, landing) == int(mirror)
    assert shown(table, spark) == ["a1", "b1"]


def test_several_writes_of_one_run(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.streaming.replaced.FILES_PER_WRITE", 2)
    table = ReplaceableTable(str(tmp_path / "table"), lines, LINE)
    for i in range(5):
        write(landing, f"{i}.txt", f"{i}\n", 1000)
    assert table.take_up(spark, landing) == 5
    assert shown(table, spark) == list("01234")


def expected(counts, span=S.SPAN_DAYS, least=S.LEAST_DAYS, threshold=S.THRESHOLD):
    """(key, date): count, median, deviation, is_spike, by a walk over the days before."""
    first, out = min(d for _, d in counts), {}
    for (key, day), n in counts.items():
        before = [day - timedelta(i) for i in range(1, span + 1)]
        values = [counts.get((key, d), 0) for d in before if d >= first]
        if len(values) < least:
            out[key, day] = (n, None, None, False)
            continue
        m = float(median(values))
        apart = float(median(abs(v - m) for v in values))
        out[key, day] = (n, m, apart, n - m >= threshold * max(apart, 1))
    return out


def found(spark, counts, **settings):
    rows = spark.createDataFrame([(k, d, n) for (k, d), n in counts.items()], "k string, date date, n long")
    return {(r.k, r.date): (r.n, r.median, r.deviation, r.is_spike) for r in S.spikes(rows, "n", ["k"], **settings).collect()}


@pytest.mark.parametrize("part", [S._PART_DAYS, 7, 20])
def test_spikes_against_a_walk(spark, monkeypatch, part):
    monkeypatch.setattr(S, "_PART_DAYS", part)
    pick, start = random.Random(3), date(2024, 2, 20)
    counts = {}
    for key in ("a", "b", None):
        for i in range(60):
            if pick.random() < (0.9 if key != "b" else 0.3):
                counts[key, start + timedelta(i)] = pick.randrange(1, 12) * (20 if i in (15, 40) else 1)
    assert found(spark, counts) == expected(counts)
    assert found(spark, counts, span=3, least=2, threshold=1.5) == expected(counts, 3, 2, 1.5)


def test_an_earlier_spike_does_not_hide_a_later_one(spark):
    start = date(2024, 1, 1)
    counts = {("a", start + timedelta(i)): 10 + i % 2 for i in range(30)}
    counts["a", start + timedelta(10)] = 1000
    counts["a", start + timedelta(13)] = 30
    rose = {d for (_, d), v in found(spark, counts).items() if v[3]}
    assert rose == {start + timedelta(10), start + timedelta(13)}


def test_spikes_of_odd_rows(spark):
    kinds = "date date, n long"
    assert S.spikes(spark.createDataFrame([], kinds), "n").collect() == []
    start = date(1969, 12, 1)  # across the day that parts are counted from
    rows = [(start + timedelta(i), 1) for i in range(60)] + [(start + timedelta(50), 8), (None, 99), (start + timedelta(59), None)]
    out = {r.date: r for r in S.spikes(spark.createDataFrame(rows, kinds), "n").collect()}
    assert [d for d, r in out.items() if r.is_spike] == [start + timedelta(50)]
    assert len(out) == 60 and out[start + timedelta(59)].n == 1


def test_lags_find_what_follows(spark):
    """Edits repeat the course of the events two days later."""
    pick, start = random.Random(5), date(2024, 1, 1)
    course = [pick.randrange(20, 24) + (100 if i in (20, 33, 41) else 0) for i in range(50)]

    def feed(shift):
        rows = [(i + shift, n) for i, n in enumerate(course)]
        days = spark.createDataFrame(rows, "i int, n int").withColumn("event_timestamp", F.date_add(F.lit(start), F.col("i")))
        return days.select("event_timestamp", F.explode(F.sequence(F.lit(1), "n")))

    lags = {r.lag: r for r in S.spike_lags(feed(0), feed(2), threshold=5).collect()}
    assert set(lags) == set(range(-3, 4))
    assert lags[2].r == 1.0 and (lags[2].event_spikes, lags[2].answered, lags[2].n_days) == (3, 3, 50)
    assert all(lags[i].answered == 0 and lags[i].r < 0.5 for i in lags if i != 2)


def test_spikes_stay_in_the_jvm(spark):
    rows = spark.range(40).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("date"), "id")
    text = plan(S.spikes(rows, "id"))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
