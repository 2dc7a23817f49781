import io
import json
import zipfile

import pytest
from helpers import edits, events, plan
from pyspark.sql import functions as F

from millrace.schemas import CORRUPT, EDIT_SCHEMA, EVENT_SCHEMA, RESCUED
from millrace.sources import (
    archives,
    first_events,
    gaps,
    landed_deliveries,
    manifest,
    manifest_between,
    misnamed_files,
    member_events,
    members,
    parse_sse,
    publish_table,
    read_archives,
    read_edits,
    read_events,
    read_lines,
    readable,
    slot_of,
    sse_payloads,
    start_payload_batches,
    unreadable,
    unreadable_archives,
    unzip,
    write_json_batches,
    write_members,
    write_payload_batches,
)


def tsv(**cells):
    row = {"Global_Event_ID": "1", "SQL_Date": "20240705"} | cells
    return "\t".join(row.get(n, "") for n in EVENT_SCHEMA.names)


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


# --- tab-separated exports ------------------------------------------------------------


def test_empty_fields_are_null(spark, tmp_path):
    path = put(tmp_path / "raw", "a.CSV", tsv(Actor1_Name="", Actor1_Code='""', Event_Code="057"))
    row = read_events(spark, path).first()
    assert row["Actor1_Name"] is None and row["Actor1_Code"] is None and row["Event_Code"] == "057"


def test_malformed_rows_are_kept(spark, tmp_path):
    lines = [
        tsv(Global_Event_ID="1", Source_URL="u"),
        "2\t20240705",
        tsv(Global_Event_ID="3", Source_URL="u") + "\textra\tmore",
        tsv(Global_Event_ID="4", Quad_Class="x", Source_URL="u"),
    ]
    path = put(tmp_path / "raw", "a.CSV", *lines)
    df = read_events(spark, path, corrupt=True)
    rows = {r["Global_Event_ID"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[2]["Source_URL"] is None and rows[3]["Source_URL"] == "u"
    assert rows[4]["Quad_Class"] is None and rows[4]["Source_URL"] == "u"
    assert {i for i, r in rows.items() if r[CORRUPT] is not None} == {2, 3, 4}
    assert len(read_events(spark, path).columns) == 61


def test_unbalanced_quote(spark, tmp_path):
    path = put(tmp_path / "raw", "a.CSV", tsv(Actor1_Name='"un', Actor1_Country_Code="bal"))
    assert read_events(spark, path).first()["Actor1_Country_Code"] is None
    literal = read_events(spark, path, quote="").first()
    assert literal["Actor1_Name"] == '"un' and literal["Actor1_Country_Code"] == "bal"


# --- change records -------------------------------------------------------------------


RECORDS = [
    {"id": 1, "log_params": {"a": 1}, "length": {"new": 2}, "$schema": "/s"},
    {"id": 2, "length": None, "extra": 1, "deep": {"x": [1]}},
    {"id": 3, "length": {}},
    {"id": "four", "title": "T"},
]


def test_json_edges(spark, tmp_path):
    path = put(tmp_path / "raw", "a.json", *map(json.dumps, RECORDS))
    rows = read_edits(spark, path, corrupt=True).collect()
    by_id = {r["id"]: r for r in rows}
    assert by_id[1]["log_params"] == '{"a": 1}' and by_id[1]["length"].new == 2
    assert by_id[1]["$schema"] == "/s"
    assert by_id[2]["length"] is None and by_id[3]["length"] == (None, None)
    assert by_id[None]["title"] == "T"
    assert read_edits(spark, path).schema == EDIT_SCHEMA


def test_rescue_keeps_what_did_not_fit(spark, tmp_path):
    path = put(tmp_path / "raw", "a.json", *map(json.dumps, RECORDS))
    rows = read_edits(spark, path, rescue=True).select("id", "title", RESCUED).collect()
    rescued = {r["id"]: r[RESCUED] and json.loads(r[RESCUED]) for r in rows}
    assert rescued == {1: None, 2: {"extra": "1", "deep": '{"x":[1]}'}, 3: None, None: {"id": "four"}}


def test_rescue_reaches_nested_objects(spark, tmp_path):
    lines = [
        '{"id":1,"meta":{"dt":"d","zzz":1},"length":{"new":"long","old":3}}',
        '{"id":2,"meta":{"dt":"d","offset":null},"revision":null}',
        '{"id":3,"meta":5,"more":[1]}',
    ]
    path = put(tmp_path / "raw", "a.json", *lines)
    rows = {r["id"]: r for r in read_edits(spark, path, rescue=True).collect()}
    rescued = {i: r[RESCUED] and json.loads(r[RESCUED]) for i, r in rows.items()}
    assert {k: json.loads(v) for k, v in rescued[1].items()} == {"meta": {"zzz": "1"}, "length": {"new": "long"}}
    assert rescued[2] is None and rescued[3] == {"meta": "5", "more": "[1]"}
    assert rows[1]["length"].old == 3 and rows[1]["meta"].dt == "d"


TRANSCRIPT = [
    "event: message",
    'id: [{"topic":"t","offset":1}]',
    'data: {"id":1,"title":"A","wiki":"enwiki","timestamp":1720000000,"meta":{"dt":"d"}}',
    "",
    'data:{"id":2,"title":"B","wiki":"enwiki","timestamp":1720000060}',
    ":heartbeat",
    "data: not json",
]


@pytest.mark.parametrize("stream", [False, True])
def test_sse_transcript(spark, tmp_path, stream):
    path = put(tmp_path / "raw", "a.txt", *TRANSCRIPT)
    parsed = parse_sse(read_lines(spark, path, stream=stream))
    if stream:
        out = str(tmp_path / "out")
        writer = parsed.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start(out).awaitTermination()
        parsed = spark.read.parquet(out)
    good = {r["id"]: r for r in readable(parsed).collect()}
    assert set(good) == {1, 2} and good[1]["meta"].dt == "d"
    assert [r[0] for r in unreadable(parsed).collect()] == ["not json"]


def test_sse_odd_payloads(spark):
    payloads = ["", "5", "[1]", '[{"id":9}]', '{"id":1', '{"id":"x"}', '{"unknown":1}', "null", '"a"']
    lines = spark.createDataFrame([(f"data: {p}",) for p in payloads], "value string")
    parsed = parse_sse(lines)
    assert sorted(r[0] for r in unreadable(parsed).collect()) == sorted(
        ["", "5", "[1]", '[{"id":9}]', '{"id":1', "null", '"a"']
    )
    assert [r["id"] for r in readable(parsed).collect()] == [None, None]


def test_sse_drops_bad_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b'data: {"id":1,"title":"a\xffb"}\n')
    parsed = parse_sse(read_lines(spark, str(tmp_path)))
    assert readable(parsed).first()["title"] == "ab"


# --- delivery calendar ----------------------------------------------------------------


def test_manifest(spark):
    df = manifest(spark, "20250701030000", "20250713000000")
    assert df.count() == 1141
    row = df.orderBy("slot").first()
    assert (row["stamp"], row["file_name"]) == ("20250701030000", "20250701030000.export.CSV.zip")
    assert manifest(spark, "20250701030000", "20250701030000").count() == 1
    assert manifest(spark, "20250702000000", "20250701000000").count() == 0


def test_manifest_from_data_and_gaps_with_a_hot_slot(spark):
    landed = spark.sql(
        """
        SELECT CAST(x AS TIMESTAMP_NTZ) AS ts FROM VALUES ('2024-01-01 00:07:00'),
          ('2024-01-01 00:44:59.9'), ('2024-01-01 01:00:00') t(x)
        UNION ALL SELECT TIMESTAMP_NTZ'2024-01-01 00:31:00' FROM range(50000)
        """
    ).select(slot_of(F.col("ts")).alias("slot"))
    bounds = landed.agg(F.min("slot").alias("start"), F.max("slot").alias("end"))
    missing = gaps(manifest_between(bounds), landed)
    assert sorted(r["stamp"] for r in missing.collect()) == ["20240101001500", "20240101004500"]


def test_landed_deliveries(spark, tmp_path):
    names = ["20240101000000.export.CSV.zip", "20240101003000.export.CSV.zip"]
    odd = ["20241399000000.export.CSV.zip", "x.zip", "120240101001500.export.CSV.zip", "20240101001500.export.CSV.zip.tmp"]
    names += odd
    for name in names:
        (tmp_path / name).write_bytes(b"?")
    landed = landed_deliveries(spark, str(tmp_path))
    assert sorted(r[0].split("/")[-1] for r in misnamed_files(spark, str(tmp_path)).collect()) == sorted(odd)
    missing = gaps(manifest(spark, "20240101000000", "20240101004500"), landed)
    assert sorted(r["stamp"] for r in missing.collect()) == ["20240101001500", "20240101004500"]
    (columns,) = [c for c in plan(landed).splitlines() if "ReadSchema" in c] or [plan(landed)]
    assert "content" not in columns


# --- archives -------------------------------------------------------------------------


def zipped(**members_):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members_.items():
            z.writestr(name.replace("__", "."), body)
    return buffer.getvalue()


@pytest.fixture
def archive_dir(tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    (folder / "a.zip").write_bytes(
        zipped(a__CSV=tsv(Global_Event_ID="1") + "\r\n" + tsv(Global_Event_ID="2") + "\n", readme__txt="x\n")
    )
    many = "\n".join(tsv(Global_Event_ID=str(i)) for i in range(10, 45010))
    (folder / "b.zip").write_bytes(zipped(b__CSV=many, c__CSV=tsv(Global_Event_ID="3")))
    (folder / "bad.zip").write_bytes(b"no archive")
    damaged = bytearray(zipped(d__CSV=tsv(Global_Event_ID="99") * 50))
    damaged[60] ^= 0xFF
    (folder / "damaged.zip").write_bytes(bytes(damaged))
    return str(folder)


def test_unzip(spark, archive_dir):
    lines = unzip(read_archives(spark, archive_dir))
    ids = [r[0] for r in member_events(lines).select("Global_Event_ID").collect()]
    assert sorted(ids) == [1, 2, 3, *range(10, 45010)]
    bad = {r["archive"].split("/")[-1]: r["error"] for r in unreadable_archives(lines).collect()}
    assert set(bad) == {"bad.zip", "damaged.zip"} and "BadZipFile" in bad["bad.zip"]


def packed(method, names, damage=()):
    """An archive of members of 2,000 lines each, with the content of some overwritten."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as z:
        for k, name in enumerate(names):
            z.writestr(name, "".join(tsv(Global_Event_ID=str(10_000 * k + i), Source_URL=f"u{i * 7919 % 9973}") + "\n" for i in range(2000)))
        starts = {i.filename: i.header_offset + 30 + len(i.filename) for i in z.infolist()}
        sizes = {i.filename: i.compress_size for i in z.infolist()}
    data = bytearray(buffer.getvalue())
    for name in damage:
        middle = starts[name] + sizes[name] // 2
        data[middle : middle + 40] = bytes(b ^ 0x5A for b in data[middle : middle + 40])
    return bytes(data)


METHODS = {"stored": zipfile.ZIP_STORED, "deflate": zipfile.ZIP_DEFLATED, "bzip2": zipfile.ZIP_BZIP2, "lzma": zipfile.ZIP_LZMA}


@pytest.mark.parametrize("held", [0, 1 << 30])
def test_a_damaged_member_costs_only_itself(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(archives, "HELD_BYTES", held)
    for name, method in METHODS.items():
        (tmp_path / f"{name}.zip").write_bytes(packed(method, ["a.CSV", "b.CSV", "c.CSV"], ["b.CSV"]))
    lines = unzip(read_archives(spark, str(tmp_path)))
    got = lines.groupBy(F.element_at(F.split("archive", "/"), -1).alias("a"), "member").agg(F.count("value"), F.count("error")).collect()
    want = {(f"{n}.zip", f"{m}.CSV", 0 if m == "b" else 2000, 1 if m == "b" else 0) for n in METHODS for m in "abc"}
    assert set(map(tuple, got)) == want


def test_members_of_one_archive_are_unpacked_by_several_tasks(spark, tmp_path, monkeypatch):
    (tmp_path / "a.zip").write_bytes(packed(zipfile.ZIP_DEFLATED, ["a.CSV", "x.txt", "b.CSV", "c.CSV"]))
    found = read_archives(spark, str(tmp_path))

    def tasks():
        lines = members(unzip(found)).select("member", F.spark_partition_id().alias("task"))
        return sorted(tuple(r) for r in lines.distinct().collect())

    assert len({t for _, t in tasks()}) == 1  # small members share a task
    monkeypatch.setattr(archives, "RUN_BYTES", 1)
    split = tasks()
    assert [m for m, _ in split] == ["a.CSV", "b.CSV", "c.CSV"] and len({t for _, t in split}) == 3


def test_sound_members_are_inflated_once(tmp_path, monkeypatch):
    path = tmp_path / "a.zip"
    path.write_bytes(packed(zipfile.ZIP_DEFLATED, ["a.CSV", "b.CSV"], ["b.CSV"]))
    opened = []
    open_member = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, info, *a, **k: opened.append(info.filename) or open_member(self, info, *a, **k))
    out = list(archives._lines_of(f"file:{path}", 0, 1, ".CSV", None))
    assert opened == ["a.CSV", "b.CSV"] and sum(b.num_rows for b in out) == 2001


def test_unzip_as_stream(spark, archive_dir, tmp_path):
    options = {"pathGlobFilter": "*.zip"}
    rows = member_events(unzip(read_archives(spark, archive_dir, stream=True, options=options)))
    out = str(tmp_path / "out")
    for _ in range(2):
        rows.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True
        ).start(out).awaitTermination()
    assert spark.read.parquet(out).count() == 45003


def test_archives_are_opened_by_path_in_one_scan(spark, archive_dir):
    found = read_archives(spark, archive_dir)
    assert found.columns == ["archive"]
    text = plan(unzip(found))
    assert text.count("Scan binaryFile") == 2  # once in the tree, once in the details
    assert "content" not in text.split("ReadSchema")[1].splitlines()[0]


def test_a_store_that_fails_is_no_bad_archive(spark, archive_dir):
    found = read_archives(spark, archive_dir).withColumn("archive", F.concat("archive", F.lit(".gone")))
    with pytest.raises(Exception, match="gone"):
        unzip(found).collect()


def test_a_fault_while_reading_is_not_taken_for_a_bad_archive(archive_dir):
    class Faulty:
        def size(self):
            return 1000

        def tell(self):
            return 0

        def seek(self, position):
            return position

        def read(self, n):
            raise OSError("connection reset")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

    class Store:
        def open_input_file(self, name):
            return Faulty()

    with pytest.raises(OSError, match="connection reset"):
        list(archives._runs_of("file:/x.zip", ".CSV", Store()))


def test_unknown_stores_are_refused_at_once(spark):
    with pytest.raises(ValueError, match="ftp"):
        read_archives(spark, "ftp://host/zips")
    assert archives.store_uri("s3a://bucket/a b.zip") == "s3://bucket/a b.zip"
    assert archives.store_uri("wasbs://c@acc.blob.core.windows.net/x") == "abfss://c@acc.dfs.core.windows.net/x"


def test_member_store_replaces_only_its_members(spark, archive_dir, tmp_path):
    store = str(tmp_path / "store")
    lines = members(unzip(read_archives(spark, archive_dir)))
    write_members(lines, store)
    write_members(lines.filter("member = 'c.CSV'"), store)
    write_members(lines.filter("member = 'a.CSV'").limit(1), store)
    counts = read_events(spark, store).groupBy("member").count().collect()
    assert dict(map(tuple, counts)) == {"a.CSV": 1, "b.CSV": 45000, "c.CSV": 1}


# --- replay and sinks -----------------------------------------------------------------


def test_first_events(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("id")).repartition(8)
    assert [r[0] for r in first_events(df, "id", 5, 3).orderBy("id").collect()] == list(range(15))


def test_json_batches_hold_every_row(spark, tmp_path):
    path = str(tmp_path / "json")
    write_json_batches(edits(spark, [{"id": i} for i in range(1050)]).coalesce(1), path, 100)
    sizes = spark.read.text(path).groupBy(F.input_file_name()).count().select("count")
    assert sorted(r[0] for r in sizes.collect()) == [50] + [100] * 10


def test_transcript_lands_in_batches_batch_and_stream(spark, tmp_path):
    raw = put(tmp_path / "raw", "a.txt", *(f'data: {{"id":{i}}}' for i in range(250)), ":heartbeat")
    write_payload_batches(sse_payloads(read_lines(spark, raw)), str(tmp_path / "batch"), 100)
    stream = sse_payloads(read_lines(spark, raw, stream=True))
    for _ in range(2):
        start_payload_batches(stream, str(tmp_path / "stream"), str(tmp_path / "cp"), 100).awaitTermination()
    for name in ("batch", "stream"):
        sizes = spark.read.text(str(tmp_path / name)).groupBy(F.input_file_name()).count()
        assert sorted(r[1] for r in sizes.collect()) == [50, 100, 100]
        ids = read_edits(spark, str(tmp_path / name)).select("id").collect()
        assert sorted(r[0] for r in ids) == list(range(250))


def test_archived_lines_parse_like_the_export_reader(spark, tmp_path):
    lines = [
        tsv(Source_URL="u"),
        "2\t20240705",
        tsv(Global_Event_ID="3") + "\textra",
        tsv(Global_Event_ID="4", Quad_Class="x"),
        tsv(Global_Event_ID="5", Actor1_Name='"un', Actor1_Country_Code="bal"),
        tsv(Global_Event_ID="6", Actor1_Name='""'),
        tsv(Global_Event_ID="7", Actor1_Name=" sp "),
        "   ",
        "x",
    ]
    want = read_events(spark, put(tmp_path / "raw", "a.CSV", *lines)).collect()
    rows = [("a", "m", line, None) for line in lines]
    frame = spark.createDataFrame(rows, "archive string, member string, value string, error string")
    got = member_events(frame).select(*EVENT_SCHEMA.names).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 8


def test_published_table_has_a_comment(spark, tmp_path):
    df = events(spark, [{}])
    df.write.parquet(str(tmp_path / "t"))
    table = publish_table(spark, "published_events", str(tmp_path / "t"), df.schema, "raw events")
    assert table.count() == 1
    assert spark.catalog.getTable("published_events").description == "raw events"
