from test_sources import TRANSCRIPT

from millrace.functions.table_functions import register_table_functions
from millrace.sources import parse_sse, readable, unreadable


def test_table_function_agrees_with_parser(spark):
    extra = [
        'data: {"id":3,"bot":true,"log_params":{"a":1},"length":{"new":5},"timestamp":7}',
        'data: {"id":"x","title":5,"bot":"no","length":3}',
        'data: {"id":9223372036854775808,"timestamp":-9223372036854775808,"namespace":1.5}',
        "data: [1]",
        "data: {",
        'data:\t{"id":4,"title":"tab"}',
        'data: \u00a0{"id":5} \t',
        "data: {'id':6}",
        'data: {"id":7} trailing',
        'data: {"id":8},{"id":9}',
        'data: {"id":10}]',
        'data: {"id":11}]}',
        'data: {"id":12,"log_params":[{"a":1} ]}',
        "data: null",
    ]
    lines = spark.createDataFrame([(line,) for line in TRANSCRIPT + extra], "value string")
    lines.createOrReplaceTempView("tf_lines")
    register_table_functions(spark)
    got = spark.sql("SELECT e.* FROM parse_sse(TABLE(SELECT value FROM tf_lines)) e")
    want = readable(parse_sse(lines))
    assert got.schema == want.schema
    ids = {r["id"] for r in want.collect()}
    assert {3, 4, 5, 12} <= ids and not ids & {6, 7, 8, 9, 10, 11}
    refused = [r[0] for r in unreadable(parse_sse(lines)).collect()]
    assert want.count() + len(refused) == lines.filter("startswith(value, 'data:')").count()
    key = str
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_raw_variant(spark):
    spark.createDataFrame([(line,) for line in TRANSCRIPT], "value string").createOrReplaceTempView("tf_raw")
    register_table_functions(spark)
    raw = spark.sql("SELECT d.data FROM sse_data(TABLE(SELECT value FROM tf_raw)) d")
    assert sorted(r[0][:6] for r in raw.collect()) == ["not js", '{"id":', '{"id":']
