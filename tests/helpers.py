"""Small made-up frames in the shape of the feeds."""

from millrace.schemas import EDIT_SCHEMA, EVENT_SCHEMA

GOOD_EVENT = {
    "Global_Event_ID": 1,
    "SQL_Date": 20240705,
    "Year": 2024,
    "Is_Root_Event": 1,
    "Event_Code": "057",
}
GOOD_EDIT = {"id": 1, "timestamp": 1720000000, "title": "A", "wiki": "enwiki", "user": "u"}


def frame(spark, schema, rows, base):
    values = [tuple((base | r).get(f.name) for f in schema) for r in rows]
    return spark.createDataFrame(values, schema)


def events(spark, rows):
    return frame(spark, EVENT_SCHEMA, rows, GOOD_EVENT)


def edits(spark, rows):
    return frame(spark, EDIT_SCHEMA, rows, GOOD_EDIT)


def plan(df):
    """The physical plan with full scan details."""
    utils = df.sparkSession._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")
