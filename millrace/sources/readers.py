"""Scans of landed files and written tables, each as a batch or as a stream.

Schemas are always given, so no scan reads data to infer one, and a stream picks up only
files it has not seen (its checkpoint remembers them).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import CORRUPT, EDIT_SCHEMA, EVENT_SCHEMA, RESCUED, with_corrupt

FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv", "text")

_RAW = "_raw"
_STRICT = {"allowSingleQuotes": "false"}
_NO_FIELDS = "struct<`_no_field`:string>"
_PARSED = "_parsed"


def _reader(spark: SparkSession, stream: bool, options: dict | None):
    reader = spark.readStream if stream else spark.read
    return reader.options(**(options or {}))


def read_events(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    corrupt: bool = False,
    quote: str | None = None,
    schema: T.StructType = EVENT_SCHEMA,
    options: dict | None = None,
) -> DataFrame:
    """Tab-separated exports without a header, bound by position.

    Short rows are padded with NULL, surplus fields cut, and a cell that does not fit its
    type becomes NULL; ``corrupt=True`` also keeps the text of such rows. ``quote=""``
    reads quote characters literally. ``options`` go to the file source, for example
    ``maxFilesPerTrigger`` on a stream.
    """
    reader = _reader(spark, stream, options).option("sep", "\t").option("mode", "PERMISSIVE")
    if quote is not None:
        reader = reader.option("quote", quote)
    if corrupt:
        schema = with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def read_edits(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    corrupt: bool = False,
    rescue: bool = False,
    schema: T.StructType = EDIT_SCHEMA,
    options: dict | None = None,
) -> DataFrame:
    """JSON-lines change records, bound by name.

    ``rescue=True`` adds the fields that found no place in the schema as JSON text.
    """
    reader = _reader(spark, stream, options)
    if rescue:
        lines = reader.text(path).filter(F.trim("value") != "")
        return parse_json(lines, "value", corrupt=corrupt, rescue=True, schema=schema)
    reader = reader.option("mode", "PERMISSIVE")
    if corrupt:
        schema = with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def read_table(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    schema: T.StructType | None = None,
    table_format: str = "parquet",
    options: dict | None = None,
) -> DataFrame:
    """A written table by path. A stream over plain files needs the schema; a table format
    that keeps its own schema does not take one."""
    reader = _reader(spark, stream, options).format(table_format)
    if schema is not None and table_format in FILE_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path)


def parse_json(
    df: DataFrame,
    column: str,
    *,
    corrupt: bool = True,
    rescue: bool = False,
    schema: T.StructType = EDIT_SCHEMA,
) -> DataFrame:
    """Replace a JSON text column by the fields of ``schema``; other columns stay.

    With ``corrupt``, text that is not exactly one JSON object is kept in
    ``_corrupt_record``: names in single quotes, text after the object and a second object
    count as corrupt. An object with a single ill-typed value is not: that value is NULL, the
    rest is kept. The fields of a corrupt row are NULL.

    A text is parsed into its fields once, as the one element of a list inside an object, which
    refuses text after it; only one that could close the list itself, having a bracket behind a
    brace, must also be the value of a field. The result passes a generator, so a filter on
    any column stays above the parser and does not parse again. With ``rescue`` the names and the
    nested objects are read once more, to find what the schema lacks.
    """
    text = F.col(_RAW)
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    raw = df.withColumnRenamed(column, _RAW)
    if rescue:
        kinds = with_corrupt(schema)
        parsed = F.from_json(text, kinds, _STRICT | {"columnNameOfCorruptRecord": CORRUPT})
        found = raw.withColumn(_PARSED, parsed)
        not_object = ~is_json_object(text)
    else:
        whole = F.from_json(F.concat(F.lit('{"v":['), text, F.lit("]}")), T.StructType().add("v", T.ArrayType(schema)), _STRICT)
        results = F.struct(whole.alias("whole"), _stands_alone(text).alias("alone"))
        found = raw.select("*", F.explode(F.array(results)).alias("_results"))
        listed = F.col("_results.whole.v")
        one = _in_braces(text) & (F.size(listed) == 1) & F.col("_results.alone")
        found = found.withColumn(_PARSED, F.when(one, F.get(listed, F.lit(0))))
        not_object = F.col(_PARSED).isNull()
    out = others + [F.col(f"{_PARSED}.`{n}`").alias(n) for n in schema.names]
    if corrupt:
        out.append(F.when(not_object, text).alias(CORRUPT))
    if rescue:
        out.append(rescued_fields(text, F.col(_PARSED), schema).alias(RESCUED))
    return found.select(*out)


def _in_braces(text: Column) -> Column:
    bare = F.trim(text, F.lit(" \t\n\r"))
    return F.startswith(bare, F.lit("{")) & F.endswith(bare, F.lit("}"))


def _stands_alone(text: Column) -> Column:
    """FALSE for text that closes a list it is put in: it has a bracket behind a brace, and is
    not the value of a field."""
    closes = F.contains(text, F.lit("]")) & text.rlike(r"\}\s*\]")
    as_field = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {_NO_FIELDS}", _STRICT)
    return F.when(closes, as_field["v"].isNotNull()).otherwise(F.lit(True))


# The characters that count as white space in Unicode text.
_WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    """Text without white space of any kind around it."""
    return F.trim(text, F.lit(_WHITE))


def is_json_object(text: Column) -> Column:
    """TRUE if the text is exactly one JSON object, else FALSE; never NULL.

    The text is parsed as the one element of an array, with its fields skipped. That refuses
    text after the object, unless it closes the array itself; where a bracket could do
    that, the text must also be the value of a field.
    """

    def check(text: Column) -> Column:
        as_element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{_NO_FIELDS}>", _STRICT)
        single = _once(as_element, lambda e: (F.size(e) == 1) & F.get(e, F.lit(0)).isNotNull())
        return _in_braces(text) & single & _stands_alone(text)

    return F.coalesce(_once(text, check), F.lit(False))


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where a filter is moved."""
    return F.transform(F.array(value), body)[0]


def rescued_fields(text: Column, parsed: Column, schema: T.StructType) -> Column:
    """JSON text of the fields of ``text`` that ``parsed`` could not take up.

    These are the fields whose name the schema lacks and those whose value does not fit the
    declared type, at the top and inside the nested objects; a nested object shows only what
    was lost of it. NULL when everything fitted, which is told from the parser's own complaint
    and from the names at both levels; only other rows are parsed into maps.
    """

    def unknown(keys: Column, names: list[str]) -> Column:
        return F.coalesce(F.exists(keys, lambda key: ~key.isin(names)), F.lit(False))

    def lost(fields: Column, struct: Column, kinds: T.StructType) -> Column:
        missing = F.array_compact(F.array(*[F.when(struct.getField(n).isNull(), F.lit(n)) for n in kinds.names]))

        def kept(missing: Column) -> Column:
            return F.map_filter(
                fields,
                lambda key, value: ~key.isin(kinds.names) | (value.isNotNull() & F.array_contains(missing, key)),
            )

        return _once(missing, kept)

    def all_lost(fields: Column) -> Column:
        out = lost(fields, parsed, schema)
        for f in schema:
            if isinstance(f.dataType, T.StructType):
                struct, nested = parsed.getField(f.name), F.try_element_at(fields, F.lit(f.name))
                inner = F.when(struct.isNotNull(), _once(F.from_json(nested, "map<string,string>"), partial(lost_text, struct, f.dataType)))
                out = F.map_concat(out, _once(inner, partial(as_field, f.name)))
        return _once(F.to_json(out), lambda shown: F.when(shown != "{}", shown))

    def lost_text(struct: Column, kinds: T.StructType, nested: Column) -> Column:
        return F.to_json(lost(nested, struct, kinds))

    def as_field(name: str, inner: Column) -> Column:
        return F.when(inner != "{}", F.create_map(F.lit(name), inner)).otherwise(_no_fields())

    structs = [f for f in schema if isinstance(f.dataType, T.StructType)]
    misfit = parsed.getField(CORRUPT).isNotNull() | unknown(F.json_object_keys(text), schema.names)
    if structs:
        inner = F.from_json(text, ", ".join(f"`{f.name}` map<string,string>" for f in structs))

        def unknown_inside(fields: Column) -> Column:
            found = F.lit(False)
            for f in structs:
                found = found | unknown(F.map_keys(fields.getField(f.name)), f.dataType.names)
            return found

        misfit = misfit | _once(inner, unknown_inside)
    whole = F.from_json(text, "map<string,string>")
    return F.when(misfit, _once(whole, all_lost))


def _no_fields() -> Column:
    return F.create_map().cast("map<string,string>")
