"""Named data-quality rules: gate, quarantine and per-rule counts.

A rule is a name and a boolean SQL predicate. A row is kept only if every rule is TRUE
for it; FALSE and NULL both count as failed, as in a WHERE clause. All functions here are
row-wise or one map-side-combined aggregate, so they run alike on tables and streams and
never shuffle rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str]

FAILED_RULES = "failed_rules"


def required(column: str) -> str:
    return f"{column} IS NOT NULL"


def within(column: str, low, high, optional: bool = True) -> str:
    test = f"{column} BETWEEN {low} AND {high}"
    return f"({column} IS NULL) OR ({test})" if optional else test


def at_least(column: str, low) -> str:
    return f"({column} IS NULL) OR ({column} >= {low})"


def _event_rules() -> dict[str, str]:
    # Rule names, columns and bounds of the event feed.
    latitude = (-90.0, 90.0)
    longitude = (-180.0, 180.0)
    place_type = (0, 5)
    rules = {
        "valid_global_event_id": required("Global_Event_ID"),
        "valid_event_code": required("Event_Code"),
        "valid_sql_date": within("SQL_Date", 19000101, 99991231, optional=False),
        "valid_quad_class": within("Quad_Class", 1, 4),
        "valid_goldstein_scale": within("Goldstein_Scale", -10.0, 10.0),
        "valid_is_root_event": within("Is_Root_Event", 0, 1, optional=False),
    }
    places = ("Actor1", "Actor2", "Action")
    for place in places:
        rules[f"valid_{place.lower()}_geo_lat"] = within(f"{place}_Geo_Lat", *latitude)
        rules[f"valid_{place.lower()}_geo_long"] = within(f"{place}_Geo_Long", *longitude)
    for count in ("Num_Mentions", "Num_Sources", "Num_Articles"):
        rules[f"valid_{count.lower()}"] = at_least(count, 0)
    for place in places:
        rules[f"valid_{place.lower()}_geo_type"] = within(f"{place}_Geo_Type", *place_type)
    return rules


EVENT_RULES: dict[str, str] = _event_rules()

# Rule names and predicates of the change feed.
EDIT_RULES: dict[str, str] = {
    "valid_id": required("id"),
    "valid_timestamp": "timestamp > 0",
    "non_empty_title": "length(title) > 0",
}

# Not gates, only counted: the row is kept although its date could not be read.
EVENT_WARNINGS: dict[str, str] = {
    "readable_sql_date": "SQL_Date IS NULL OR event_timestamp IS NOT NULL",
}


def passes(predicate: str) -> Column:
    """The rule as a column that is never NULL."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def _conjunction(rules: Rules) -> str:
    return " AND ".join(f"({p})" for p in rules.values()) or "TRUE"


def gate(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that satisfy every rule.

    A plain conjunction: a filter treats NULL as failed anyway, and in this form Spark can
    hand the bounds to the scan and keeps the generated code small enough to be compiled.
    """
    return df.filter(_conjunction(rules))


def with_failures(df: DataFrame, rules: Rules) -> DataFrame:
    """All rows, with the names of the rules each one failed."""
    names = [F.when(~passes(p), F.lit(name)) for name, p in rules.items()]
    failed = F.array_compact(F.array(*names)) if names else F.expr("array()").cast("array<string>")
    return df.withColumn(FAILED_RULES, failed)


def reject(df: DataFrame, rules: Rules) -> DataFrame:
    """The complement of :func:`gate`, with the failed rule names.

    The plain predicate comes first so that the array is only built for rejected rows.
    """
    return with_failures(df.filter(~passes(_conjunction(rules))), rules)


def _failure_counts(rules: Rules) -> list[Column]:
    return [F.count_if(~passes(p)).alias(name) for name, p in rules.items()]


def rule_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with the number of rows that failed it, in one pass."""
    counts = df.agg(*_failure_counts(rules))
    return counts.unpivot([], list(rules), "rule", "failed")


def quarantine_metrics(rejected: DataFrame) -> DataFrame:
    """Failure counts per rule from stored rejected rows; rules nobody failed are absent."""
    return (
        rejected.select(F.explode(FAILED_RULES).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("failed"))
    )


def observed(df: DataFrame, rules: Rules, name: str) -> DataFrame:
    """``df`` unchanged, reporting row and failure counts as the named observation.

    On a stream the counts of each micro-batch appear in the query progress.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows_in"), *_failure_counts(rules))
