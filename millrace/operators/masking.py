"""A column shown only to members of a group.

Membership is a table of (user, grp) rows; the test is an uncorrelated EXISTS, which Spark
evaluates once per query and not per row. The view hides the column from its readers, it
does not guard the table below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what a reader outside the group sees.
RESTRICTED = "Restricted"


def is_in_group(members: DataFrame, group: str) -> Column:
    """Whether the current user belongs to ``group``."""
    return members.filter(
        (F.col("user") == F.current_user()) & (F.col("grp") == F.lit(group))
    ).exists()


def masked(column: Column, allowed: Column) -> Column:
    return F.when(allowed, column).otherwise(F.lit(RESTRICTED))


def mask_events(events: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """Year, place and date of each event, with its source address masked."""
    return events.select(
        "Year",
        "Action_Geo_FullName",
        "event_timestamp",
        masked(F.col("Source_URL"), is_in_group(members, group)).alias("SOURCEURL"),
    )


def create_masked_view(
    spark: SparkSession,
    view: str,
    events_table: str,
    members_table: str,
    group: str,
    temporary: bool = True,
) -> DataFrame:
    """Create or replace the masked view over named tables and return it.

    ``temporary=False`` stores the view in the catalog; it can then only refer to stored
    tables and views.
    """
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    literal = group.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""
        CREATE OR REPLACE {kind} {view} AS
        SELECT Year, Action_Geo_FullName, event_timestamp,
               CASE WHEN EXISTS (SELECT 1 FROM {members_table} m
                                 WHERE m.user = current_user() AND m.grp = '{literal}')
                    THEN Source_URL ELSE '{RESTRICTED}' END AS SOURCEURL
        FROM {events_table}
        """
    )
    return spark.table(view)
