"""The same questions as SQL text over named tables.

Values come in as named parameters and never as spliced text, so a quote in a country name
is just a character. Table names are parameters too (``IDENTIFIER``), up to three parts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, query: str, **args) -> DataFrame:
    """Run a query with named parameters and hand back the lazy result."""
    return spark.sql(query, args=args)


def sql_top_places(spark: SparkSession, table: str, k: int = 10) -> DataFrame:
    return run_sql(
        spark,
        """
        SELECT Action_Geo_Fullname AS country, count(*) AS event_count
        FROM IDENTIFIER(:table)
        WHERE Action_Geo_Fullname <> "Unknown"
        GROUP BY 1
        ORDER BY 2 DESC, 1
        LIMIT :k
        """,
        table=table,
        k=k,
    )


def sql_edits_per_minute(spark: SparkSession, table: str, wiki: str = "enwiki") -> DataFrame:
    return run_sql(
        spark,
        """
        SELECT date_trunc('minute', timestamp_seconds(timestamp)) AS minute_ts, count(*) AS cnt
        FROM IDENTIFIER(:table)
        WHERE wiki = :wiki
        GROUP BY 1
        ORDER BY 1
        """,
        table=table,
        wiki=wiki,
    )


def sql_place_list(spark: SparkSession, table: str) -> DataFrame:
    return run_sql(
        spark,
        """
        SELECT DISTINCT Action_Geo_Fullname AS country
        FROM IDENTIFIER(:table)
        WHERE Action_Geo_Fullname IS NOT NULL
        ORDER BY country
        """,
        table=table,
    )


def sql_daily_events(
    spark: SparkSession, table: str, country: str, start: str | date, end: str | date
) -> DataFrame:
    return run_sql(
        spark,
        """
        SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS event_count
        FROM IDENTIFIER(:table)
        WHERE Action_Geo_FullName = :country
          AND CAST(event_timestamp AS DATE) BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        GROUP BY date
        ORDER BY date
        """,
        table=table,
        country=country,
        first=start,
        last=end,
    )


def sql_daily_mentions(
    spark: SparkSession,
    table: str,
    word: str,
    start: str | date,
    end: str | date,
    wiki: str = "enwiki",
) -> DataFrame:
    return run_sql(
        spark,
        """
        SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS edit_count
        FROM IDENTIFIER(:table)
        WHERE wiki = :wiki
          AND title LIKE concat('%', :word, '%')
          AND CAST(event_timestamp AS DATE) BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        GROUP BY date
        ORDER BY date
        """,
        table=table,
        wiki=wiki,
        word=word,
        first=start,
        last=end,
    )
