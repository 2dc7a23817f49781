from millrace.plans.marts import (
    daily_correlation,
    daily_events,
    daily_mentions,
    edits_per_minute,
    last_month_places,
    peak_hours,
    place_list,
    top_country_codes,
    top_event_types,
    top_places,
    top_users,
    total,
)
from millrace.plans.sql import (
    run_sql,
    sql_daily_events,
    sql_daily_mentions,
    sql_edits_per_minute,
    sql_place_list,
    sql_top_places,
)

__all__ = [
    "daily_correlation",
    "daily_events",
    "daily_mentions",
    "edits_per_minute",
    "last_month_places",
    "peak_hours",
    "place_list",
    "run_sql",
    "sql_daily_events",
    "sql_daily_mentions",
    "sql_edits_per_minute",
    "sql_place_list",
    "sql_top_places",
    "top_country_codes",
    "top_event_types",
    "top_places",
    "top_users",
    "total",
]
