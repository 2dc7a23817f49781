"""Mentions of all places at once, by an index of n-grams.

A title can only mention a place if it holds every run of characters that the place's pattern
spells out. Of these runs each place is filed under the one that fewest titles hold; titles
and places meet by equality of runs, and ``LIKE`` then decides on the few that met. So a run
that all places share, such as a common prefix, brings nobody together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.cleaning import keep_value
from millrace.plans.marts import Day, _day, _in_days

GRAM = 4


def _runs(text: Column, size: Column) -> Column:
    """All runs of ``size`` characters of a text; of size 0, the empty one."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    runs = F.transform(starts, lambda i: F.substring(text, i, size))
    none = F.array().cast("array<string>")
    return F.when(size == 0, F.array(F.lit(""))).when(F.length(text) < size, none).otherwise(F.array_distinct(runs))


def place_runs(places: DataFrame) -> DataFrame:
    """(country, run): what each pattern spells out between its wildcards.

    Runs have ``GRAM`` characters, or as many as the longest stretch of a shorter pattern; a
    pattern of wildcards only has the empty run, which every title holds.
    """
    stretches = F.split("country", r"[%_\\]")
    longest = F.array_max(F.transform(stretches, lambda s: F.length(s)))
    sized = places.filter("country IS NOT NULL").select("country", stretches.alias("parts"), F.least(longest, F.lit(GRAM)).alias("size"))
    part = sized.select("country", "size", F.explode("parts").alias("part"))
    return part.select("country", F.explode(_runs(F.col("part"), F.col("size"))).alias("run")).distinct()


def mentions_by_place(
    edits: DataFrame, places: DataFrame, start: Day, end: Day, wiki: str = "enwiki"
) -> DataFrame:
    """Edits per place and day whose title mentions it: country, date, edit_count.

    A place is matched as ``LIKE '%place%'``, like one word in ``daily_mentions``; places and
    days without a mention have no row. Equal titles of a day are looked at once.
    """
    chosen = keep_value(edits, "wiki", wiki).filter(_in_days(start, end) & F.col("title").isNotNull())
    titles = chosen.groupBy("title", _day().alias("date")).agg(F.count(F.lit(1)).alias("n"))
    spelled = place_runs(places.select("country").distinct())
    sizes = sorted(r[0] for r in spelled.select(F.length("run")).distinct().collect())  # GRAM + 1 at most
    if not sizes:
        sizes = [0]
    held = F.array_distinct(F.flatten(F.array(*[_runs(F.col("title"), F.lit(s)) for s in sizes])))
    named = titles.select("title").distinct().select("title", F.explode(held).alias("run"))
    common = named.join(spelled.select("run").distinct(), "run").groupBy("run").agg(F.count(F.lit(1)).alias("titles"))
    rarity = F.struct(F.coalesce("titles", F.lit(0)), F.col("run"))
    filed = spelled.join(common, "run", "left").groupBy("country").agg(F.min_by("run", rarity).alias("run"))
    met = named.join(filed, "run").filter(F.expr("title LIKE concat('%', country, '%')"))
    return (
        met.select("title", "country")
        .join(titles, "title")
        .groupBy("country", "date")
        .agg(F.sum("n").alias("edit_count"))
    )
