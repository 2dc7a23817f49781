"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of one group (equal texts) stay together unless the group is larger than a shard; then
it is cut into pieces. Packing runs in levels: cells of a bounded number of groups are
packed into parcels a small fraction of a shard in size, each cell in its own task, and the
parcels are packed into shards: in one small task, or where they are too many for that, in
divisions that share the shards by their bytes, each in its own task. In both, sizes in
descending order enter the bin with the tightest remaining capacity, found in a balanced
tree of capacities. Where the number of shards is given, the smallest capacity that needs no
more of them is searched for; where the capacity is given, the number of shards is kept low.

Rows are numbered without ordering a shard or a group as a whole: a group is dealt over
about the square root of all rows many units, units carry running offsets, and only the rows
of a unit are ordered.

Defined results: NULL text has size 8 and a checksum of no bytes, and NULL texts are a group
of their own; repeated rows are rows of one group with slots of their own; an empty table
gives an empty table; equal sizes are ordered by group, so results are repeatable.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import durable

# Groups packed in one task, and parcels (about) packed in one of the last.
CELL_ITEMS = 20_000
LAST_ITEMS = 40_000
# Parcels that make up a shard.
PARCELS = 200


@dataclass(slots=True)
class _Node:
    key: tuple[int, int]
    level: int = 1
    left: _Node | None = None
    right: _Node | None = None


def _skew(t: _Node) -> _Node:
    if t.left is not None and t.left.level == t.level:
        low = t.left
        t.left, low.right = low.right, t
        return low
    return t


def _split(t: _Node) -> _Node:
    if t.right is not None and t.right.right is not None and t.right.right.level == t.level:
        high = t.right
        t.right, high.left = high.left, t
        high.level += 1
        return high
    return t


def _insert(t: _Node | None, key: tuple[int, int]) -> _Node:
    if t is None:
        return _Node(key)
    if key < t.key:
        t.left = _insert(t.left, key)
    else:
        t.right = _insert(t.right, key)
    return _split(_skew(t))


def _delete(t: _Node | None, key: tuple[int, int]) -> _Node | None:
    if t is None:
        return None
    if key < t.key:
        t.left = _delete(t.left, key)
    elif key > t.key:
        t.right = _delete(t.right, key)
    elif t.left is None:
        return t.right
    elif t.right is None:
        return t.left
    else:
        heir = t.right
        while heir.left is not None:
            heir = heir.left
        t.key = heir.key
        t.right = _delete(t.right, heir.key)
    low = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
    if low < t.level:
        t.level = low
        if t.right is not None and t.right.level > low:
            t.right.level = low
    t = _skew(t)
    if t.right is not None:
        t.right = _skew(t.right)
        if t.right.right is not None:
            t.right.right = _skew(t.right.right)
    t = _split(t)
    if t.right is not None:
        t.right = _split(t.right)
    return t


class Capacities:
    """Remaining capacities of bins in a balanced (AA) tree."""

    def __init__(self):
        self._root = None

    def add(self, remaining: int, bin_: int) -> None:
        self._root = _insert(self._root, (remaining, bin_))

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest capacity that holds ``size``."""
        t, best = self._root, None
        while t is not None:
            if t.key >= (size, -1):
                best, t = t.key, t.left
            else:
                t = t.right
        if best is not None:
            self._root = _delete(self._root, best)
        return best


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each size (given in descending order), and the number of bins.

    A size above the capacity gets a bin of its own.
    """
    bins, out, opened = Capacities(), [], 0
    for size in sizes:
        found = bins.take_tightest(size)
        if found is None:
            found, opened = (max(capacity, size), opened), opened + 1
        out.append(found[1])
        bins.add(found[0] - size, found[1])
    return out, opened


def fewest_capacity(sizes: list[int], n_bins: int) -> list[int]:
    """Bins of descending sizes by a capacity near the smallest that needs ``n_bins`` at most."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // n_bins), sizes[0])
    high = low
    while best_fit_decreasing(sizes, high)[1] > n_bins:
        low, high = high + 1, high + max(1, high // 50)
    while low < high and high - low > high // 2000:
        middle = (low + high) // 2
        if best_fit_decreasing(sizes, middle)[1] > n_bins:
            low = middle + 1
        else:
            high = middle
    return best_fit_decreasing(sizes, high)[0]


def _descending(items: pd.DataFrame) -> pd.DataFrame:
    return items.sort_values(["bytes", "item"], ascending=[False, True], ignore_index=True)


def _offsets(items: pd.DataFrame) -> pd.Series:
    """Rows before each item in its bin."""
    return items.groupby("bin")["n"].cumsum() - items["n"]


def _level(items: DataFrame, count: int, capacity: int, level: int) -> DataFrame:
    """(item, parcel, offset, n, bytes): ``count`` items packed into parcels cell by cell."""
    cells = max(1, math.ceil(count / CELL_ITEMS))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _descending(rows)
        rows["bin"], _ = best_fit_decreasing(rows["bytes"].tolist(), capacity)
        rows["offset"] = _offsets(rows)
        rows["parcel"] = f"{level}." + rows["cell"].astype(str) + "." + rows["bin"].astype(str)
        return rows[["item", "parcel", "offset", "n", "bytes"]]

    placed = items.withColumn("cell", F.pmod(F.xxhash64("item"), F.lit(cells)))
    return placed.groupBy("cell").applyInPandas(pack, "item string, parcel string, offset long, n long, bytes long")


def _parcels(items: DataFrame, count: int, capacity: int, level: int = 1) -> tuple[DataFrame, DataFrame, int]:
    """(item, parcel, offset) of all items, the parcels as items of the last level, and their number."""
    placed = _level(items, count, capacity, level).transform(durable)
    parcels = placed.groupBy(F.col("parcel").alias("item")).agg(
        F.sum("n").cast("long").alias("n"), F.sum("bytes").cast("long").alias("bytes")
    ).transform(durable)
    fewer = parcels.count()
    # Full parcels do not become fewer by packing them again.
    if fewer <= LAST_ITEMS or (level > 1 and 20 * fewer > 19 * count):
        return placed.select("item", "parcel", "offset"), parcels, fewer
    # Cells leave a part-filled parcel each; these are packed again.
    upper, parcels, fewest = _parcels(parcels, fewer, capacity, level + 1)
    upper = upper.select(F.col("item").alias("lower"), F.col("parcel").alias("upper"), F.col("offset").alias("shift"))
    joined = placed.join(upper, placed["parcel"] == upper["lower"])
    return joined.select("item", F.col("upper").alias("parcel"), (F.col("offset") + F.col("shift")).alias("offset")), parcels, fewest


def _shared(sizes: list[int], n_shards: int) -> list[int]:
    """Shards of each division: one, and of the others a share by its bytes."""
    rest, whole, upto, given, out = n_shards - len(sizes), sum(sizes), 0, 0, []
    for size in sizes:
        upto += size
        out.append(1 + (2 * rest * upto + whole) // (2 * whole) - given)
        given += out[-1] - 1
    return out


def _last(parcels: DataFrame, count: int, n_shards: int | None, capacity: int) -> DataFrame:
    """(parcel, shard, base) of ``count`` parcels, packed in divisions of a bounded number."""
    divisions = min(max(1, math.ceil(count / LAST_ITEMS)), n_shards or max(1, count))
    dealt = parcels.withColumn("division", F.pmod(F.xxhash64("item"), F.lit(divisions)))
    # A number for each division, of which there is one for ``LAST_ITEMS`` parcels.
    sizes: dict[int, int] = {}
    if n_shards and divisions > 1:
        sizes = dict(sorted(dealt.groupBy("division").agg(F.sum("bytes")).collect()))
    parts = dict(zip(sizes, _shared(list(sizes.values()), n_shards))) if sizes else {0: n_shards}

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _descending(rows)
        bytes_, bins = rows["bytes"].tolist(), parts.get(int(rows["division"].iloc[0]))
        rows["bin"] = fewest_capacity(bytes_, bins) if n_shards else best_fit_decreasing(bytes_, capacity)[0]
        rows["base"] = _offsets(rows)
        return rows.rename(columns={"item": "parcel", "bin": "shard"})[["parcel", "division", "shard", "base"]]

    packed = dealt.groupBy("division").applyInPandas(pack, "parcel string, division long, shard int, base long")
    if divisions == 1:
        return packed.drop("division")
    packed = packed.transform(durable)
    used = parts
    if not n_shards:
        used = dict(packed.groupBy("division").agg(F.max("shard") + 1).collect())
    firsts, first = [], 0
    for division, n in sorted(used.items()):
        firsts.append((division, first))
        first += n
    starts = parcels.sparkSession.createDataFrame(firsts, "division long, first int")
    # Divisions are few.
    return packed.join(F.broadcast(starts), "division").select(
        "parcel", (F.col("shard") + F.col("first")).alias("shard"), "base"
    )


def shards(docs: DataFrame, *, n_shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row.

    Give either the number of shards, which then come out nearly equal, or their capacity.
    """
    if (n_shards is None) == (capacity is None):
        raise ValueError("give either n_shards or capacity")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit("second"), "text").alias("h2"),
    ).transform(durable)
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    shard_bytes = capacity or max(1, -(-whole.bytes // n_shards))
    parcel_bytes = max(1, shard_bytes // PARCELS)
    salts = max(1, math.isqrt(whole.n))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))

    group = Window.partitionBy("h1", "h2")
    running = group.orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)
    units = salted.groupBy("h1", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    piece = F.floor((F.sum("bytes").over(running) - 1) / parcel_bytes)
    units = units.withColumn(
        "piece", F.when(F.sum("bytes").over(group) > shard_bytes, piece).otherwise(F.lit(0)).cast("long")
    )
    inside = Window.partitionBy("h1", "h2", "piece").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)
    units = (
        units.withColumn("before", F.sum("n").over(inside) - F.col("n"))
        .withColumn("item", F.concat_ws(".", F.hex("h1"), F.hex("h2"), "piece"))
        .transform(durable)
    )
    items = units.groupBy("item").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    placed, parcels, count = _parcels(items, items.count(), parcel_bytes)
    last = _last(parcels, count, n_shards, shard_bytes)
    bases = placed.join(F.broadcast(last) if count <= LAST_ITEMS else last, "parcel").select("item", "shard", (F.col("base") + F.col("offset")).alias("start"))
    starts = units.join(bases, "item").select(
        "h1", "h2", "salt", "shard", (F.col("start") + F.col("before")).alias("start")
    )
    unit = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id")
    return salted.join(starts, ["h1", "h2", "salt"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.row_number().over(unit) - 1).cast("long").alias("slot"),
    )
