"""Hard negatives: rows of another label that score close below an anchor's positives.

The anchors are a stated query set; every row is a candidate. Anchors and candidates are
dealt into blocks of bounded size and every pair of blocks is one tile, which a task scores
as a product of integer matrices by Strassen's recursion: odd sides are padded with zeros,
seven half-sized products replace eight, and all sums are int64. These sums may wrap around
on the way; the products come out exact all the same as long as they fit into 64 bits, which
the largest components tell beforehand. A tile that may not fit is multiplied in unbounded
integers, and scores beyond a long then count as the nearest long.

Two sweeps over the tiles keep heaps of fixed size, merged from sub-tile to sub-tile in the
task and from tile to tile by Spark: the first for the best positives of each anchor, the
second for the best rows in the window that each positive opens.

Defined results: rows with a NULL id, label or vector, or a NULL or non-finite component,
take no part. Higher scores come first, ties go to the smaller id. Rows with the anchor's
own id are not its positives; rows repeating an id count each, also as anchors. A shorter
vector counts as padded with zeros. Without anchors, candidates or rows in a window there
are no rows. Columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import durable

# Sides of the blocks that meet in a task, and of the pieces it scores at a time.
ANCHOR_ROWS = 8_192
CANDIDATE_ROWS = 32_768
_PIECE_ANCHORS = 256
_PIECE_CANDIDATES = 4_096
# Side up to which a product is multiplied out plainly.
LEAF = 24
# More shuffle partitions than this are not asked for; tiles then share them.
_MOST_PARTITIONS = 20_000

_LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Settings:
    """What is mined: heap sizes, and the window in percent of the positive's score."""

    positives: int = 5
    negatives: int = 5
    from_percent: int = 80
    to_percent: int = 100
    scale: int = 256


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices, exact modulo 2 ** 64."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    if rows % 2 or inner % 2 or columns % 2:
        a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
        b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    both = strassen(a11 + a22, b11 + b22, leaf)
    low = strassen(a21 + a22, b11, leaf)
    right = strassen(a11, b12 - b22, leaf)
    left = strassen(a22, b21 - b11, leaf)
    top = strassen(a11 + a12, b22, leaf)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = both + left - top + strassen(a12 - a22, b21 + b22, leaf)
    out[:i, j:] = right + top
    out[i:, :j] = low + left
    out[i:, j:] = both - low + right + strassen(a21 - a11, b11 + b12, leaf)
    return out[:rows, :columns]


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, given as doubles."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0**62:
        return strassen(a.astype(np.int64), b.astype(np.int64).T)
    whole = np.frompyfunc(int, 1, 1)
    exact = np.dot(whole(a), whole(b).T)
    return np.clip(exact, _LONG.min, _LONG.max).astype(np.int64)


def window_of(score: int, settings: Settings) -> tuple[int, int]:
    """The scores s with from * score <= 100 * s <= to * score."""
    low = -(-settings.from_percent * score // 100)
    high = settings.to_percent * score // 100
    return max(low, _LONG.min), min(high, _LONG.max)


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The best of some scores; ids ascend, so a stable order settles ties."""
    if len(scores) > most:
        bar = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = np.flatnonzero(scores >= bar)
        scores, ids = scores[near], ids[near]
    order = np.argsort(~scores, kind="stable")[:most]
    return scores[order], ids[order]


class Heaps:
    """The best entries seen under each of a number of keys."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.scores = [np.zeros(0, np.int64)] * keys
        self.ids = [np.zeros(0, np.int64)] * keys

    def push(self, key: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = _first(scores, ids, self.most)
        if len(self.scores[key]):
            scores = np.concatenate([self.scores[key], scores])
            ids = np.concatenate([self.ids[key], ids])
            order = np.lexsort((ids, ~scores))[: self.most]
            scores, ids = scores[order], ids[order]
        self.scores[key], self.ids[key] = scores, ids

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, score and id of everything held."""
        sizes = [len(s) for s in self.scores]
        none = np.zeros(0, np.int64)
        return (
            np.repeat(np.arange(len(sizes)), sizes),
            np.concatenate([none, *self.scores]),
            np.concatenate([none, *self.ids]),
        )


def _matrix(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * float(scale))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _pieces(table: pa.Table, scale: int) -> Iterator[tuple[pa.Table, np.ndarray, pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """Scores of a tile piece by piece, with what says whether labels are equal."""
    is_anchor = table["key"].is_valid()
    anchors, others = table.filter(is_anchor), table.filter(table["key"].is_null()).sort_by("id")
    if not anchors.num_rows or not others.num_rows:
        return
    names = pa.concat_tables([anchors.select(["label"]), others.select(["label"])])["label"].combine_chunks()
    codes = names.dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    width = max(int(np.diff(t["vector"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (anchors, others))
    left, right = _matrix(anchors["vector"], width, scale), _matrix(others["vector"], width, scale)
    for j in range(0, others.num_rows, _PIECE_CANDIDATES):
        part = slice(j, j + _PIECE_CANDIDATES)
        ids = others["id"].slice(j, _PIECE_CANDIDATES).to_numpy()
        label = codes[anchors.num_rows :][part]
        for i in range(0, anchors.num_rows, _PIECE_ANCHORS):
            piece = slice(i, i + _PIECE_ANCHORS)
            scores = scores_of(left[piece], right[part])
            same = codes[: anchors.num_rows][piece][:, None] == label[None, :]
            yield anchors, i, ids, scores, same


def _deal(anchors: DataFrame, candidates: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Anchors and candidates side by side, copied to the tiles they meet in."""
    parallel = anchors.sparkSession.sparkContext.defaultParallelism
    down = max(1, math.ceil(n_anchors / ANCHOR_ROWS))
    across = max(math.ceil(n_rows / CANDIDATE_ROWS), min(math.ceil(n_rows / 1024), 2 * parallel), 1)
    row = F.pmod(F.xxhash64("key"), F.lit(down)).cast("int")
    left = anchors.select(row.alias("row"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("column"), *_TILE)
    # Where a row stands in its file tells repeated rows apart, which no column does.
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(across)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(down - 1)))
    right = candidates.select("*", place.alias("column")).select(copies.alias("row"), "column", *_TILE)
    return left.unionByName(right).repartition(min(down * across, _MOST_PARTITIONS), "row", "column")


_TILE = ["key", "id", "label", "vector", "positives"]
_POSITIVES = "array<struct<nth:int,id:bigint,score:bigint>>"


def _sweep(tiles: DataFrame, found: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return tiles.groupBy("row", "column").applyInArrow(found, schema)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    settings: Settings = Settings(),
    *,
    id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """For each anchor and positive the first negatives of its window, by rank.

    Gives anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    ``is_anchor`` says which rows are anchors.
    """
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = (
        rows.select(
            F.col(id).cast("long").alias("id"),
            F.col(label).alias("label"),
            F.col(vector).cast("array<double>").alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
        .filter(usable)
    )
    sizes = valid.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors")).first()
    nothing = F.lit(None).cast(_POSITIVES).alias("positives")
    anchors = valid.filter("is_anchor").select(
        F.monotonically_increasing_id().alias("key"), "id", "label", "vector", nothing
    ).transform(durable)
    candidates = valid.select(F.lit(None).cast("long").alias("key"), "id", "label", "vector", nothing)

    def positives(tile: pa.Table) -> pa.Table:
        heaps = keys = owners = None
        for anchors, start, ids, scores, same in _pieces(tile, settings.scale):
            if heaps is None:
                heaps = Heaps(anchors.num_rows, settings.positives)
                keys, owners = anchors["key"].to_numpy(), anchors["id"].to_numpy()
            for k in range(len(scores)):
                fits = np.flatnonzero(same[k] & (ids != owners[start + k]))
                heaps.push(start + k, scores[k, fits], ids[fits])
        if heaps is None:
            at = score = found = keys = np.zeros(0, np.int64)
        else:
            at, score, found = heaps.entries()
        return pa.table({"key": pa.array(keys[at], pa.int64()), "id": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64())})

    best = _sweep(_deal(anchors, candidates, sizes.anchors, sizes.n), positives, "key long, id long, score long")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    best = best.withColumn("nth", nth).filter(F.col("nth") <= settings.positives)
    best = best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("positives"))
    # Anchors without positives have no windows.
    armed = anchors.drop("positives").join(best, "key").select(*_TILE).transform(durable)

    def negatives(tile: pa.Table) -> pa.Table:
        heaps, owners, first = None, [], []
        for anchors, start, ids, scores, same in _pieces(tile, settings.scale):
            if heaps is None:
                windows = anchors["positives"].to_pylist()
                first = np.cumsum([0] + [len(w) for w in windows])
                heaps = Heaps(int(first[-1]), settings.negatives)
                keys, names = anchors["key"].to_pylist(), anchors["id"].to_pylist()
                owners = [(keys[n], names[n], p["nth"], p["id"], p["score"]) for n, w in enumerate(windows) for p in w]
            for k in range(len(scores)):
                bounds = [window_of(p["score"], settings) for p in windows[start + k]]
                low, high = min(b[0] for b in bounds), max(b[1] for b in bounds)
                fits = np.flatnonzero(~same[k] & (scores[k] >= low) & (scores[k] <= high))
                near, names_near = scores[k, fits], ids[fits]
                for p, (low, high) in enumerate(bounds):
                    inside = (near >= low) & (near <= high)
                    if inside.any():
                        heaps.push(int(first[start + k]) + p, near[inside], names_near[inside])
        at, score, found = heaps.entries() if heaps is not None else (np.zeros(0, np.int64),) * 3
        columns = list(zip(*(owners[n] for n in at.tolist()))) or [()] * 5
        names = ["key", "anchor_id", "nth", "positive_id", "positive_score"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        out = {n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)}
        return pa.table(out | {"negative_id": pa.array(found, pa.int64()), "negative_score": pa.array(score, pa.int64())})

    schema = "key long, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"
    near = _sweep(_deal(armed, candidates, sizes.anchors, sizes.n), negatives, schema)
    rank = F.row_number().over(Window.partitionBy("key", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    near = near.withColumn("rank", rank).filter(F.col("rank") <= settings.negatives)
    return near.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
