"""Near-duplicate vectors by an inverted multi-index.

Vectors of length one are cut into halves; a codebook for each half (k-means on a bounded
sample) makes a grid, and every vector belongs to its two nearest codewords. Codewords of a
half form groups, and a group of each half makes a cell. A vector visits the cells in the
order of the multi-sequence traversal of the least distances at which their members can lie,
and ends where these rule out a cosine of ``threshold``; so no link is lost, whatever the
codebooks are. A pair of cells is visited from one side only. What a visit finds is verified
by its cosine in double precision and counts for both sides.

Equal vectors of a label are one class with a multiplicity. The visitors and members of a
cell are dealt over blocks of bounded size, so that no cell is gathered whole, and a block
hands on counts and a spanning forest, not pairs.

Defined results: vectors that are NULL, empty, zero or hold NULL, NaN or infinite components,
and vectors without a label, link with nothing; vectors of different lengths are never
linked; repeated rows are vectors of their own and link; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.rows import durable

# Members and visitors in a block.
BLOCK_MEMBERS = 512
BLOCK_VISITORS = 2048


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` classes (about) train the codebooks. Codebooks have a codeword pair for about
    ``grid_rows`` classes, up to ``most_codewords`` in each half. A cell holds about
    ``cell_rows`` classes of the largest label, with two to ``most_groups`` groups in each half."""

    threshold: float = 0.93
    fit_rows: int = 10_000
    grid_rows: int = 256
    most_codewords: int = 256
    cell_rows: int = 512
    most_groups: int = 16
    iterations: int = 10
    seed: int = 3


# Rounding of a distance to a cell; codewords nearer to each other than this tell nothing.
SLACK = 1e-6


@dataclass(frozen=True)
class Index:
    """A codebook for each half, and the group of each codeword."""

    books: list[np.ndarray]
    groups: list[np.ndarray]

    def halves(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the group of each row and the squares of its least distances to all
        groups."""
        half = self.books[0].shape[1]
        parts = zip((rows[:, :half], rows[:, half:]), self.books, self.groups)
        return [_reach(part, book, groups) for part, book, groups in parts]


def _reach(rows: np.ndarray, book: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = _squared(rows, book)
    own = squares.argmin(1)
    # What is nearest to a codeword lies beyond the plane half-way from the row's own one.
    apart = np.sqrt(np.maximum(_squared(book, book), 0))[own]
    beyond = (squares - squares[np.arange(len(rows)), own][:, None]) / (2 * np.maximum(apart, SLACK))
    least = np.where(apart > SLACK, np.maximum(beyond - SLACK, 0), 0) ** 2
    least[np.arange(len(rows)), own] = 0
    return groups[own], np.stack([least[:, groups == g].min(1) for g in range(groups.max() + 1)], axis=1)


def _squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)


def traversal(one: np.ndarray, two: np.ndarray, visits: int, limit: float = math.inf) -> list[int]:
    """Cells in the order of one[i] + two[j] up to ``limit``, by the multi-sequence algorithm."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    x, y = one[a].tolist(), two[b].tolist()
    heap, seen, out = [(x[0] + y[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        cost, i, j = heapq.heappop(heap)
        if cost > limit:
            break
        out.append(int(a[i]) * len(y) + int(b[j]))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(x) and q < len(y) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (x[p] + y[q], p, q))
    return out


def _unit(vectors: list, width: int) -> np.ndarray:
    """Rows of length one in double precision, padded with zeros to ``width``."""
    rows = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    rows /= np.abs(rows).max(1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt((rows**2).sum(1, keepdims=True))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _kmeans(rows: np.ndarray, k: int, settings: Settings) -> np.ndarray:
    rng = np.random.default_rng(settings.seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(settings.iterations):
        own = _squared(rows, centres).argmin(1)
        for c in np.unique(own):
            centres[c] = rows[own == c].mean(0)
    return centres


def _draw(classes: DataFrame, rows: int, n: int, name: str) -> DataFrame:
    rate = math.ceil(1e9 * min(1.0, rows / max(1, n)))
    return classes.filter(F.pmod(F.xxhash64(F.lit(name), "node"), F.lit(1_000_000_000)) < rate)


def _in_one(sample: DataFrame):
    return sample.select("node", "vector", F.lit(0).alias("all")).groupBy("all")


def build(classes: DataFrame, n: int, largest: int, width: int, settings: Settings) -> Index:
    """Codebooks from a bounded sample of ``classes``, which are ``n``, ``largest`` of one label."""
    k = max(4, min(settings.most_codewords, 2 ** round(math.log2(math.sqrt(max(1.0, n / settings.grid_rows))))))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        rows = _unit(group.sort_values("node")["vector"].tolist(), width)
        half = (width + 1) // 2
        books = [_kmeans(part, k, settings) for part in (rows[:, :half], rows[:, half:])]
        return pd.DataFrame({"half": [0, 1], "size": [len(b) for b in books], "book": [b.tobytes() for b in books]})

    sample = _draw(classes, settings.fit_rows, n, "fit")
    found = _in_one(sample).applyInPandas(fit, "half int, size int, book binary").collect()
    if not found:  # the draw came out empty
        found = _in_one(classes.limit(100)).applyInPandas(fit, "half int, size int, book binary").collect()
    books = [np.frombuffer(r.book).reshape(r.size, -1) for r in sorted(found, key=lambda r: r.half)]
    g = min(settings.most_groups, max(2, round(math.sqrt(largest / settings.cell_rows))))
    # Groups are numbered without gaps.
    near = [_squared(book, _kmeans(book, g, settings)).argmin(1) for book in books]
    return Index(books, [np.unique(own, return_inverse=True)[1] for own in near])


def _placed(classes: DataFrame, index: Index, width: int, threshold: float) -> DataFrame:
    """Classes with their own cell and the cells they visit: of two cells, the later one."""
    limit = 2 - 2 * threshold + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _unit(batch.column("vector").to_pylist(), width)
            (a, one), (b, two) = index.halves(rows)
            own = a * two.shape[1] + b
            visits = [[c for c in traversal(x, y, x.size * y.size, limit) if c >= o] for x, y, o in zip(one, two, own)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(own.astype(np.int32)),
                    pa.array(visits, pa.list_(pa.int32())),
                ],
                names=[*batch.schema.names, "cell", "visits"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{schema}, cell int, visits array<int>")


def _linked(rows: pd.DataFrame, width: int, threshold: float) -> pd.DataFrame:
    """Counts and a spanning forest of the links between visitors and members of a block."""
    members, visitors = rows[rows["member"]], rows[~rows["member"]]
    empty = pd.DataFrame({"node": [], "n_links": [], "root": []}).astype("int64")
    if members.empty or visitors.empty:
        return empty
    m, v = (_unit(x["vector"].tolist(), width) for x in (members, visitors))
    ids_m, ids_v = members["node"].to_numpy(), visitors["node"].to_numpy()
    hit = (v @ m.T >= threshold) & (ids_v[:, None] != ids_m[None, :])
    if not hit.any():
        return empty
    counts_v = hit @ members["n"].to_numpy()
    # A member visits the visitor's cell only if it is its own.
    away = (visitors["own"] != visitors["cell"]).to_numpy()
    counts_m = (visitors["n"].to_numpy() * away) @ hit
    # Smallest node of each connected part of the block.
    big = np.iinfo(np.int64).max
    roots_v, roots_m = ids_v.copy(), ids_m.copy()
    while True:
        new_m = np.minimum(roots_m, np.where(hit, roots_v[:, None], big).min(0))
        new_v = np.minimum(roots_v, np.where(hit, new_m[None, :], big).min(1))
        if (new_m == roots_m).all() and (new_v == roots_v).all():
            break
        roots_m, roots_v = new_m, new_v
    out = pd.DataFrame(
        {
            "node": np.concatenate([ids_v, ids_m]),
            "n_links": np.concatenate([counts_v, counts_m]).astype(np.int64),
            "root": np.concatenate([roots_v, roots_m]),
        }
    )
    return out[np.concatenate([hit.any(1), hit.any(0)])]


def _blocks(placed: DataFrame, salts: int) -> DataFrame:
    """Members and visitors of every cell, dealt over blocks of bounded size; ``salts`` spread
    the rows of a cell while they learn the number of its blocks."""
    place = ["label", "size", "cell"]
    visits = placed.select("label", "size", F.explode("visits").alias("cell"))
    held = placed.groupBy(*place).agg(F.count(F.lit(1)).alias("members"))
    sizes = visits.groupBy(*place).agg(F.count(F.lit(1)).alias("visitors")).join(held, place)
    sizes = sizes.select(
        *place,
        F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int").alias("down"),
        F.ceil(F.col("visitors") / BLOCK_VISITORS).cast("int").alias("across"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    salt = F.pmod(F.xxhash64(F.lit("salt"), "node"), F.lit(salts)).cast("int").alias("salt")
    data = ["node", "n", "vector", F.col("cell").alias("own"), salt]
    spread = [F.xxhash64(F.lit(s), "node") for s in ("down", "across")]
    members = placed.select(*place, *data).join(sizes, [*place, "salt"]).withColumn("member", F.lit(True))
    members = members.withColumn("i", F.pmod(spread[0], F.col("down"))).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("across") - 1))
    )
    visitors = placed.select("label", "size", F.explode("visits").alias("visited"), *data)
    visitors = visitors.withColumnRenamed("visited", "cell").join(sizes, [*place, "salt"]).withColumn("member", F.lit(False))
    visitors = visitors.withColumn("j", F.pmod(spread[1], F.col("across"))).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("down") - 1))
    )
    columns = [*place, "i", "j", "member", "node", "n", "vector", "own"]
    both = members.select(*[F.col(c).cast("long") if c in "ij" else F.col(c) for c in columns])
    return both.unionByName(visitors.select(*[F.col(c).cast("long") if c in "ij" else F.col(c) for c in columns]))


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label)."""
    usable = F.col("label").isNotNull() & _usable(F.col("embedding"))
    rows = vectors.select("vec_id", "label", "embedding").withColumn(
        "node", F.when(usable, F.xxhash64("label", "embedding"))
    )
    classes = (
        rows.filter("node IS NOT NULL")
        .groupBy("node", "label", F.col("embedding").alias("vector"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"))
        .withColumn("size", F.size("vector"))
        .transform(durable)
    )
    whole = classes.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("width")).first()
    if not whole.n:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    width, threshold = whole.width, settings.threshold
    largest = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    index = build(classes, whole.n, largest, width, settings)
    placed = _placed(classes.drop("rep"), index, width, threshold).transform(durable)

    def verify(block: pd.DataFrame) -> pd.DataFrame:
        return _linked(block, width, threshold)

    found = (
        _blocks(placed, max(1, min(64, largest // 64)))
        .groupBy("label", "size", "cell", "i", "j")
        .applyInPandas(verify, "node long, n_links long, root long")
        .transform(durable)
    )
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    grouped = classes.select("node", "n", "rep").join(joined, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_node = grouped.join(least, "component").join(links, "node", "left").select(
        "node", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
