"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class from the start, whatever their number. A
class has ``4 * trees`` MinHash values; a tree is the order of all classes by the signature
rotated to the tree's own values. Classes that agree on the first four values of an order
form a region; a region with more than ``region_size`` classes is deepened to six values.

Candidates come in two steps. First each class is compared with the neighbours with which it
shares the longest prefixes, two at most, which joins most of what belongs together. Then
the classes of every region that still holds several components are compared with each other
across components, so that no pair is capped away: in blocks of bounded size, first by
sketches of 1024 bits, which leave only classes with a likely partner, then by the full
sets. A block hands on a spanning forest of its links and no pairs; a region of one
component costs nothing more. All links are confirmed on full sets; components follow.

Values are compared as 64-bit hashes of shingles, classes by a 64-bit hash of their sets.

Defined results: NULL text and text without words have 0 shingles and are linked with
nothing; repeated rows form one class; rows without an id take part and are never kept next
to a row with one; ties need no rule, since the smallest id of a component is unique; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.rows import durable, slices, with_columns

DEPTH = 4  # values that begin a region
MORE = 2  # further values that deepen a large one
SKETCH_BITS = 1024
# Classes on a side of a block.
BLOCK = 1024
# Shingles shared by more rows of a block than this are counted by a matrix product.
_RARE = 8


@dataclass(frozen=True)
class Settings:
    """Two sets are linked if 100 * intersection >= ``percent`` * union."""

    shingle: int = 3
    percent: int = 85
    trees: int = 24
    region_size: int = 32
    neighbours: int = 2
    seed: int = 5

    @property
    def sketch_distance(self) -> int:
        """Bits in which a linked pair may differ: 4.5 standard deviations above the mean."""
        p = (1 - self.percent / 100) / 2
        return int(np.ceil(SKETCH_BITS * p + 4.5 * np.sqrt(SKETCH_BITS * p * (1 - p))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(shingle, len(words))
    runs = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + each[i : len(words) - size + 1 + i])
    runs.sort()
    return runs[np.append(True, runs[1:] != runs[:-1])]


def _class_of(values: np.ndarray) -> int:
    """One number for a set, in the range of a signed 64-bit integer."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes())).astype(np.int64))


def _functions(settings: Settings) -> np.ndarray:
    rng = np.random.default_rng(settings.seed)
    return rng.integers(0, 2**32, settings.trees * DEPTH, dtype=np.uint32) | np.uint32(1)


def _sketch_functions(settings: Settings) -> np.ndarray:
    rng = np.random.default_rng(settings.seed + 1)
    return rng.integers(0, 2**32, SKETCH_BITS, dtype=np.uint32) | np.uint32(1)


def signature(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value under each hash function."""
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 128):
        np.minimum(least, (short[start : start + 128, None] * factors).min(0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _features(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n_shingles, class, signature, digest) of every row; class NULL for an empty set.

    The digest of the text tells rows of one id apart, also where there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _functions(settings)
        for batch in slices(batches, "text"):
            sizes, classes, signatures, digests = [], [], [], []
            for text in batch.column("text").to_pylist():
                values = shingle_set(text, settings.shingle)
                digests.append(hashlib.md5((text or "").encode()).digest())
                sizes.append(len(values))
                classes.append(_class_of(values) if len(values) else None)
                signatures.append(signature(values, factors).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.array(digests, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "class", "signature", "digest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, class long, signature binary, digest binary"
    )


def _orders(classes: DataFrame, settings: Settings) -> DataFrame:
    """One row per class and tree: region (tree and first values), tail (next values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16)
            quads = flat.reshape(batch.num_rows, settings.trees, DEPTH).astype(np.uint64)
            packed = quads[..., 0] << np.uint64(48) | quads[..., 1] << np.uint64(32) | quads[..., 2] << np.uint64(16) | quads[..., 3]
            tree = np.arange(settings.trees, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            region = _mix(packed + tree)
            tail = np.roll(packed, -1, axis=1) ^ np.uint64(1 << 63)  # keeps the order when signed
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(region.view(np.int64).ravel()),
                    pa.array(tail.view(np.int64).ravel()),
                    pa.array(np.repeat(batch.column("class").to_numpy(), settings.trees)),
                ],
                names=["region", "tail", "class"],
            )

    return classes.select("class", "signature").mapInArrow(run, "region long, tail long, class long")


def _regions(orders: DataFrame, settings: Settings) -> DataFrame:
    """The orders, reduced to regions of two classes or more, large ones deepened."""
    sizes = orders.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = orders.join(sizes, "region").transform(durable)
    large = rows.filter(F.col("size") > settings.region_size).select(
        F.xxhash64("region", F.shiftright("tail", 64 - 16 * MORE)).alias("region"), "tail", "class"
    )
    deep = large.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("region")
    small = rows.filter(F.col("size") <= settings.region_size).select("region", "tail", "class")
    return small.unionByName(large.join(deep, "region").select("region", "tail", "class"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that follow each other in an order, with the bits of the tail they share."""
    last = None
    for batch in batches:
        region, tail, klass = (batch.column(c).to_numpy() for c in ("region", "tail", "class"))
        if last is not None:
            region, tail, klass = (np.append(x, y) for x, y in zip(last, (region, tail, klass)))
        last = tuple(x[-1:] for x in (region, tail, klass))
        near = np.flatnonzero(region[1:] == region[:-1])
        a, b = klass[near], klass[near + 1]
        differ = (tail[near] ^ tail[near + 1]).view(np.uint64)
        shared = sum((differ >> np.uint64(64 - 16 * k) == 0).astype(np.int64) for k in (1, 2, 3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(DEPTH + shared)],
            names=["a", "b", "shared"],
        )


def _closest(regions: DataFrame, settings: Settings) -> DataFrame:
    """For each class the neighbours with which it shares most, over all orders."""
    pairs = (
        regions.repartitionByRange("region", "tail", "class")
        .sortWithinPartitions("region", "tail", "class")
        .mapInArrow(_neighbours, "a long, b long, shared long")
        .groupBy("a", "b")
        .agg(F.sum("shared").alias("shared"))
        .transform(durable)
    )
    ends = pairs.select(F.col("a").alias("node"), "a", "b", "shared").union(
        pairs.select(F.col("b").alias("node"), "a", "b", "shared")
    )
    # A class has two neighbours in each tree at most.
    best = Window.partitionBy("node").orderBy(F.desc("shared"), "a", "b")
    return ends.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= settings.neighbours).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            keep, before, one = [], None, None
            for a, b, text_a, text_b in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b"))):
                if one is None or a != before:
                    before, one = a, shingle_set(text_a.as_py(), settings.shingle)
                two = shingle_set(text_b.as_py(), settings.shingle)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= settings.percent * (len(one) + len(two) - both))
            rows = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield rows

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _representatives(docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """(class, text, sketch) of one document of each class; ``classes`` has class and place,
    the id and the digest of that document. An id alone may be missing or stand for many texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _sketch_functions(settings)
        for batch in slices(batches, "text"):
            same, sketches = [], []
            for klass, text in zip(batch.column("class").to_pylist(), batch.column("text")):
                values = shingle_set(text.as_py(), settings.shingle)
                same.append(klass == _class_of(values))
                sketches.append(np.packbits((signature(values, factors) & 1).astype(np.uint8)).tobytes())
            rows = with_columns(batch, sketch=pa.array(sketches, pa.binary()))
            yield rows.filter(pa.array(same, pa.bool_()))

    rows = docs.select("doc_id", "text", F.unhex(F.md5("text")).alias("digest"))
    here = F.col("doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("digest") == F.col("place.digest"))
    rows = rows.join(classes, here)
    found = rows.select("class", "text").mapInArrow(run, "class long, text string, sketch binary")
    return found.dropDuplicates(["class"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets of a block."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(starts, len(values)))
    pairs = []
    for c in range(2, _RARE + 1):
        rows = owner[starts[counts == c][:, None] + np.arange(c)]
        pairs += [rows[:, p] * n + rows[:, q] for p in range(c) for q in range(p + 1, c)]
    both = np.bincount(np.concatenate(pairs), minlength=n * n).reshape(n, n).astype(np.float32)
    both += both.T
    often = np.flatnonzero(counts > _RARE)
    for part in np.array_split(often, max(1, -(-len(often) // 4096))):
        held = np.zeros((n, len(part)), np.float32)
        column = np.repeat(np.arange(len(part)), counts[part])
        at = np.repeat(starts[part] - np.cumsum(counts[part]) + counts[part], counts[part]) + np.arange(len(column))
        held[owner[at], column] = 1
        both += held @ held.T
    return both


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (region, class, component) of regions of several components, dealt over cells.

    A cell is a pair of blocks of one region, so every pair of its classes meets in a cell.
    """
    counts = rows.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("region").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    rows = rows.join(sizes.select("region", blocks.alias("blocks")), "region")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select("region", "class", "component", cell.alias("cell"))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, from batches sorted by cell."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("cell").to_numpy()
        edges = np.flatnonzero(cells[1:] != cells[:-1]) + 1
        for start, end in zip([0, *edges], [*edges, len(cells)]):
            if held and cells[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = cells[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell")


def _promising(rows: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The (region, class, component) whose sketch is near one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            component = cell.column("component").to_numpy()
            if len(component) < 2:
                continue
            packed = np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint8)
            bits = np.unpackbits(packed.reshape(len(component), -1), axis=1).astype(np.float32)
            ones = bits.sum(1)
            near = ones[:, None] + ones[None, :] - 2 * (bits @ bits.T) <= settings.sketch_distance
            near &= component[:, None] != component[None, :]
            found = cell.filter(pa.array(near.any(1))).select(["region", "class", "component"])
            yield from found.to_batches()

    rows = _mixed(rows).join(texts.select("class", "sketch"), "class")
    return _sorted_cells(rows).mapInArrow(run, "region long, class long, component long").distinct()


def _across(regions: DataFrame, joined: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links between classes that share a region but no component, as a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            component, node = cell.column("component").to_numpy(), cell.column("class").to_numpy()
            if len(component) < 2:
                continue
            sets = [shingle_set(t.as_py(), settings.shingle) for t in cell.column("text")]
            sizes = np.array([len(s) for s in sets])
            both = overlaps(sets)
            linked = 100 * both >= settings.percent * (sizes[:, None] + sizes[None, :] - both)
            linked &= component[:, None] != component[None, :]
            # Smallest class of each connected part of the cell.
            root, big = node.copy(), np.iinfo(np.int64).max
            while True:
                least = np.minimum(root, np.where(linked, root[None, :], big).min(1))
                if (least == root).all():
                    break
                root = least
            edge = root != node
            yield pa.RecordBatch.from_arrays([pa.array(node[edge]), pa.array(root[edge])], names=["a", "b"])

    rows = regions.join(joined, regions["class"] == joined["node"], "left").select(
        "region", regions["class"], F.coalesce("component", regions["class"]).alias("component")
    )
    likely = _promising(rows.transform(durable), texts, settings).transform(durable)
    rows = _mixed(likely).join(texts.select("class", "text"), "class")
    return _sorted_cells(rows).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    features = _features(docs, settings).transform(durable)
    classes = (
        features.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "digest")).alias("place"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
        .transform(durable)
    )
    regions = _regions(_orders(classes, settings), settings).transform(durable)
    near = regions.select("class").distinct().join(classes.select("class", "place"), "class")
    texts = _representatives(docs, near, settings).transform(durable)

    first = _confirmed(_closest(regions, settings), texts, settings).transform(durable)
    joined = components(first).transform(durable)
    second = _across(regions, joined, texts, settings).transform(durable)
    stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    linked = joined if second.isEmpty() else components(stars.union(second))

    # The smallest document id of each component, by way of its classes.
    grouped = classes.select("class", "rep").join(linked, F.col("class") == F.col("node"), "left")
    grouped = grouped.select("class", "rep", F.coalesce("component", "class").alias("component"))
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = grouped.join(least, "component").select("class", "component_id")
    out = features.select("doc_id", "n_shingles", "class").join(by_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each component with all its columns: the smallest document id, NULL last.

    A row is known by its id and text together, so that missing and repeated ids take no other
    row along; of rows equal in both, one stays. Rows without words all stay.
    """
    told = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    own = [F.xxhash64(*told).alias("k1"), F.xxhash64(F.lit("second"), *told).alias("k2")]
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), *own)
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), settings)
    kept = found.filter("kept").select("doc_id.k1", "doc_id.k2", (F.col("n_shingles") == 0).alias("empty")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("whole"), *own).join(kept, ["k1", "k2"])
    rows = rows.withColumn("each", F.when(F.col("empty"), F.monotonically_increasing_id()))
    return rows.dropDuplicates(["k1", "k2", "each"]).select("whole.*")
