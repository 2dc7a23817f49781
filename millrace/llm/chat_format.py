"""Chat transcripts to canonical turns, roles recovered by a hidden Markov model.

A transcript is a sequence of lines. Each role has two states, the first line of a turn and
a further line. A state emits a line's features independently: the kind of speaker marker
at its head, whether it asks, how long it is, whether it opens the transcript. Transition
and emission probabilities are counted on a bounded sample of labelled turns, each next to
its predecessor. Viterbi decoding then gives the likeliest states, markers are stripped and
turns are rendered.

Decoding is exact on transcripts of any length without holding one in a task: a transcript
is cut into chunks of turns, and these into pieces of at most ``PIECE_LINES`` lines, however
many a turn or the rows without a turn number have. A piece becomes the matrix of best
log-probabilities from any entry state to any exit state, pieces are chained by these
matrices, and each is decoded between its two known ends. A turn that such a boundary cuts
gives two rows, of which the second ``continues``. The pieces of a chunk are told by one range
sort of all lines, which no key, however frequent, brings into one task: only lines that are
alike in every column are neighbours for certain.

Defined results: NULL text is one empty line; a NULL turn or line number counts as 0; NULL conversation ids form a conversation;
lines of one turn and number are ordered by features and text, so only equal ones keep any order; of
equally likely paths the one through lower states is taken; an empty table gives an empty
table; unlabelled rows, and roles beside ``ROLES``, teach nothing; repeated rows teach once,
and of several rows of one turn the least role counts as the one before the next turn. Other
columns, whatever their names, have no effect and are not in the result of ``recover``; a
column named like a feature is replaced by ``with_features``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.rows import durable, with_columns

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role: first line; 2 * role + 1: further line

# Speaker names at the head of a line, by role; punctuation must follow.
SPEAKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|question|customer|q",
    "assistant": "assistant|ai|bot|answer|response|model|a",
}
CHUNK_TURNS = 256
PIECE_LINES = 1024
_FEATURES = {"marker": len(ROLES) + 1, "asks": 2, "length": 5, "opens": 2}
_SMOOTHING = 0.5


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` labelled turns (about) are counted."""

    fit_rows: int = 20_000


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    step: np.ndarray  # from state, to state
    emit: dict[str, np.ndarray]  # state, value


def _marker_pattern(role: str) -> str:
    return rf"(?i)^\s*(?:#+\s*|<\|\s*|\[\s*|\*\*\s*)?(?:{SPEAKERS[role]})(?:\s*\|>|\s*\]|\s*\*\*)?\s*(?:[:>]|(?<=[>\]]))\s*"


def with_features(lines: DataFrame) -> DataFrame:
    """Add the feature columns to lines (conv_id, turn, line, text)."""
    text = F.coalesce("text", F.lit(""))
    marker = F.lit(0)
    for i, role in enumerate(ROLES, 1):
        marker = F.when(text.rlike(_marker_pattern(role)), F.lit(i)).otherwise(marker)
    size = F.length(text)
    length = sum(((size > limit).cast("int") for limit in (0, 60, 160, 400)), F.lit(0))
    return lines.select(
        *[F.col(f"`{c}`") for c in lines.columns if c.lower() not in _FEATURES],
        marker.alias("marker"),
        F.endswith(F.rtrim(text), F.lit("?")).cast("int").alias("asks"),
        length.alias("length"),
        ((F.coalesce("turn", F.lit(0)) == 0) & (F.coalesce("line", F.lit(0)) == 0)).cast("int").alias("opens"),
    )


def stripped(text: Column, marker: Column) -> Column:
    """The line without its speaker marker."""
    out = text
    for i, role in enumerate(ROLES, 1):
        out = F.when(marker == i, F.regexp_replace(text, _marker_pattern(role), "")).otherwise(out)
    return out


def split_lines(turns: DataFrame) -> DataFrame:
    """Lines of turns; other columns are repeated."""
    pieces = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n"))
    others = [F.col(f"`{c}`") for c in turns.columns if c not in ("text", "line")]
    return turns.select(*others, pieces.alias("line", "text"))


def learn(turns: DataFrame, settings: Settings = Settings()) -> Model:
    """Count a sample of labelled transcript turns (conv_id, turn, role, text with markers)."""
    known = turns.filter(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    rate = min(1.0, settings.fit_rows / max(1, known.count()))
    row = ["conv_id", "turn", "role", "text"]
    draw = F.pmod(F.xxhash64(F.lit("fit"), *row), F.lit(1_000_000_000)) < math.ceil(1e9 * rate)
    sample = known.filter(draw).select(*row).distinct().transform(durable)  # bounded
    lines = with_features(split_lines(sample))
    role = sum((F.when(F.col("role") == r, F.lit(2 * i)).otherwise(0) for i, r in enumerate(ROLES)), F.lit(0))
    state = role + (F.col("line") > 0).cast("int")
    emit = {f: np.full((STATES, n), _SMOOTHING) for f, n in _FEATURES.items()}
    for r in lines.groupBy(state.alias("s"), *_FEATURES).count().collect():  # states x feature values
        for f in _FEATURES:
            emit[f][r.s, r[f]] += r["count"]

    step = np.full((STATES, STATES), _SMOOTHING)
    start = np.full(STATES, _SMOOTHING)
    # Inside a turn: from its first line to a second, and on.
    sizes = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    inside = sample.groupBy("role").agg(F.sum((sizes > 1).cast("long")).alias("two"), F.sum(sizes).alias("all"), F.count(F.lit(1)).alias("n"))
    for r in inside.collect():
        s = 2 * ROLES.index(r.role)
        step[s, s + 1] += r.two
        step[s + 1, s + 1] += r["all"] - r.n - r.two
    # Between turns: a sampled turn and the one before it.
    # One before each, also where a turn was given several times.
    before = known.select("conv_id", (F.col("turn") + 1).alias("turn"), F.struct(F.col("role").alias("last"), (sizes > 1).alias("long")).alias("p"))
    before = before.join(sample.select("conv_id", "turn").distinct(), ["conv_id", "turn"])
    before = before.groupBy("conv_id", "turn").agg(F.min("p").alias("p")).select("conv_id", "turn", "p.*")
    pairs = sample.select("conv_id", "turn", "role").join(before, ["conv_id", "turn"], "left")
    for r in pairs.groupBy("last", "long", "role").count().collect():
        s = 2 * ROLES.index(r.role)
        if r.last is None:
            start[s] += r["count"]
        else:
            step[2 * ROLES.index(r.last) + int(r.long), s] += r["count"]

    def logs(counts: np.ndarray) -> np.ndarray:
        return np.log(counts / counts.sum(-1, keepdims=True))

    return Model(logs(start), logs(step), {f: logs(c) for f, c in emit.items()})


def _scores(model: Model, features: dict[str, np.ndarray]) -> np.ndarray:
    """Log-probability of each line in each state."""
    return sum(model.emit[f].T[features[f]] for f in _FEATURES)


def transfer(model: Model, scores: np.ndarray, best: np.ndarray | None = None) -> np.ndarray:
    """Best log-probability from a state before the lines to the state of the last line.

    ``best`` holds rows of what came before, by the state they end in.
    """
    if best is None:
        best = np.full((STATES, STATES), -np.inf)
        np.fill_diagonal(best, 0.0)
    for line in scores:
        best = (best[:, :, None] + model.step[None]).max(1) + line
    return best


def decode(model: Model, scores: np.ndarray, entry: int | None, leave: int | None) -> np.ndarray:
    """Viterbi states between a known state before (None: the start) and a known last state."""
    first = (model.start if entry is None else model.step[entry]) + scores[0]
    best, back = first, np.zeros((len(scores), STATES), np.int64)
    for i in range(1, len(scores)):
        ways = best[:, None] + model.step
        back[i] = ways.argmax(0)
        best = ways.max(0) + scores[i]
    states = np.zeros(len(scores), np.int64)
    states[-1] = int(best.argmax()) if leave is None else leave
    for i in range(len(scores) - 1, 0, -1):
        states[i - 1] = back[i, states[i]]
    return states


_ROWS = 5000  # result rows that leave a task at a time


def _rows(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


_KEY = ["conv_id", "chunk", "piece"]


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with an equal ``_KEY`` in sorted batches."""
    held_key, held = None, None
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in [*_KEY, *names]}
        keys = list(zip(*(columns[c] for c in _KEY)))
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = {c: columns[c][start:i] for c in names}
            if held is not None and held_key == keys[start]:
                for c in names:
                    held[c] += part[c]
            else:
                if held is not None:
                    yield held_key, held
                held_key, held = keys[start], part
            start = i
    if held is not None:
        yield held_key, held


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``pos``, the place of a line in its chunk, and ``piece``; the rows are written."""
    order = ["conv_id", "chunk", "turn", "line", *_FEATURES, "text", "truth"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, pos = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            places = []
            for key in zip(batch.column("conv_id").to_pylist(), batch.column("chunk").to_pylist()):
                pos = pos + 1 if key == last else 0
                last = key
                places.append(pos)
            yield with_columns(batch, part=pa.array([part] * len(places), pa.int32()), at=pa.array(places, pa.int64()))

    ordered = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*ordered.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
    placed = ordered.mapInArrow(number, schema).transform(durable)
    # A chunk that begins in an earlier part: one a part at most, the first there. These few
    # rows, no more than there are parts, go to all tasks.
    sizes = placed.groupBy("part", "conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id", "chunk").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.sum("n").over(earlier)).filter("before > 0")
    cut = sizes.select(F.col("part").alias("in"), F.struct("conv_id", "chunk").alias("of"), "before")
    here = F.struct("conv_id", "chunk").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))
    placed = placed.join(F.broadcast(cut), here, "left")
    placed = placed.withColumn("pos", F.col("at") + F.coalesce("before", F.lit(0)))
    piece = F.floor(F.col("pos") / PIECE_LINES).cast("long").alias("piece")
    return placed.select(*_KEY[:2], piece, "pos", *_FEATURES, "text", "truth")


def _features_of(rows: dict[str, list]) -> dict[str, np.ndarray]:
    return {f: np.array(rows[f], np.int64) for f in _FEATURES}


def _ends(pieces: DataFrame, model: Model) -> DataFrame:
    """(conv_id, chunk, piece, entry, leave): the best states around each piece.

    A conversation is here one small row per piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"conv_id": conv_kind, "chunk": pa.int64(), "piece": pa.int64(), "entry": pa.int32(), "leave": pa.int32()}
        out, conv, order, matrices = [], None, [], []

        def finish():
            """Chain the pieces of one conversation and go back over the best way."""
            arrive, back = matrices[0][0], []  # as if the transcript began with the piece
            for m in matrices[1:]:
                ways = arrive[:, None] + m[1:]
                back.append(ways.argmax(0))
                arrive = ways.max(0)
            leave = [int(arrive.argmax())]
            for b in reversed(back):
                leave.append(int(b[leave[-1]]))
            leave.reverse()
            out.extend((conv, *o, e, x) for o, e, x in zip(order, [None, *leave[:-1]], leave))

        for batch in batches:
            for c, *o, m in zip(*(batch.column(n).to_pylist() for n in [*_KEY, "best"])):
                if order and c != conv:
                    finish()
                    order, matrices = [], []
                    if len(out) > _ROWS:
                        yield _rows(out, kinds)
                        out = []
                conv = c
                order.append(o)
                matrices.append(np.array(m).reshape(1 + STATES, STATES))
        if order:
            finish()
        yield _rows(out, kinds)

    kind = pieces.schema["conv_id"].dataType
    conv_kind = to_arrow_type(kind)
    ordered = pieces.repartition("conv_id").sortWithinPartitions(*_KEY)
    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, chunk long, piece long, entry int, leave int")


def recover(lines: DataFrame, model: Model) -> DataFrame:
    """Recovered turns of transcript lines (conv_id, turn, line, text, and truth or NULL).

    One row per turn, chunk and piece: conv_id, chunk, piece, n, role, continues, text, n_lines,
    and n_right, the lines whose ``truth`` is the recovered role.
    """
    rows = with_features(lines.select("conv_id", "turn", "line", "text", "truth"))
    rows = rows.withColumn("chunk", F.floor(F.coalesce("turn", F.lit(0)) / CHUNK_TURNS).cast("long"))
    rows = rows.withColumn("text", stripped(F.coalesce("text", F.lit("")), F.col("marker")))
    kind = lines.schema["conv_id"].dataType.simpleString()
    conv_kind = to_arrow_type(lines.schema["conv_id"].dataType)
    features = list(_FEATURES)
    key_kinds = {"conv_id": conv_kind, "chunk": pa.int64(), "piece": pa.int64()}
    matrix_kinds = {**key_kinds, "best": pa.list_(pa.float64())}
    turn_kinds = {
        **key_kinds,
        "n": pa.int64(),
        "role": pa.string(),
        "continues": pa.bool_(),
        "text": pa.string(),
        "n_lines": pa.int64(),
        "n_right": pa.int64(),
    }

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for key, group in _groups(batches, features):
            scores = _scores(model, _features_of(group))
            # As the first piece of its conversation, and after each state.
            first = np.vstack([model.start, model.step]) + scores[0]
            out.append((*key, transfer(model, scores[1:], first).ravel().tolist()))
            if len(out) == _ROWS:
                yield _rows(out, matrix_kinds)
                out = []
        yield _rows(out, matrix_kinds)

    rows = _numbered(rows)
    narrow = rows.select(*_KEY, "pos", *features).repartition(*_KEY).sortWithinPartitions(*_KEY, "pos")
    ends = _ends(narrow.mapInArrow(matrices, f"conv_id {kind}, chunk long, piece long, best array<double>"), model)
    ends = ends.select(*[F.col(c).alias(f"e_{c}") for c in _KEY], "entry", "leave")

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["entry", "leave", *features, "text", "truth"]
        out, held = [], 0
        for key, g in _groups(batches, names):
            states = decode(model, _scores(model, _features_of(g)), g["entry"][0], g["leave"][0])
            begins = [i for i, s in enumerate(states.tolist()) if i == 0 or s % 2 == 0 or s // 2 != states[i - 1] // 2]
            for n, (a, b) in enumerate(zip(begins, [*begins[1:], len(states)])):
                role, text = ROLES[states[a] // 2], "\n".join(g["text"][a:b])
                entry = g["entry"][0]
                continues = bool(n == 0 and states[a] % 2 and entry is not None and entry // 2 == states[a] // 2)
                out.append((*key, n, role, continues, text, b - a, sum(t == role for t in g["truth"][a:b])))
                held += len(text)
            if held > 4 << 20 or len(out) > _ROWS:
                yield _rows(out, turn_kinds)
                out, held = [], 0
        yield _rows(out, turn_kinds)

    same = F.col("conv_id").eqNullSafe(F.col("e_conv_id"))
    for c in _KEY[1:]:
        same &= F.col(c) == F.col(f"e_{c}")
    joined = rows.join(ends, same).select(*_KEY, "pos", "entry", "leave", *features, "text", "truth")
    ordered = joined.repartition(*_KEY).sortWithinPartitions(*_KEY, "pos")
    return ordered.mapInArrow(
        turns,
        f"conv_id {kind}, chunk long, piece long, n long, role string, continues boolean, text string, n_lines long, n_right long",
    )


def render(turns: DataFrame) -> DataFrame:
    """Add the canonical text of each recovered turn."""
    head = F.when(F.col("continues"), F.lit("")).otherwise(F.concat(F.lit("<|"), "role", F.lit("|>\n")))
    return turns.withColumn("rendered", F.concat(head, "text", F.lit("\n<|end|>\n")))
