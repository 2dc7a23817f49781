"""Token counts by rank-synchronous merging in numpy.

The vocabulary file gives normaliser, pre-tokeniser and merges. Texts fall into chunks at
ASCII white space, across which neither normalising nor splitting reaches; every chunk not
yet known is normalised and split, and all its pre-tokens go into one ragged array of
symbols. In each round every sequence merges all places of its own lowest-ranked pair at
once, until no sequence has a pair with a rank; the surviving symbols are counted. Doing
all places of a pair at once is exact because each merge makes a symbol no other merge
makes, so a new pair always ranks after the pair that made it (checked on loading). A long
pre-token would be scanned once for each of its many ranks; it keeps the places of each rank
in a queue instead and visits only those, so its cost grows with its length.

Defined results: NULL and empty text count 0 tokens and 0 bytes; a special token's string
inside a text counts as one token; repeated rows count alike; other columns are kept, and
one whose name clashes with a result column is replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from millrace.llm.rows import slices, unused, with_columns

# Chunks whose counts a worker remembers; the memory is emptied when it is full.
REMEMBERED = 400_000
# Longer ones are counted whenever they occur, which bounds the bytes remembered.
REMEMBERED_BYTES = 128
# Pre-tokens above this length wait for their ranks in a queue.
QUEUED_BYTES = 1 << 14

_NO_RANK = np.iinfo(np.int32).max
# Chunks that need no Unicode tables: visible ASCII without apostrophes, and the two-byte
# letters U+00C0 to U+00FF, which have a one-to-one lower case and are normalised already.
_SIMPLE = re.compile(rb"(?:[!-&(-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")


class Vocabulary:
    """Merges, normaliser and pre-tokeniser of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        unknown = ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback")
        refused = [k for k in unknown if model.get(k)]
        if model["type"] != "BPE" or refused:
            raise ValueError(f"only plain BPE files are counted here, not {refused or model['type']}")
        whole = Tokenizer.from_file(path)
        self.normalize = whole.normalizer.normalize_str if whole.normalizer else str
        self.pre_tokenize = whole.pre_tokenizer.pre_tokenize_str
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that depend on their surroundings are not counted here")
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

        keys, merged = [], []
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            keys.append(ids[left] << 32 | ids[right])
            merged.append(ids[left + right])
        if len(set(merged)) != len(merged):
            raise ValueError("two merges make one symbol; such files are not counted here")
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.rank = order.astype(np.int32)
        self.merged = np.array(merged, np.int64)  # by rank

        # Symbols of single bytes, by 256 * (last of its pre-token) + byte.
        byte_of = {c: b for b, c in byte_alphabet().items()}
        self.byte_of = byte_of
        self.base = np.full(512, -1, np.int64)
        for char, byte in byte_of.items():
            self.base[byte] = ids[char]
            self.base[256 + byte] = ids[char + suffix]
        grid = self.base[:, None] << 32 | self.base[None, :]
        self.first = self.ranks(grid.ravel()).reshape(512, 512)
        # The quick route for simple chunks holds if the file treats them as it does.
        probe = ["Az", "ÀÉþß", "a1b22", "x,.y!", "ça-Va.", "9é"]
        same = [self.pieces(p.encode()) for p in probe] == [
            [b"az"], ["àéþß".encode()], [b"a", b"1", b"b", b"2", b"2"], [b"x", b",.", b"y", b"!"],
            ["ça".encode(), b"-", b"va", b"."], [b"9", "é".encode()],
        ]
        self.simple = _SIMPLE if same else re.compile(rb"(?!)")

    def pieces(self, chunk: bytes) -> list[bytes]:
        """Bytes of the pre-tokens of a chunk, by the library."""
        found = self.pre_tokenize(self.normalize(chunk.decode()))
        return [bytes(self.byte_of[c] for c in p) for p, _ in found]

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.rank[at], _NO_RANK)


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_counts(vocab: Vocabulary, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbols left of each pre-token; ``text`` holds their bytes, ``starts`` where each begins."""
    counts = np.diff(np.append(starts, len(text)))
    short = counts <= QUEUED_BYTES
    if not short.all():
        left = np.zeros_like(counts)
        for i in np.flatnonzero(~short):
            left[i] = queued_count(vocab, text[starts[i] : starts[i] + counts[i]])
        if short.any():
            begins = np.cumsum(counts[short]) - counts[short]
            left[short] = merge_counts(vocab, text[np.repeat(short, counts)], begins)
        return left
    owner = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
    last = np.append(owner[1:] != owner[:-1], True)
    symbol = text.astype(np.int16) + np.where(last, 256, 0).astype(np.int16)
    rank = np.full(len(text), _NO_RANK, np.int32)  # of the pair that begins here
    rank[:-1] = vocab.first[symbol[:-1], symbol[1:]]
    rank[last] = _NO_RANK
    symbol = vocab.base[symbol]
    while len(symbol):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(symbol)))
        counts[owner[starts]] = sizes
        lowest = np.minimum.reduceat(rank, starts)
        # Sequences without a ranked pair are done and leave the arrays.
        going = np.repeat(lowest != _NO_RANK, sizes)
        lowest = np.repeat(lowest, sizes)[going]
        symbol, owner, rank = symbol[going], owner[going], rank[going]
        hit = np.flatnonzero(rank == lowest) if len(rank) else rank
        if not len(hit):
            break
        # Overlapping places of one pair (a symbol repeated) merge from the left.
        fresh = np.append(True, np.diff(hit) != 1)
        nth = np.arange(len(hit))
        hit = hit[(nth - np.maximum.accumulate(np.where(fresh, nth, 0))) % 2 == 0]
        symbol[hit] = vocab.merged[rank[hit]]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
        hit -= np.arange(len(hit))  # where the merged symbols are now
        # Only pairs beside a merged symbol are new.
        new = np.concatenate([hit, hit - 1])
        new = new[new >= 0]
        rank[new] = _NO_RANK
        new = new[new < len(symbol) - 1]
        new = new[owner[new] == owner[new + 1]]
        rank[new] = vocab.ranks(symbol[new] << 32 | symbol[new + 1])
    return counts


def queued_count(vocab: Vocabulary, text: np.ndarray) -> int:
    """Symbols left of one pre-token: rank by rank, all places of a rank at once.

    A pair never makes one of its own rank or below, so every rank is taken up once.
    """
    n = left = len(text)
    symbol = text.astype(np.int64)
    symbol[-1] += 256
    rank = np.full(n, _NO_RANK, np.int32)  # of the pair that begins here
    rank[:-1] = vocab.first[symbol[:-1], symbol[1:]]
    symbol = vocab.base[symbol]
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def wait(places: np.ndarray) -> None:
        places = places[rank[places] != _NO_RANK]
        if not len(places):
            return
        places = places[np.argsort(rank[places], kind="stable")]
        ranks = rank[places]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(places, cuts)):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(queue, r)
            waiting[r].append(part)

    wait(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        hit = np.unique(np.concatenate(waiting.pop(r)))
        hit = hit[rank[hit] == r]  # not those that other merges took since
        if not len(hit):
            continue
        # Overlapping places merge from the left.
        nth = np.arange(len(hit))
        fresh = np.append(True, after[hit[:-1]] != hit[1:])
        hit = hit[(nth - np.maximum.accumulate(np.where(fresh, nth, 0))) % 2 == 0]
        gone = after[hit]
        follows = after[gone]
        symbol[hit], after[hit], rank[gone] = vocab.merged[r], follows, _NO_RANK
        inside = follows < n
        before[follows[inside]] = hit[inside]
        left -= len(hit)
        changed = np.unique(np.concatenate([hit, before[hit]]))
        changed = changed[changed >= 0]
        rank[changed] = _NO_RANK
        changed = changed[after[changed] < n]
        rank[changed] = vocab.ranks(symbol[changed] << 32 | symbol[after[changed]])
        wait(changed)
    return left


def _simple_pieces(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of simple chunks, where each pre-token begins, and its chunk."""
    text = np.frombuffer(b"".join(chunks), np.uint8).copy()
    begins = np.zeros(len(text), bool)
    ends = np.cumsum([len(c) for c in chunks])
    begins[ends[:-1]] = True
    begins[0] = True
    capital = (text >= 0x41) & (text <= 0x5A)
    capital[1:] |= (text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] <= 0x9E)
    text[capital] += 32
    letter = (text >= 0x80) | ((text >= 0x61) & (text <= 0x7A))
    digit = (text >= 0x30) & (text <= 0x39)
    begins[1:] |= (letter[1:] != letter[:-1]) | digit[1:] | digit[:-1]
    starts = np.flatnonzero(begins)
    return text, starts, np.searchsorted(ends, starts, side="right")


def chunk_counts(vocab: Vocabulary, chunks: Iterable[bytes]) -> dict[bytes, int]:
    """Tokens of each chunk (none is empty)."""
    simple, other = [], []
    match = vocab.simple.match
    for chunk in chunks:
        (simple if match(chunk) else other).append(chunk)
    found = {}
    if simple:
        text, starts, of = _simple_pieces(simple)
        n = np.bincount(of, merge_counts(vocab, text, starts), len(simple)).astype(np.int64)
        found.update(zip(simple, n.tolist()))
    if other:
        pieces = [vocab.pieces(c) for c in other]
        of = np.repeat(np.arange(len(other)), [len(p) for p in pieces])
        flat = [p for ps in pieces for p in ps]
        n = np.zeros(len(other), np.int64)
        if flat:
            starts = np.cumsum([0] + [len(p) for p in flat[:-1]])
            text = np.frombuffer(b"".join(flat), np.uint8)
            n = np.bincount(of, merge_counts(vocab, text, starts), len(other)).astype(np.int64)
        found.update(zip(other, n.tolist()))
    return found


def count_texts(vocab: Vocabulary, texts: list[str | None], known: dict[bytes, int]) -> list[int]:
    """Tokens of each text; ``known`` remembers chunks from call to call."""
    words, extra = [], []
    for text in texts:
        text, n = text or "", 0
        if vocab.special is not None and "<" in text:
            parts = vocab.special.split(text)
            n = len(parts) - 1
            words.append([w for p in parts for w in p.encode().split()] if n else text.encode().split())
        else:
            words.append(text.encode().split())
        extra.append(n)
    new = {w for ws in words for w in ws} - known.keys()
    if len(known) + len(new) > REMEMBERED:
        known.clear()
        new = {w for ws in words for w in ws}
    known.update(chunk_counts(vocab, new))
    counts = [n + sum(map(known.__getitem__, ws)) for n, ws in zip(extra, words)]
    for word in new:
        if len(word) > REMEMBERED_BYTES:
            del known[word]
    return counts


def count_tokens(df: DataFrame, path: str, *, text: str = "text", limit: int = 2048) -> DataFrame:
    """Replace the text column by n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    hidden = unused("_text", df.columns)

    def run(batches):
        vocab, known = vocabulary(path), {}
        for batch in slices(batches, hidden):
            texts = batch.column(hidden).to_pylist()
            counts = np.array(count_texts(vocab, texts, known), np.int64)
            yield with_columns(
                batch.drop_columns([hidden]),
                n_bytes=pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                n_tokens=pa.array(counts),
                over_limit=pa.array(counts > limit),
            )

    new = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    taken = {text.lower()} | {n for n, _ in new}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in new])
    columns = [F.col(f"`{f.name}`") for f in kept] + [F.col(f"`{text}`").alias(hidden)]
    return df.select(*columns).mapInArrow(run, schema)
