"""Encoding, decoding and counting against the libraries themselves."""

import hashlib
import random

import public_tokenizers as public
import pytest
from llm_helpers import ODD_TEXTS, documents, given, random_texts
from tokenizers import Tokenizer

from millrace.llm import byte_bpe, token_counts
from millrace.llm.queries import RANKS, WORDS

TEXTS = ODD_TEXTS + random_texts(300)


def test_encoding_equals_the_library_and_round_trips(spark):
    library = byte_bpe.encoding(RANKS, public.PATTERN)
    df = byte_bpe.decode(byte_bpe.encode(documents(spark, TEXTS), RANKS, public.PATTERN), RANKS, public.PATTERN)
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert rows[i].ids == library.encode_ordinary(text or "")
        assert bytes(rows[i].decoded) == (text or "").encode()
    assert rows[0].source == "src0"  # other columns are kept


def test_digests(spark):
    docs = documents(spark, ["two words", None])
    encoded = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "text"), RANKS, public.PATTERN), RANKS, public.PATTERN)
    a, b = byte_bpe.digests(encoded).orderBy("doc_id").collect()
    ids = byte_bpe.encoding(RANKS, public.PATTERN).encode_ordinary("two words")
    assert a.n_tokens == len(ids)
    assert a.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert a.decoded_sha256 == hashlib.sha256(b"two words").hexdigest()
    assert (b.n_tokens, b.ids_sha256, b.decoded_sha256) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("most", [7, 20, 100])
def test_cutting_long_texts_changes_nothing(most):
    library = byte_bpe.encoding(RANKS, public.PATTERN)
    for text in TEXTS:
        assert byte_bpe.encode_text(text or "", RANKS, public.PATTERN, most).tolist() == library.encode_ordinary(text or "")


def test_runs_the_library_cannot_take():
    text = "start" + " " * 400_000 + "x" * 120_000 + "\n" * 300_000
    ids = byte_bpe.encode_text(text, RANKS, public.PATTERN)
    assert byte_bpe.encoding(RANKS, public.PATTERN).decode(ids.tolist()) == text


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    rows = {r.doc_id: r for r in token_counts.count_tokens(documents(spark, TEXTS), WORDS, limit=100).collect()}
    for i, text in enumerate(TEXTS):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (n, len((text or "").encode()), n > 100)


def test_counts_of_given_documents_and_a_full_memory(spark, monkeypatch):
    texts = [r.text for r in given(spark, "documents").collect()]
    library = Tokenizer.from_file(WORDS)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    known = {}
    vocab = token_counts.vocabulary(WORDS)
    got = [n for i in range(0, len(texts), 7) for n in token_counts.count_texts(vocab, texts[i : i + 7], known)]
    assert got == want


def unbroken(n, seed):
    """Letters without a break: random, repeated, and words run together."""
    pick = random.Random(seed)
    words = [r for t in ("information", "the", "ofthe", "zzz", "éé", "q") for r in [t] * 3]
    pieces = ["".join(pick.choice("abcdeé") for _ in range(n)), "a" * n, "ab" * (n // 2)]
    return [*pieces, "".join(pick.choice(words) for _ in range(n // 4)), "aab" * (n // 3) + "b" * (n % 7)]


@pytest.mark.parametrize("most", [1, 3, 40])
def test_queued_pre_tokens_count_alike(monkeypatch, most):
    library, vocab = Tokenizer.from_file(WORDS), token_counts.vocabulary(WORDS)
    texts = [t or "" for t in TEXTS] + [t for n in (2, 5, 30, 500) for t in unbroken(n, n)]
    texts += [" ".join(unbroken(60, 9))]
    monkeypatch.setattr(token_counts, "QUEUED_BYTES", most)
    known = {}
    assert token_counts.count_texts(vocab, texts, known) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert max(map(len, known)) <= token_counts.REMEMBERED_BYTES


def test_long_pre_tokens_cost_their_length():
    library, vocab = Tokenizer.from_file(WORDS), token_counts.vocabulary(WORDS)
    for text in unbroken(50_000, 1):
        assert token_counts.count_texts(vocab, [text], {}) == [len(library.encode(text, add_special_tokens=False).ids)]
    ranks, asked = type(vocab).ranks, []
    try:
        type(vocab).ranks = lambda self, pairs: asked.append(len(pairs)) or ranks(self, pairs)
        token_counts.count_texts(vocab, [unbroken(200_000, 2)[0]], {})
    finally:
        type(vocab).ranks = ranks
    assert sum(asked) <= 4 * 200_000


def test_empty_tables_and_clashing_names(spark):
    docs = documents(spark, ["a b"]).selectExpr("doc_id", "text", "'x' AS n_tokens", "'y' AS ids", "'z' AS extra")
    assert byte_bpe.encode(docs, RANKS, public.PATTERN).first().asDict()["extra"] == "z"
    assert token_counts.count_tokens(docs, WORDS).first().n_tokens == 2
    none = docs.filter("doc_id < 0")
    assert byte_bpe.encode(none, RANKS, public.PATTERN).count() == 0
    assert token_counts.count_tokens(none, WORDS).count() == 0
