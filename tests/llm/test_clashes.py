"""Extra columns whose names are those the operators use themselves, and repeated turns."""

import public_tokenizers
from llm_helpers import ODD_TEXTS, documents
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, chat_format, token_counts
from millrace.llm.mixing import Mix, mix

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def clashing(df, names):
    return df.withColumns({n: F.lit(f"extra {n}") for n in names})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_byte_bpe_keeps_or_replaces_clashing_columns(spark):
    docs = documents(spark, ODD_TEXTS).select("doc_id", "text")
    names = ["_text", "__text", "ids", "decoded", "N_Tokens", "ids_sha256"]

    def run(df):
        ids = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
        return byte_bpe.digests(byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN))

    plain, extra = run(docs), run(clashing(docs, names))
    assert [c for c in extra.columns if c not in plain.columns] == ["_text", "__text"]
    assert len({c.lower() for c in extra.columns}) == len(extra.columns)
    assert rows(extra.select(plain.columns)) == rows(plain)
    assert {r[0] for r in extra.select("__text").collect()} == {"extra __text"}


def test_token_counts_keep_or_replace_clashing_columns(spark):
    docs = documents(spark, ODD_TEXTS).select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = token_counts.count_tokens(docs, path)
    extra = token_counts.count_tokens(clashing(docs, ["_text", "n_tokens", "Over_Limit"]), path)
    assert set(extra.columns) == {*plain.columns, "_text"}
    assert rows(extra.select(plain.columns)) == rows(plain)


CHAT = [
    ("c1", 0, "system", "system: be brief"),
    ("c1", 1, "user", "user: hello?\nmore"),
    ("c1", 2, "assistant", "assistant: hi"),
    (None, None, "user", None),
    ("c2", 0, "user", ""),
]


def test_chat_roles_do_not_depend_on_other_columns(spark):
    turns = spark.createDataFrame(CHAT, "conv_id string, turn int, role string, text string")
    names = ["length", "marker", "asks", "opens", "of", "first_chunk", "chunk", "first", "e_conv", "entry", "leave", "p"]

    def run(df):
        model = chat_format.learn(df)
        lines = chat_format.split_lines(df).withColumn("truth", F.col("role"))
        return rows(chat_format.render(chat_format.recover(lines, model)))

    assert run(clashing(turns, names)) == run(turns)


def test_repeated_turns_teach_once_and_join_one_turn_before(spark):
    turns = spark.createDataFrame(CHAT, "conv_id string, turn int, role string, text string")
    many = spark.range(2000).crossJoin(turns).drop("id")
    once, often = chat_format.learn(turns), chat_format.learn(many)
    assert (once.step == often.step).all() and (once.start == often.start).all()
    assert all((once.emit[f] == often.emit[f]).all() for f in once.emit)


def test_mixing_levels_of_any_name(spark):
    docs = [(i, 10 + i % 7, ["en", "de", None][i % 3], f"s{i % 4}", "x") for i in range(200)]
    plain = spark.createDataFrame(docs, "doc_id long, n_tokens long, lang string, source string, copies string")
    odd = plain.withColumnsRenamed({"lang": "budget", "source": "cap"}).withColumns({"supply": F.lit(1), "end_slice": F.lit(2)})
    weights = {("en",): 3, ("de", "s1"): 2}
    want = mix(plain, Mix(("lang", "source"), weights)).select("doc_id", "copies")
    assert rows(mix(odd, Mix(("budget", "cap"), weights)).select("doc_id", "copies")) == rows(want)
    assert want.count() > 0
