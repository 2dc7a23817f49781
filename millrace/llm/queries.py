"""One query per operator on the given tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from millrace.llm import (
    byte_bpe,
    chat_format,
    hard_negatives,
    language_id,
    minhash,
    mixing,
    multi_index,
    oracles,
    quality_rules,
    sharding,
    token_counts,
    turn_repair,
    url_filters,
    warc,
)
from millrace.storage import new_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# How the transcripts derived from the conversations write their speakers, by style.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "Instructions: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
    {"system": "### Context:", "user": "### Question:", "assistant": "### Response:"},
)


def transcripts(turns: DataFrame) -> DataFrame:
    """Turns as raw transcripts have them: a marker in the style of the conversation at the
    head of five turns in six, none at the sixth."""
    head = F.lit("")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    for i, names in enumerate(STYLES):
        for role, marker in names.items():
            head = F.when((style == i) & (F.col("role") == role), F.lit(marker)).otherwise(head)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(head), F.coalesce("text", F.lit("")))
    return turns.select("conv_id", "turn", "role", text.alias("text"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = transcripts(table(spark, sf_dir, "conversations"))
    model = chat_format.learn(raw)
    lines = chat_format.split_lines(raw.withColumnRenamed("role", "truth"))
    return chat_format.render(chat_format.recover(lines, model)).drop("text")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, WORDS)


# Domains of the given sources, and what each node of the tree weighs.
DOMAINS = {
    "web": [f"src{i}" for i in range(0, 8)],
    "books": [f"src{i}" for i in range(8, 14)],
}
OTHER_DOMAIN = "code"
MIX = mixing.Mix(
    levels=("domain", "lang", "source"),
    weights={("web",): 50, ("books",): 30, ("code",): 20}
    | {(d, lang): w for d in ("web", "books", "code") for lang, w in (("en", 5), ("de", 2), ("fr", 2))},
    budget_percent=60,
    max_epochs=2,
    seed=11,
)
WORD_COUNT = r"regexp_count(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')"


def with_domain(docs: DataFrame) -> DataFrame:
    domain = F.lit(OTHER_DOMAIN)
    for name, sources in DOMAINS.items():
        domain = F.when(F.col("source").isin(sources), F.lit(name)).otherwise(domain)
    return docs.withColumn("domain", domain)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents")).withColumn("n_tokens", F.expr(WORD_COUNT).cast("long"))
    return mixing.mix(docs.select("doc_id", *MIX.levels, "n_tokens"), MIX)


def captures(pages: DataFrame) -> DataFrame:
    """Pages with the day of the year they count as fetched on."""
    return pages.select("page_id", "url", F.expr("date_add(DATE'2024-01-01', CAST(page_id * 37 % 365 AS INT))").alias("fetched_on"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and folders of all pages.

    The kind of entry, its day and whether it lists or releases follow from id and URL.
    """
    host = url_filters.host_of(F.col("url"))
    parent = F.regexp_replace(host, r"^[^.]*\.", "")
    folder = F.regexp_extract(url_filters.path_of(F.col("url")), "^(/[^/]*/)", 1)
    kind = F.col("page_id") % 3
    key = (
        F.when(kind == 0, F.concat(F.lit("host:"), host))
        .when(kind == 1, F.concat(F.lit("domain:"), parent))
        .when(folder != "", F.concat(F.lit("path:"), host, folder))
    )
    action = F.when(F.length("url") % 3 == 0, F.lit(url_filters.BLOCK)).otherwise(F.lit(url_filters.RELEASE))
    day = F.expr("date_add(DATE'2024-01-01', CAST(page_id * 53 % 365 AS INT))")
    return pages.select(key.alias("key"), action.alias("action"), day.alias("day"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.evaluate(captures(pages), list_entries(pages))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(shingle=3, percent=85))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.filter(~language_id.held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "id")
    found = language_id.identify(docs, language_id.learn(train))
    return docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), found.alias("f")).select(
        "doc_id", "held_out", "f.lang_pred", "f.score", "f.rejected"
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), n_shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.share_payloads(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html")
    name = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    records = pages.select(
        F.coalesce(name("page_id"), F.lit("urn:page:none")).alias("record_id"),
        "record_type",
        F.col("url").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        name("response_id").alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(F.col("record_type") == warc.RESPONSE, F.col("html").cast("binary")).alias("payload"),
    )
    path = new_dir(spark, "warc")
    warc.write_records(records, path)
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS BIGINT)")
    found = warc.read_records(spark, path, "verify").filter(F.col("record_type").isin(warc.RESPONSE, warc.REVISIT))
    sound = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("error")))
    return found.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        sound.alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults that follow from conv_id and turn; ``copies`` says how often each is there."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *spelled).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(damaged(table(spark, sf_dir, "conversations")), "copies")


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_mixing": op3_mixing,
    "op4_url_filters": op4_url_filters,
    "op5_minhash": op5_minhash,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_multi_index": op10_multi_index,
    "op11_warc": op11_warc,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_turn_repair": op13_turn_repair,
}

ORACLES: dict[str, str] = {
    "op3_mixing": oracles.mixing(MIX, DOMAINS, OTHER_DOMAIN),
    "op4_url_filters": oracles.URL_FILTERS,
    "op10_multi_index": oracles.MULTI_INDEX,
    "op11_warc": oracles.WARC,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
}
