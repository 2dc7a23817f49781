"""Documents for the tests of the training-data operators."""

import os
import random

SF = "/root/testdata/sf0.001"

# NULL, empty, blank, short, repeated, long and odd texts.
ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r",
    "one",
    "two words",
    "It's I'LL we'VE 12.5% don't",
    "café Éà́ ÀÉÞ ß ½ ² １２ 日本語 한국어 👍🏽 İstanbul ΣΑΣ",
    "x\x1cy\x85z d　e",
    "<|endoftext|> a <|startoftext|>b <|endof",
    "same text here twice",
    "same text here twice",
    "\x00\x01\x7f",
    "a" * 3000,
    "word " * 2000,
    " " * 3000 + "end",
]


def random_texts(n, seed=1):
    pick = random.Random(seed)
    letters = "ab cé'<|\n\t1!？\x1f🙂sAZ.  "
    return ["".join(pick.choice(letters) for _ in range(pick.randrange(80))) for _ in range(n)]


def documents(spark, texts, first=0):
    rows = [(first + i, t, ["en", "de", None][i % 3], f"src{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def given(spark, name, sf=SF):
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))
