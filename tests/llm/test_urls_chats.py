"""URL filters against a row-by-row evaluation, chats against exhaustive decoding."""

import datetime
import itertools
import random

import numpy as np
from llm_helpers import given
from pyspark.sql import functions as F

from millrace.llm import chat_format as chat
from millrace.llm import url_filters as urls
from millrace.llm.queries import transcripts

DAY = datetime.date(2024, 1, 1)


def test_hosts_and_keys(spark):
    rows = [
        ("https://me:pw@Blog.Example.com:8080/a/b/c.html?x=/y/#z",),
        ("http://example.com.",),
        ("no scheme/at/all",),
        (None,),
        ("http:///only/a/path",),
    ]
    df = spark.createDataFrame(rows, "url string").select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
    out = df.collect()
    assert [r.host for r in out] == ["blog.example.com", "example.com", None, None, None]
    keys = [
        "domain:blog.example.com", "domain:com", "domain:example.com", "host:blog.example.com",
        "path:blog.example.com/", "path:blog.example.com/a/", "path:blog.example.com/a/b/",
    ]
    want = spark.createDataFrame([(k,) for k in keys], "key string").select(urls.digest_of(F.col("key"))).collect()
    assert sorted(urls.digests_of(out[0].host, out[0].path)) == sorted(bytes(r[0]) for r in want)
    odd = ["domain:", "domain:.", "domain:.b", "domain:a..b.", "domain:.b.", "domain:b.", "path:a..b.//", "path:a..b./"]
    got = set(urls.digests_of("a..b.", "//x"))
    found = {r[0]: bytes(r[1]) in got for r in spark.createDataFrame([(k,) for k in odd], "key string").select("key", urls.digest_of(F.col("key"))).collect()}
    assert found == {"domain:": True, "domain:.": False, "domain:.b": False, "domain:a..b.": True, "domain:.b.": True, "domain:b.": True, "path:a..b.//": True, "path:a..b./": True}


def evaluated(captures, entries):
    out = []
    for page, url, day in captures:
        host = path = None
        if url and "://" in url:
            host, _, path = url.split("://")[1].partition("/")
            path = "/" + path if _ else ""
        hits = []
        for key in {e[0] for e in entries if None not in e}:
            kind, _, value = key.partition(":")
            match = host and (
                (kind == "host" and host == value)
                or (kind == "domain" and (host == value or host.endswith("." + value)))
                or (kind == "path" and (host + path).startswith(value))
            )
            past = sorted((d, a) for k, a, d in entries if k == key and a and d and day and d <= day)
            if match and past:
                last = [a for d, a in past if d == past[-1][0]]
                hits.append((key, min(last)))
        rules = sorted((k for k, a in hits if a == "block"), key=lambda k: (-len(k), k))
        out.append((page, len(hits), bool(rules), rules[0] if rules else None))
    return sorted(out, key=str)


def test_against_row_by_row(spark):
    pick = random.Random(5)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "ba.com"]
    days = [DAY + datetime.timedelta(d) for d in range(12)]
    captures = [(i, f"http://{pick.choice(hosts)}/{pick.choice(['', 'p/', 'p/q/r', 'pp/q'])}", pick.choice(days)) for i in range(120)]
    captures += [(1, captures[1][1], captures[1][2])] * 2 + [(500, None, DAY), (501, "http://a.com/", None), (None, "http://a.com/", DAY)]
    keys = ["host:a.com", "domain:a.com", "domain:com", "path:a.com/p/", "path:x.a.com/", "host:b.org"]
    entries = [(pick.choice(keys), pick.choice(["block", "release"]), pick.choice(days)) for _ in range(40)]
    entries += [(None, "block", DAY), ("host:a.com", None, DAY), ("host:a.com", "block", None)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_on date").withColumn("rule", F.lit("clash"))
    e = spark.createDataFrame(entries, "key string, action string, day date")
    got = urls.evaluate(c, e).select("page_id", "n_entries", "blocked", "rule").collect()
    assert sorted(map(tuple, got), key=str) == evaluated(captures, entries)
    assert not urls.evaluate(c, e.filter("false")).filter("blocked OR n_entries > 0").count()
    assert urls.evaluate(c.filter("false"), e).count() == 0


def test_deep_entries_and_paths(spark):
    """Entries of any number of folders are looked up."""
    rows = [(1, "http://a.com/" + "x/" * 30 + "page", DAY), (2, "http://a.com/" + "x/" * 24 + "y", DAY)]
    c = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    entries = [("path:a.com/" + "x/" * n, "block", DAY) for n in (0, 24, 25, 30, 31)]
    e = spark.createDataFrame(entries, "key string, action string, day date")
    got = {r.page_id: (r.n_entries, r.rule) for r in urls.evaluate(c, e).collect()}
    assert got == {1: (4, "path:a.com/" + "x/" * 30), 2: (2, "path:a.com/" + "x/" * 24)}


def test_a_very_long_url_costs_its_length(spark):
    labels, folders = "l." * 60_000 + "com", "f/" * 60_000
    rows = [(1, f"http://{labels}/{folders}", DAY), (2, f"http://{labels}/", DAY), (None, f"http://{labels}/", DAY)]
    c = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    entries = [(f"domain:{labels[2:]}", "block", DAY), (f"path:{labels}/{folders}", "block", DAY), ("domain:com", "release", DAY)]
    e = spark.createDataFrame(entries, "key string, action string, day date")
    got = {r.page_id: (r.n_entries, r.rule) for r in urls.evaluate(c, e).collect()}
    assert got == {1: (3, entries[1][0]), 2: (2, entries[0][0]), None: (2, entries[0][0])}
    assert len(urls.digests_of(labels, "/" + folders)) == 1 + 60_001 + 60_001


def test_hosts_of_many_labels(spark):
    deep = "www." * 40 + "a.com"
    c = spark.createDataFrame([(1, f"http://{deep}/", DAY), (2, "http://a.com/", DAY)], "page_id long, url string, fetched_on date")
    e = spark.createDataFrame([(f"domain:{deep[4:]}", "block", DAY), ("domain:a.com", "block", DAY)], "key string, action string, day date")
    got = {r.page_id: (r.n_entries, r.rule) for r in urls.evaluate(c, e).collect()}
    assert got == {1: (2, f"domain:{deep[4:]}"), 2: (1, "domain:a.com")}


def model(seed):
    rng = np.random.default_rng(seed)

    def logs(*shape):
        x = rng.random(shape)
        return np.log(x / x.sum(-1, keepdims=True))

    return chat.Model(logs(chat.STATES), logs(chat.STATES, chat.STATES), {f: logs(chat.STATES, n) for f, n in chat._FEATURES.items()})


def test_decoding_and_chaining_are_exact():
    m, rng = model(1), np.random.default_rng(2)
    scores = chat._scores(m, {f: rng.integers(0, n, 5) for f, n in chat._FEATURES.items()})

    def worth(path):
        return m.start[path[0]] + scores[0][path[0]] + sum(m.step[a, b] + scores[i + 1][b] for i, (a, b) in enumerate(zip(path, path[1:])))

    best = max(itertools.product(range(chat.STATES), repeat=5), key=worth)
    assert tuple(chat.decode(m, scores, None, None)) == best
    # The same by way of two chunks: the matrix of the second, from the states of the first.
    first = chat.decode(m, scores[:3], None, best[2])
    second = chat.decode(m, scores[3:], int(first[-1]), best[4])
    assert tuple(first) + tuple(second) == best
    t = chat.transfer(m, scores[3:])
    assert np.isclose(t[best[2], best[4]], worth(best) - worth(best[:3]))


def recovered(spark, lines, m):
    df = spark.createDataFrame(lines, "conv_id long, turn long, line int, text string, truth string")
    return chat.render(chat.recover(df, m)).collect()


def test_chunks_change_nothing(spark, monkeypatch):
    m = chat.learn(transcripts(given(spark, "conversations", "/root/testdata/sf0.01")))
    lines = [(1, t, k, f"{['User: ', 'Assistant: '][t % 2] if k == 0 and t % 5 else ''}line {t} {k}", None) for t in range(60) for k in range(1 + t % 3)]
    lines += [(None, 0, 0, "User: a null conversation", None), (7, None, 0, None, None)]

    def roles(rows):
        return [(r.conv_id, r.role, r.text) for r in sorted(rows, key=lambda r: (str(r.conv_id), r.chunk, r.n))]

    whole = roles(recovered(spark, lines, m))
    monkeypatch.setattr(chat, "CHUNK_TURNS", 4)
    cut = recovered(spark, lines, m)
    assert len({r.chunk for r in cut}) == 15
    glued = []
    for r, (conv, role, text) in zip(sorted(cut, key=lambda r: (str(r.conv_id), r.chunk, r.n)), roles(cut)):
        if r.continues:
            glued[-1] = (conv, role, glued[-1][2] + "\n" + text)
        else:
            glued.append((conv, role, text))
    assert glued == whole


def test_roles_of_given_conversations(spark):
    raw = transcripts(given(spark, "conversations", "/root/testdata/sf0.01"))
    m = chat.learn(raw)
    out = chat.recover(chat.split_lines(raw.withColumnRenamed("role", "truth")), m)
    r = out.agg(F.sum("n_lines").alias("n"), F.sum("n_right").alias("right")).first()
    assert r.right >= 0.93 * r.n
    rows = chat.render(out.filter("conv_id = 0")).orderBy("chunk", "n").collect()
    assert all(x.rendered == f"<|{x.role}|>\n{x.text}\n<|end|>\n" for x in rows)
    assert chat.recover(chat.split_lines(raw.withColumnRenamed("role", "truth").filter("false")), m).count() == 0


def test_markers(spark):
    texts = ["User: hi", "### Response: yes", "<|system|> be brief", "**AI**: ok", "[Human] so?", "Users: none", "a plain line: no", "Q: why"]
    df = spark.createDataFrame([(1, i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn int, line int, text string")
    df = chat.with_features(df).select("marker", chat.stripped(F.col("text"), F.col("marker")).alias("t"), "turn").orderBy("turn")
    assert [(r.marker, r.t) for r in df.collect()] == [
        (2, "hi"), (3, "yes"), (1, "be brief"), (3, "ok"), (2, "so?"), (0, "Users: none"), (0, "a plain line: no"), (2, "why"),
    ]
