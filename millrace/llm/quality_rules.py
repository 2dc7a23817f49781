"""Quality rules: text statistics, a fixed base rule, and a decision list learned from labels.

Everything is DataFrame expressions. ``statistics`` counts in one nested expression, each
intermediate array bound once, so that no rule repeats the work wherever Catalyst moves it.
``learn`` is sequential covering: a rule for bad documents grows by the threshold with the
best FOIL gain, is pruned back on rows it did not grow on, and its rows are taken out before
the next rule grows. Each step is one small grouped count, whose size is the number of
candidate thresholds and not the number of rows. ``decision`` writes the rules as one
ordered conditional expression.

Defined results: NULL and empty text have no words, hence fail the base rule; repeated rows
are judged alike; without labels (or with one class only) the list is empty and every
document that passes the base rule is kept; rows with a NULL label or id teach nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.rows import durable

# Word characters, symbols and window of the contract of these statistics.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "symbol_share",
    "capital_share",
    "exclaim_share",
    "repeat_share",
    "dup_line_share",
    "distinct_share",
    "word_length",
    "n_words",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    """How many characters ``text`` has beside the given ones."""
    return F.length(F.translate(text, characters, ""))


def _repeated_words(words: Column) -> Column:
    """Words in windows of eight that occur at least twice, each word counted once.

    Windows are compared by a 64-bit hash. Most texts repeat none, which a distinct count
    tells; otherwise windows are sorted by hash, and equal neighbours keep their positions.
    """

    def covered(hashes: Column) -> Column:
        keyed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(a: Column) -> Column:
            twin = F.filter(
                a,
                lambda x, k: F.coalesce(F.get(a, k - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(a, k + 1)["h"] == x["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(twin, lambda x: x["i"]))

        def spans(p: Column) -> Column:
            widths = F.transform(
                p, lambda x, k: F.coalesce(F.least(F.lit(WINDOW), F.get(p, k + 1) - x), F.lit(WINDOW))
            )
            return F.aggregate(widths, F.lit(0), lambda a, w: a + w)

        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0)).otherwise(let(let(keyed, positions), spans))

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(hashes, covered))


def statistics(text: Column) -> Column:
    """Struct of counts and of the shares the rules look at; nothing in it is NULL."""

    def shares(s: Column) -> Column:
        chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
        words = F.greatest(s["n_words"], F.lit(1)).cast("double")
        lines = F.greatest(s["n_lines"], F.lit(1)).cast("double")
        counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(
            *[s[c].cast("long").alias(c) for c in counts],
            (s["n_symbols"] / chars).alias("symbol_share"),
            (s["n_capitals"] / chars).alias("capital_share"),
            (s["n_exclaim"] / words).alias("exclaim_share"),
            (s["n_repeat_words"] / words).alias("repeat_share"),
            (s["n_dup_lines"] / lines).alias("dup_line_share"),
            (s["n_distinct"] / words).alias("distinct_share"),
            (s["word_chars"] / words).alias("word_length"),
        )

    def counts(t: Column) -> Column:
        words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
        return let(
            lines,
            lambda ls: let(
                words,
                lambda ws: F.struct(
                    F.size(ws).alias("n_words"),
                    _without(t, WHITE).alias("word_chars"),
                    (F.length(t) - _without(t, SYMBOLS)).alias("n_symbols"),
                    F.size(ls).alias("n_lines"),
                    (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
                    _repeated_words(ws).alias("n_repeat_words"),
                    F.size(F.array_distinct(ws)).alias("n_distinct"),
                    (F.length(t) - _without(t, CAPITALS)).alias("n_capitals"),
                    (F.length(t) - _without(t, "!")).alias("n_exclaim"),
                ),
            ),
        )

    return let(let(F.coalesce(text, F.lit("")), counts), shares)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, get: Callable[[str], Column]) -> Column:
        value = get(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Settings:
    """Bounds and tolerances of learning.

    ``fit_rows`` bounds the labelled rows used (about, by a hash of the id); all other
    numbers bound the list itself. A rule is accepted if, on the rows it was pruned on, at
    least ``min_precision`` of what it covers is bad. A threshold whose gain is ``nearly`` the
    best may stand in for it.
    """

    fit_rows: int = 20_000
    thresholds: int = 24
    max_rules: int = 8
    max_conditions: int = 3
    min_covered: int = 5
    min_precision: float = 0.97
    nearly: float = 0.97


def labelled(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(bad, prune, features...) of a bounded sample of labelled documents."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, settings.fit_rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1_000_000_000))
    known = known.filter(draw < math.ceil(share * 1_000_000_000))
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # Of the texts of a repeated id one counts, so the labels bound the sample.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    picked = picked.groupBy("doc_id").agg(one, F.min("quality").alias("quality"))
    third = F.pmod(F.xxhash64(F.lit("prune"), "doc_id"), F.lit(3)) == 0
    rows = picked.select(
        (F.col("quality") == 0).alias("bad"), third.alias("prune"), statistics(F.col("text")).alias("s")
    )
    return rows.select("bad", "prune", *[F.col("s")[f].cast("double").alias(f) for f in FEATURES])


def _all(rule: Rule) -> Column:
    column = F.lit(True)
    for condition in rule:
        column = column & condition.column(F.col)
    return column


def _covered(rules: list[Rule]) -> Column:
    column = F.lit(False)
    for rule in rules:
        column = column | _all(rule)
    return column


def _cuts(rows: DataFrame, settings: Settings) -> dict[str, list[float]]:
    """Candidate thresholds: quantiles of each feature in both classes, and their midpoints."""
    steps = [i / settings.thresholds for i in range(settings.thresholds + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(f, steps, 1000).alias(f) for f in FEATURES])
    cuts: dict[str, set[float]] = {f: set() for f in FEATURES}
    for row in found.collect():  # two rows
        for f in FEATURES:
            cuts[f].update(row[f] or ())
    ordered = {f: sorted(c) for f, c in cuts.items()}
    return {f: sorted(c + [(a + b) / 2 for a, b in zip(c, c[1:])]) for f, c in ordered.items()}


def _best(rows: DataFrame, cuts: dict[str, list[float]], settings: Settings) -> Condition | None:
    """The condition with the highest FOIL gain over ``rows``."""
    def bin_of(feature: str) -> Column:
        """How many cuts lie below the value."""
        below = F.filter(F.array(*map(F.lit, cuts[feature])), lambda cut: cut < F.col(feature))
        return F.struct(F.lit(feature).alias("feature"), F.size(below).alias("bin"))

    bins = [bin_of(f) for f, c in cuts.items() if c]
    if not bins:
        return None
    split = rows.select("bad", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin")
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    for r in split.agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect():
        counts.setdefault(r.feature, {})[r.bin] = (r.p, r.n)
    gains: list[tuple[float, Condition]] = []
    for feature in sorted(counts):
        total_p = sum(p for p, _ in counts[feature].values())
        total_n = sum(n for _, n in counts[feature].values())
        if not total_p:
            return None
        before = math.log2(total_p / (total_p + total_n))
        below_p = below_n = 0
        for i, cut in enumerate(cuts[feature]):
            p, n = counts[feature].get(i, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, (p, n) in ((False, (below_p, below_n)), (True, (total_p - below_p, total_n - below_n))):
                if p:
                    gains.append((p * (math.log2(p / (p + n)) - before), Condition(feature, above, cut)))
    best = max(gains, key=lambda g: g[0], default=(0.0, None))
    if best[0] <= 1e-9:
        return None
    # Of nearly equal thresholds the one that covers least, to spare unseen good documents.
    like = [
        c
        for gain, c in gains
        if gain >= settings.nearly * best[0] and (c.feature, c.above) == (best[1].feature, best[1].above)
    ]
    return (max if best[1].above else min)(like, key=lambda c: c.threshold)


def learn(rows: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Rules for bad documents, in order. ``rows`` comes from ``labelled``.

    The sample is checkpointed, since every step reads it again.
    """
    rows = rows.transform(durable)
    grow, prune = rows.filter(~F.col("prune")), rows.filter("prune")
    cuts = _cuts(grow, settings)
    rules: list[Rule] = []
    while len(rules) < settings.max_rules:
        left = grow.filter(~_covered(rules))
        rule: Rule = ()
        while len(rule) < settings.max_conditions:
            found = _best(left.filter(_all(rule)), cuts, settings)
            if found is None or found in rule:
                break
            rule += (found,)
        if not rule:
            break
        # Prune: the shortest beginning of the rule with the best worth on unseen rows.
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        seen = prune.filter(~_covered(rules)).agg(
            *[F.count_if(_all(h) & F.col("bad")).alias(f"p{k}") for k, h in enumerate(heads)],
            *[F.count_if(_all(h) & ~F.col("bad")).alias(f"n{k}") for k, h in enumerate(heads)],
        ).first()
        worth = [
            ((seen[f"p{k}"] - seen[f"n{k}"]) / max(1, seen[f"p{k}"] + seen[f"n{k}"]), seen[f"p{k}"], -k)
            for k in range(len(heads))
        ]
        k = -max(worth)[2]
        good, wrong = seen[f"p{k}"], seen[f"n{k}"]
        if good + wrong < settings.min_covered or good < settings.min_precision * (good + wrong):
            break
        rules.append(heads[k])
    return rules


def decision(rules: list[Rule], get: Callable[[str], Column]) -> Column:
    """TRUE unless a rule holds: an ordered conditional expression."""
    if not rules:
        return F.lit(True)
    column = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(get)
        column = (F if column is None else column).when(holds, F.lit(False))
    return column.otherwise(F.lit(True))


def verdict(text: Column, rules: list[Rule]) -> Column:
    """Struct of the contract's counts, base_failed, and kept."""

    def judged(s: Column) -> Column:
        failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
        counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(
            *[s[c].alias(c) for c in counts],
            failed.alias("base_failed"),
            (~failed & decision(rules, lambda f: s[f])).alias("kept"),
        )

    return let(statistics(text), judged)


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, counts, base_failed and kept of every document."""
    rules = learn(labelled(docs, labels, settings), settings)
    return docs.select("doc_id", verdict(F.col("text"), rules).alias("v")).select("doc_id", "v.*")


def good_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The kept documents with all their columns."""
    rules = learn(labelled(docs, labels, settings), settings)
    return docs.filter(verdict(docs["text"], rules)["kept"])
