"""Quality rules: a learned decision list over text statistics, in DataFrame functions only.

Every text is described by counts and shares, computed by built-in functions.  Sequential covering learns the list
from labelled rows: a rule for low quality grows one threshold at a time by information gain on two thirds of the
rows, is pruned from its end on the last third, and is taken if it is precise enough there; the rows it covers leave,
and the next rule is grown.  The list becomes one ordered conditional expression of Spark.

Learning sees the labelled rows as counts of binned statistics: at most ``Settings.fit_rows`` rows, chosen by a digest
of the id, so at most that many counts reach the driver.  Thresholds lie between values of these rows.

Null text counts as a text without words and fails the base rules; rows without id or label teach nothing; without
labels of low quality the list is empty and keeps everything; repeated rows are judged alike; an empty table gives an
empty result.  Texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.storage import cut
from keelson.llm.rows import SPACES

_BETWEEN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Statistics that rules may test.
STATISTICS = ("n_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "words_per_line")


@dataclass(frozen=True)
class Settings:
    fit_rows: int = 50_000  #: most labelled rows that rules are learned from
    thresholds: int = 32  #: most thresholds a statistic
    conditions: int = 4  #: most conditions a rule
    precision: float = 0.8  #: least share of low quality among the pruning rows that a rule covers
    least_rows: int = 5  #: least growing rows of low quality that a rule covers


@dataclass(frozen=True)
class Rule:
    """Low quality where all conditions (statistic, at_least, threshold) hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return _all([F.col(s) >= t if at_least else F.col(s) < t for s, at_least, t in self.conditions])


def _all(conditions: list[Column]) -> Column:
    whole = F.lit(True)
    for c in conditions:
        whole = whole & c
    return whole


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BETWEEN))


def repeat_words(words: Column) -> Column:
    """Words in a window of three that the text has twice or more.

    Hashes of the windows are sorted with their places, equal neighbours tell the places of repeated windows, and
    each such place covers three words, or fewer if the next one begins before.
    """

    def positions(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, _has_twin(s)), lambda x: x["i"])))

    def _has_twin(s: Column) -> Callable[[Column, Column], Column]:
        return lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.when(j < F.size(places) - 1, F.least(F.lit(3), F.get(places, j + 1) - p)).otherwise(3))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def counted(hashes: Column) -> Column:
        alone = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(alone, F.lit(0).cast("long")).otherwise(let(positions(hashes), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(windows, counted))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the columns of STATISTICS for every row of ``docs``."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    long_of = lambda c: c.cast("long")
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(long_of(F.size(w)).alias("n"), long_of(F.size(F.array_distinct(w))).alias("distinct"), repeat_words(w).alias("repeated"))

    rows = rows.select(
        "doc_id",
        let(words_of(F.col("text")), of_words).alias("words"),
        long_of(F.char_length(F.translate("text", SPACES, ""))).alias("word_chars"),
        long_of(F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        long_of(F.char_length("text") - F.char_length(F.translate("text", _UPPER, ""))).alias("n_upper"),
        let(lines, lambda x: F.struct(long_of(F.size(x)).alias("n"), long_of(F.size(F.array_distinct(x))).alias("distinct"))).alias("lines"),
    )
    rows = rows.select(
        "doc_id", "word_chars", "n_symbols", "n_upper",
        F.col("words.n").alias("n_words"), F.col("words.distinct").alias("n_distinct"), F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"), (F.col("lines.n") - F.col("lines.distinct")).alias("n_dup_lines"),
    )
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share("word_chars", "n_words").alias("word_length"), share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"), share("n_upper", "word_chars").alias("upper_share"),
        share("n_words", "n_lines").alias("words_per_line"),
    )


def labelled_counts(stats: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[list[float]], list]:
    """The thresholds of each statistic, and counts of labelled rows by bins, third and label."""
    usable = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = usable.count()
    draw = F.xxhash64(F.col("doc_id"), F.lit(3)).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    chosen = usable.where(draw < min(1.0, settings.fit_rows / max(1, n))).limit(settings.fit_rows)
    rows = cut(stats.where("not base_failed").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", *(F.col(s).cast("double") for s in STATISTICS)))
    parts = [i / settings.thresholds for i in range(1, settings.thresholds)]
    quantiles = rows.agg(*(F.percentile_approx(s, parts, 10_000).alias(s) for s in STATISTICS), *(F.max(s).alias(f"max_{s}") for s in STATISTICS)).first()
    edges = [sorted({*(quantiles[s] or []), *([quantiles[f"max_{s}"]] if quantiles[f"max_{s}"] is not None else [])}) for s in STATISTICS]
    low = [F.percentile_approx(F.when(F.col("quality") == 0, F.col(s)), parts, 10_000).alias(s) for s in STATISTICS]
    below = rows.agg(*low).first()
    edges = [sorted({*e, *(below[s] or [])}) for e, s in zip(edges, STATISTICS)]
    bins = [_bin(e, F.col(s)).alias(f"b_{s}") for e, s in zip(edges, STATISTICS)]
    third = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(4)), F.lit(3)) == 0).alias("pruning")
    counts = rows.select(*bins, third, "quality").groupBy(*(f"b_{s}" for s in STATISTICS), "pruning", "quality").count()
    return edges, counts.collect()  # fit_rows rows at most


def _bin(edges: list[float], value: Column) -> Column:
    """How many of the edges are the value or less."""
    return F.size(F.filter(F.array(*map(F.lit, edges)).cast("array<double>"), lambda t: t <= value))


def learn(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """The decision list of low quality, best rules first."""
    edges, counts = labelled_counts(stats, labels, settings)
    if not counts:
        return []
    table = np.array([[*(r[f"b_{s}"] for s in STATISTICS), r["pruning"], r["quality"], r["count"]] for r in counts], np.int64)
    bins, pruning, low, weight = table[:, : len(STATISTICS)], table[:, -3] == 1, table[:, -2] == 0, table[:, -1]
    if not pruning.any() or pruning.all():
        pruning = np.ones(len(table), bool)
    left, rules = np.ones(len(table), bool), []
    growing = ~pruning if not pruning.all() else pruning
    tests = [(f, up, b) for f, e in enumerate(edges) for b in range(1, len(e) + 1) for up in (True, False)]
    holds = [bins[:, f] >= b if up else bins[:, f] < b for f, up, b in tests]

    def count(rows: np.ndarray) -> tuple[int, int]:
        return int(weight[rows & low].sum()), int(weight[rows & ~low].sum())

    while True:
        picked: list[int] = []
        covered = left & growing
        p, n = count(covered)
        while n and len(picked) < settings.conditions:
            best = (0.0, -1)
            for i, h in enumerate(holds):
                p1, n1 = count(covered & h)
                if p1 >= settings.least_rows and n1 < n:
                    gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p / (p + n)))
                    best = max(best, (gain, i), key=lambda x: x[0])
            if best[1] < 0:
                break
            picked.append(best[1])
            covered = covered & holds[best[1]]
            p, n = count(covered)
        if not picked or p < settings.least_rows:
            return rules
        worth = []
        for size in range(1, len(picked) + 1):
            rows = left & pruning & np.logical_and.reduce([holds[i] for i in picked[:size]])
            p1, n1 = count(rows)
            worth.append(((p1 + 1) / (p1 + n1 + 2), p1, n1))
        size = max(range(len(worth)), key=lambda i: (worth[i][0], -i))
        _, p1, n1 = worth[size]
        whole = np.logical_and.reduce([holds[i] for i in picked[: size + 1]])
        p, n = count(left & growing & whole)
        if p + p1 < settings.precision * (p + p1 + n + n1) or (p1 + n1 and p1 < settings.precision * (p1 + n1)):
            return rules
        rules.append(Rule(tuple((STATISTICS[f], up, float(edges[f][b - 1])) for f, up, b in (tests[i] for i in picked[: size + 1]))))
        left = left & ~whole


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether the list keeps a row of statistics, and the number of the rule that decided (0: none did)."""
    kept, number = F.lit(True), F.lit(0)
    for i in range(len(rules), 0, -1):  # the first rule that holds decides
        kept = F.when(rules[i - 1].column(), F.lit(False)).otherwise(kept)
        number = F.when(rules[i - 1].column(), F.lit(i)).otherwise(number)
    return kept, number


def apply_rules(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Statistics of every row, base_failed, kept and rule (0: the base rules or none)."""
    stats = cut(statistics(docs))
    kept, number = verdict(learn(stats, labels, settings))
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & kept).alias("kept"), F.when(F.col("base_failed"), 0).otherwise(number).alias("rule"),
        *(s for s in STATISTICS if s != "n_words"),
    )
