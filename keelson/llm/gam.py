"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is binned; a table holds what each bin adds to the log odds.  The tables are learned by
cyclic boosting: round after round every feature in turn gets a shallow tree fitted to what is still unexplained.
Pairs of features whose joint residuals promise most get tables of their own, learned the same way by trees over
two features.  A score is the sum of one entry per table, put through the logistic function.

The model is fitted on the driver on at most ``Settings.fit_rows`` labelled rows (chosen by a digest of their id);
features see the text alone.  Null text counts as empty and has a score like any other; rows without id or label
teach nothing; without labels of both kinds every score is the share of ones, or a half without labels; repeated
rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.rows import free_name, mix64, names_of, ramps, sliced, split_words, texts_of

#: Byte classes that features count.
_CLASSES = {"symbols": b"#*$%&<>|", "pipes": b"|", "digits": b"0123456789", "upper": bytes(range(65, 91)), "shouts": b"!?", "stops": b".,;:", "lines": b"\n"}
FEATURES = (
    "log_words", "word_length", "long_words", "short_words", "ended_words", "distinct_share", "top_share", "echoed_words",
    "repeated_triples", "repeated_lines", "line_words", "beyond_ascii", *(f"{c}_share" for c in _CLASSES),
)


@dataclass(frozen=True)
class Settings:
    fit_rows: int = 50_000  #: most labelled rows that the model is fitted on
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 120
    pair_rounds: int = 40
    rate: float = 0.15
    leaves: int = 3
    smoothing: float = 4.0  #: added to a leaf's weight, so that few rows say little


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each owner: distinct keys, most rows of one key, rows of keys that it has more than once."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([starts, [len(k)]]))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, o[starts], sizes)
    return np.bincount(o[starts], minlength=n), most, np.bincount(o[starts], weights=np.where(sizes > 1, sizes, 0), minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row per text, one column per name in FEATURES; an empty text has zeros."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    words, counts = split_words(texts)
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(n), counts)
    size = pc.utf8_length(coded.dictionary).to_numpy()[code] if len(code) else np.zeros(0)
    ended = pc.match_substring_regex(coded.dictionary, r"[.,;:!?]$").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0)
    share = lambda x, of=counts: x / np.maximum(of, 1)
    distinct, most, _ = _repeats(code, owner, n)
    echoed = np.zeros(len(code))
    echoed[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    n3 = np.maximum(counts - 2, 0)
    at = np.repeat(np.cumsum(counts) - counts, n3) + ramps(n3)
    triple = mix64(mix64(mix64(code[at].astype(np.uint64)) + code[at + 1].astype(np.uint64)) + code[at + 2].astype(np.uint64)) if len(at) else np.zeros(0, np.uint64)
    _, _, triples = _repeats(triple, np.repeat(np.arange(n), n3), n)
    pieces = pc.split_pattern(texts, "\n")
    n_lines = pc.list_value_length(pieces).to_numpy()
    lines = pc.list_flatten(pieces)
    real = pc.greater(pc.binary_length(pc.utf8_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
    line_owner = np.repeat(np.arange(n), n_lines)[real]
    line_code = lines.filter(pa.array(real)).dictionary_encode().indices.to_numpy() if real.any() else np.zeros(0, np.int32)
    distinct_lines, _, _ = _repeats(line_code, line_owner, n)
    real_lines = np.bincount(line_owner, minlength=n)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    n_bytes = np.diff(offsets)
    columns = [
        np.log1p(counts), share(_per_text(size, counts)), share(_per_text(size > 12, counts)), share(_per_text(size <= 3, counts)),
        share(_per_text(ended, counts)), share(distinct), share(most), share(_per_text(echoed, counts)), share(triples, n3),
        share(real_lines - distinct_lines, real_lines), share(counts, real_lines), share(_per_text(data >= 0xC0, n_bytes), n_bytes),
    ]
    for members in _CLASSES.values():
        table = np.zeros(256, np.uint8)
        table[list(members)] = 1
        columns.append(share(_per_text(table[data], n_bytes), n_bytes))
    return np.column_stack(columns).astype(np.float64)


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[f], x[:, f], side="right"), np.searchsorted(self.pair_edges[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between at most ``bins`` bins of about equal weight."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _tree(slope: np.ndarray, curve: np.ndarray, leaves: int, smoothing: float) -> np.ndarray:
    """A tree over ordered bins: the best cuts one after the other, then each leaf's step."""
    spans = [(0, len(slope))]
    s, c = np.concatenate([[0], np.cumsum(slope)]), np.concatenate([[0], np.cumsum(curve)])
    worth = lambda a, b: (s[b] - s[a]) ** 2 / (c[b] - c[a] + smoothing)
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for a, b in spans:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gain = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), (a, b), int(cuts[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        a, b = best[1]
        spans = sorted([p for p in spans if p != (a, b)] + [(a, best[2]), (best[2], b)])
    step = np.zeros(len(slope))
    for a, b in spans:
        step[a:b] = (s[b] - s[a]) / (c[b] - c[a] + smoothing)
    return step


def _pair_tree(slope: np.ndarray, curve: np.ndarray, smoothing: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts one feature and then, on either side, the other: what it gains and its steps."""
    best = (0.0, np.zeros(slope.shape))
    for turned in (False, True):
        s, c = (slope.T, curve.T) if turned else (slope, curve)
        for cut in range(1, s.shape[0]):
            step, gain = np.zeros(s.shape), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                a, b = s[rows].sum(axis=0), c[rows].sum(axis=0)
                one = _tree(a, b, 2, smoothing)
                step[rows] = one
                gain += float((one * a).sum())
            if gain > best[0]:
                best = (gain, step.T if turned else step)
    return best


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Model:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(float(np.log(share / (1 - share))))
    model = Model(float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, f], settings.bins) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)
    chance = 1 / (1 + np.exp(-total))
    for _ in range(settings.rounds):
        for f, bin_of in enumerate(binned):
            n = len(model.tables[f])
            step = settings.rate * _tree(np.bincount(bin_of, y - chance, n), np.bincount(bin_of, chance * (1 - chance), n), settings.leaves, settings.smoothing)
            model.tables[f] += step
            total += step[bin_of]
            chance = 1 / (1 + np.exp(-total))
    model.pair_edges = [_edges(x[:, f], settings.pair_bins) for f in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]

    def residuals(f: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.pair_edges[f]) + 1, len(model.pair_edges[g]) + 1)
        cell = coarse[f] * shape[1] + coarse[g]
        return cell, np.bincount(cell, y - chance, shape[0] * shape[1]).reshape(shape), np.bincount(cell, chance * (1 - chance), shape[0] * shape[1]).reshape(shape)

    gains = {(f, g): _pair_tree(*residuals(f, g)[1:], settings.smoothing)[0] for f, g in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[: settings.pairs]
    model.pair_tables = [np.zeros((len(model.pair_edges[f]) + 1, len(model.pair_edges[g]) + 1)) for f, g in model.pairs]
    for _ in range(settings.pair_rounds):
        for i, (f, g) in enumerate(model.pairs):
            cell, slope, curve = residuals(f, g)
            step = settings.rate * _pair_tree(slope, curve, settings.smoothing)[1]
            model.pair_tables[i] += step
            total += step.reshape(-1)[cell]
            chance = 1 / (1 + np.exp(-total))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit the model on a bounded sample of the labelled rows that are not held out."""
    usable = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = usable.count()
    draw = F.xxhash64(F.col("doc_id"), F.lit(7)).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    sample = usable.where(draw < min(1.0, settings.fit_rows / max(1, n))).limit(settings.fit_rows)
    rows = texts_of(docs).select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # fit_rows ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(list(features(batch.column("text"))))], names=["doc_id", "quality", "x"])

    table = rows.mapInArrow(run, "doc_id long, quality int, x array<double>").toArrow().sort_by("doc_id")  # fit_rows rows at most
    if not table.num_rows:
        return Model()
    x = table["x"].combine_chunks().values.to_numpy().reshape(table.num_rows, len(FEATURES))
    return fit(x, table["quality"].to_numpy().astype(np.float64), settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, score."""
    schema = "row_key binary, doc_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(model.scores(features(batch.column("text"))))], names=names_of(schema))

    return texts_of(docs).mapInArrow(run, schema)


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with their scores in a column ``name`` (underscores before it if there is one already)."""
    scored, text = free_name(name, docs), docs["text"].cast("string")

    @F.pandas_udf("double")
    def of(texts):
        column = pa.array(texts, pa.string(), from_pandas=True)
        return _series(np.concatenate([model.scores(features(s.column("t"))) for s in sliced(iter([pa.RecordBatch.from_arrays([column], ["t"])]), "t")] or [np.zeros(0)]))

    return docs.withColumn(scored, of(text))


def _series(values: np.ndarray):
    import pandas as pd

    return pd.Series(values)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``threshold`` up) of every row."""
    scored = score(docs, learn(docs, labels, settings))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
