"""BPE encoding by a segment tree over adjacent pair ranks, and decoding.

A part of a word is a row of symbols.  The leaf at each symbol holds the merge rank of the pair that begins there;
inner nodes hold the minimum of their children.  The root tells the lowest rank left, walking down (left child
first) finds its leftmost place, the merge changes three leaves, and each change climbs to the root: a logarithmic
number of steps a merge, until the root holds no rank.  Many parts are merged side by side: one numpy row each, in
groups of equal tree size, so a part of any length takes memory in proportion to its length.

Null and empty texts have no ids and decode to an empty text; texts of any length are encoded whole; rows are
independent, so ties and repeated rows need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm import tokens
from keelson.llm.rows import ramps, sliced

_NONE = np.int32(2**31 - 1)
#: Tree nodes held at once.
_NODES = 1 << 21


class PairTrees:
    """The merge table of a tokenizer file and the merging of many parts at once."""

    def __init__(self, path: str) -> None:
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = tokens.byte_letters()
        self.code = {x: b for b, x in enumerate(letters)}
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + suffix] for x in letters], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_at = keys[order], order.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank_at[at], _NONE)

    def __call__(self, parts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts (given in byte letters) in order, and how many each has."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        table = np.zeros(max((ord(x) for x in self.code), default=0) + 1, np.int64)
        for x, b in self.code.items():
            table[ord(x)] = b
        codes = table[flat]
        starts = np.cumsum(lengths) - lengths
        leaves = np.maximum(1, 2 ** np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for width in np.unique(leaves):
            rows = np.flatnonzero((leaves == width) & (lengths > 0))
            step = max(1, _NODES // (2 * int(width)))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                found.append((some, *self._merge(codes, starts[some], lengths[some], int(width))))
        sizes = np.zeros(len(parts), np.int64)
        for some, n, _ in found:
            sizes[some] = n
        ids = np.zeros(int(sizes.sum()), np.uint32)
        begin = np.cumsum(sizes) - sizes
        for some, n, got in found:
            ids[np.repeat(begin[some], n) + ramps(n)] = got
        return ids, sizes

    def _merge(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(starts)
        place = np.arange(width)
        there = place < lengths[:, None]
        code = codes[np.minimum(starts[:, None] + place, len(codes) - 1)]
        symbol = np.where(there, self.inner[code], -1)
        rows = np.arange(n)
        symbol[rows, lengths - 1] = self.last[code[rows, lengths - 1]]
        after = np.where(place + 1 < lengths[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), _NONE, np.int32)
        if width > 1:
            tree[:, width : 2 * width - 1] = self.ranks(symbol[:, :-1], symbol[:, 1:])
            level = width
            while level > 1:
                half = level // 2
                tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
                level = half
        live = np.flatnonzero(tree[:, 1] != _NONE)
        while len(live):
            best = tree[live, 1]
            node = np.ones(len(live), np.int64)
            while node[0] < width:
                node *= 2
                node += tree[live, node] != best
            at = node - width
            right = after[live, at]
            beyond = after[live, right]
            symbol[live, at] = self.made[best]
            symbol[live, right] = -1
            after[live, at] = beyond
            has = beyond >= 0
            before[live[has], beyond[has]] = at[has]
            prior = before[live, at]
            merged = symbol[live, at]
            self._set(tree, live, right + width, np.full(len(live), _NONE))
            self._set(tree, live, at + width, np.where(has, self.ranks(merged, symbol[live, np.maximum(beyond, 0)]), _NONE))
            led = prior >= 0
            self._set(tree, live[led], prior[led] + width, self.ranks(symbol[live[led], prior[led]], merged[led]))
            live = live[tree[live, 1] != _NONE]
        kept = symbol >= 0
        return kept.sum(axis=1), symbol[kept].astype(np.uint32)

    @staticmethod
    def _set(tree: np.ndarray, rows: np.ndarray, node: np.ndarray, value: np.ndarray) -> None:
        """Point update: write the leaves, then each ancestor up to the root."""
        tree[rows, node] = value
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


def tree_parts(path: str) -> PairTrees:
    return PairTrees(path)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, kind: str = "tree") -> DataFrame:
    """``docs`` with n_tokens and ids (little-endian unsigned 32-bit integers) in place of the text column."""
    path = path or tokens.default_path()
    kept = docs.drop(text_col, "n_tokens", "ids")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path, kind)
        for batch in sliced(batches, text_col):
            ids, counts = encoder(batch.column(text_col))
            rest = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(counts), binaries(ids, counts)], names=[*names, "n_tokens", "ids"])

    return docs.select(*names, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with decoded, the text the library's ``decode(ids, skip_special_tokens=False)`` gives: a file without decoder joins the tokens by blanks."""
    path = path or tokens.default_path()
    kept = encoded.drop("decoded")
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = token_texts(path)
        for batch in sliced(batches, ids_col):
            ids, counts = integers(batch.column(ids_col))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, words.take(pa.array(ids)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pc.binary_join(lists, " ")], names=[*names, "decoded"])

    return kept.mapInArrow(run, schema)


def token_texts(path: str) -> pa.Array:
    """The string of each id; ids without a string are empty."""
    whole = json.load(open(path, encoding="utf-8"))
    if whole["decoder"] is not None:
        raise ValueError("this file names a decoder; only files without one are decoded here")
    named = {i: t for t, i in whole["model"]["vocab"].items()} | {t["id"]: t["content"] for t in whole["added_tokens"]}
    return pa.array([named.get(i, "") for i in range(max(named) + 1)])


def binaries(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary of little-endian 32-bit ids per count."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(ids, "<u4").tobytes())])


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids and counts of a binary column; null counts as empty."""
    column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    ids = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view("<u4") if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint32)
    return ids, np.diff(offsets.astype(np.int64)) // 4


def round_trip_query(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    both = decode(encode(docs.select("doc_id", "text"), path=path), path=path)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
