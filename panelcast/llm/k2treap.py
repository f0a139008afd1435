"""Ranked lexical search with K2-treaps over the term-document grid.

The documents of a shard are columns (ascending doc_id), its distinct words rows. A cell
(word, document) holds the word's impact in the document,

    (10^9 * tf) div (1000 * tf + 12 * m),  m = 75 + ((25 * n * N) div L),

with tf occurrences among the document's n words, N documents with words and L words in
all. The square grid is cut into quarters down to single cells. Only non-empty quarters
are kept, level by level: four bits a quarter name its children, and its maximum impact is
stored as the difference to its parent's (one bit where there is none). Children are found
by counting bits.

An item's words are rows. Their paths descend jointly: a state is a range of documents
with the quarter of every row over it, its bound the weighted sum of the quarters' maxima.
The states of highest bounds are opened first, some at a time; a range goes on while its
bound reaches the k-th best score found so far (for equal scores: while it holds a smaller
doc_id). A single document's bound is its exact score.

``build_index`` gives one row a shard, written to the shared folder, so a lost executor
only reads it again. Shards are cut from the input partitions as they stream: no shuffle,
no key that could be hot. ``search`` sends the items in blocks of bounded size to the
shards; each task keeps the best rows of all its shards and a ranking window merges them.

Null or wordless texts are indexed without words and never rank; null or wordless items
give no rows. Null ids come last among equal scores and return as null. Repeated ids and
rows stay apart, and each row of items is ranked by itself. Equal scores go by ascending
doc_id. Empty tables give no rows. Texts of any length are indexed whole.
"""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, grouped, id_out, stored, strings, texts
from .wordcodes import count_words, fold_words, word_codes

#: Text bytes and documents of a shard.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1 << 16
#: Text bytes of the items that are sent to the shards at once.
ITEM_BYTES = 4 << 20
#: Ranges opened at once.
OPEN = 256

_ONES = np.array([bin(m).count("1") for m in range(16)], np.int8)
#: Children before child q of a quarter with child bits m.
_BEFORE = np.array([[_ONES[m & ((1 << q) - 1)] for q in range(4)] for m in range(16)], np.int8)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _side(n: int) -> int:
    """Bits of a side that holds n rows."""
    return max(0, int(n - 1).bit_length())


def build(rows: np.ndarray, cols: np.ndarray, impact: np.ndarray, height: int) -> tuple[bytes, bytes, bytes]:
    """(child bits, bits of quarters below their parent's maximum, differences) of the points."""
    code = (_spread(rows) << np.uint64(1)) | _spread(cols)
    order = np.argsort(code)
    code, top = code[order], impact[order].astype(np.int64)
    masks, drops = [], []
    for _ in range(height):
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(code) else np.zeros(0, int)
        bit = (1 << (code & np.uint64(3)).astype(np.int64)).astype(np.uint8)
        best = np.maximum.reduceat(top, first) if len(first) else top
        masks.append(np.bitwise_or.reduceat(bit, first) if len(first) else bit)
        drops.append(np.repeat(best, np.diff(np.append(first, len(code)))) - top)
        code, top = parent[first], best
    mask = np.concatenate([np.zeros(0, np.uint8), *masks[::-1]])
    drop = np.concatenate([top, *drops[::-1]])  # of the root: its maximum
    if len(mask) % 2:
        mask = np.append(mask, np.uint8(0))
    return ((mask[::2] | (mask[1::2] << 4)).tobytes(), np.packbits(drop > 0).tobytes(),
            drop[drop > 0].astype(np.uint32).tobytes())


class Treap:
    """A shard's quarters, level by level; number ``none`` stands for an empty quarter."""

    def __init__(self, mask: bytes, lower: bytes, drop: bytes, height: int, n_docs: int):
        self.height, self.width = height, _side(n_docs)
        packed = np.frombuffer(mask, np.uint8)
        bits = np.empty(2 * len(packed), np.uint8)
        bits[::2], bits[1::2] = packed & 15, packed >> 4
        kids = _ONES[bits].astype(np.int64)
        self.none = 1 + int(kids.sum())  # every quarter but the root is a child
        inner = len(bits)
        self.first = np.zeros(self.none + 1, np.int32)
        self.first[:inner] = 1 + np.concatenate([[0], np.cumsum(kids)[:-1]]) if inner else 0
        self.mask = np.zeros(self.none + 1, np.uint8)
        self.mask[:inner] = bits
        drops = np.zeros(self.none, np.int64)
        drops[np.flatnonzero(np.unpackbits(np.frombuffer(lower, np.uint8))[:self.none])] = np.frombuffer(drop, np.uint32)
        self.top = np.zeros(self.none + 1, np.int64)
        at, n = 0, 1
        level = drops[:1].copy()
        for _ in range(height + 1):
            self.top[at:at + n] = level
            if at + n >= self.none:
                break
            kid = kids[at:at + n]
            parents, at = np.repeat(level, kid), at + n
            n = int(kid.sum())
            level = parents - drops[at:at + n]

    def child(self, node: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        m = self.mask[node]
        return np.where((m >> quarter.astype(np.uint8)) & 1, self.first[node] + _BEFORE[m, quarter], self.none)

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int, floor: tuple[int, int],
               ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, columns) of the best k documents that beat ``floor`` (score, doc_id)."""
        node = np.zeros(len(rows), np.int64)
        for level in range(self.height - self.width):  # all documents lie in the left half
            node = self.child(node, 2 * ((rows >> (self.height - 1 - level)) & 1))
        nodes, col = node[None, :], np.zeros(1, np.int64)
        deep = np.full(1, self.height - self.width)
        bound = self.top[nodes] @ weights
        found, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.width == 0:
            keep = bound > 0
            return bound[keep], col[keep]
        while len(bound):
            if len(bound) > OPEN:
                cut = np.argpartition(-bound, OPEN - 1)
                now, rest = cut[:OPEN], cut[OPEN:]
            else:
                now, rest = np.arange(len(bound)), np.zeros(0, np.int64)
            bit = 2 * ((rows[None, :] >> (self.height - 1 - deep[now])[:, None]) & 1)
            new = np.concatenate([self.child(nodes[now], bit), self.child(nodes[now], bit + 1)])
            new_col = np.concatenate([2 * col[now], 2 * col[now] + 1])
            new_deep = np.concatenate([deep[now] + 1] * 2)
            new_bound = self.top[new] @ weights
            end = new_deep == self.height
            done = end & (new_bound > 0)
            if done.any():
                found, places = np.append(found, new_bound[done]), np.append(places, new_col[done])
                best = np.lexsort((places, -found))[:k]
                found, places = found[best], places[best]
                if len(found) == k:
                    floor = max(floor, (int(found[-1]), -int(ids[places[-1]])))
            live = ~end & (new_bound > 0)
            bound = np.concatenate([bound[rest], new_bound[live]])
            col = np.concatenate([col[rest], new_col[live]])
            deep = np.concatenate([deep[rest], new_deep[live]])
            nodes = np.concatenate([nodes[rest], new[live]])
            # a range stays if it may hold a higher score, or the same with a smaller id
            low = np.minimum(col << (self.height - deep), len(ids) - 1)
            keep = (bound > floor[0]) | ((bound == floor[0]) & (ids[low] < -floor[1]))
            if not keep.all():
                bound, col, deep, nodes = bound[keep], col[keep], deep[keep], nodes[keep]
        return found, places


def corpus_counts(docs: DataFrame) -> tuple[int, int]:
    """(documents with at least one word, words in all)."""
    def run(batches):
        for batch in batches:
            n = count_words(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())], pa.int64()),
                                              pa.array([int(n.sum())], pa.int64())], ["docs", "words"])
    row = texts(docs).mapInArrow(run, "docs long, words long").agg(F.sum("docs"), F.sum("words")).first()
    return int(row[0] or 0), int(row[1] or 0)


INDEX = ("ids array<long>, words array<binary>, df array<int>, height int, mask binary, lower binary, drop binary")
_INDEX = pa.schema([("ids", pa.list_(pa.int64())), ("words", pa.list_(pa.binary())), ("df", pa.list_(pa.int32())),
                    ("height", pa.int32()), ("mask", pa.binary()), ("lower", pa.binary()), ("drop", pa.binary())])


def shard_row(ids: np.ndarray, bodies: list[bytes], n_docs: int, n_words: int) -> pa.RecordBatch:
    """The index row of one shard."""
    order = np.argsort(ids, kind="stable")
    words, code, lengths = word_codes([bodies[i] for i in order])
    doc = np.repeat(np.arange(len(ids)), lengths)
    cell, tf = np.unique((code << 32) | doc, return_counts=True)
    row, col = cell >> 32, cell & 0xFFFFFFFF
    m = 75 + (25 * lengths * n_docs) // max(1, n_words)
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[col])
    height = max(_side(len(words)), _side(len(ids)))
    return pa.RecordBatch.from_pydict({
        "ids": [ids[order]], "words": [words.cast(pa.large_binary()).cast(pa.binary())],
        "df": [np.bincount(row, minlength=len(words)).astype(np.int32)],
        "height": [height], **{n: [b] for n, b in zip(("mask", "lower", "drop"), build(row, col, impact, height))}},
        _INDEX)


def build_index(docs: DataFrame, n_docs: int, n_words: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row a shard: document ids, words, their document frequencies and the treap."""
    def run(batches):
        for part in grouped(batches, shard_bytes, rows=SHARD_ROWS):
            bodies = [t for chunk in part.column("text").chunks for t in strings(chunk)]
            yield shard_row(part.column("doc_id").to_numpy(), bodies, n_docs, n_words)
    return stored(texts(docs).mapInArrow(run, INDEX), "treaps")


def document_frequencies(index: DataFrame, words: list[str]) -> dict[str, int]:
    """Documents that hold each of the given words."""
    asked = pa.array([w.encode() for w in words], pa.binary())

    def run(batches):
        for batch in batches:
            total = np.zeros(len(asked), np.int64)
            for i in range(batch.num_rows):
                at = pc.index_in(asked, value_set=batch.column("words")[i].values)
                known = np.flatnonzero(np.asarray(at.is_valid()))
                total[known] += np.asarray(batch.column("df")[i].values)[np.asarray(at.drop_null())]
            got = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(total[got], pa.int64())],
                                             ["word", "df"])
    rows = index.select("words", "df").mapInArrow(run, "word int, df long").groupBy("word").agg(F.sum("df"))
    return {words[r[0]]: int(r[1]) for r in rows.collect()}


def search(index: DataFrame, items: list[tuple[int, list[str]]], n_docs: int, k: int) -> DataFrame:
    """(place int, item_id, doc_id, score) of the best documents for a block of items."""
    asked = sorted({w for _, ws in items for w in ws})
    df = document_frequencies(index, asked)
    number = {w: i for i, w in enumerate(asked)}
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(w, 0) + 1))) for w in asked], np.int64)
    bags = [Counter(ws) for _, ws in items]
    rows_of = [np.array([number[w] for w in bag], np.int64) for bag in bags]
    weights_of = [np.array(list(bag.values()), np.int64) * weight[rows] for bag, rows in zip(bags, rows_of)]
    value = pa.array([w.encode() for w in asked], pa.binary())
    owner = [i for i, _ in items]

    def run(batches):
        best = [[] for _ in owner]  # (-score, doc_id), best first
        for batch in batches:
            for i in range(batch.num_rows):
                col = {n: batch.column(n)[i] for n in batch.schema.names}
                ids = np.asarray(col["ids"].values)
                treap = Treap(col["mask"].as_py(), col["lower"].as_py(), col["drop"].as_py(), col["height"].as_py(), len(ids))
                row = pc.index_in(value, value_set=col["words"].values).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                for q, (rows, weights) in enumerate(zip(rows_of, weights_of)):
                    here = (row[rows] >= 0) & (weights > 0)
                    if not here.any():
                        continue
                    floor = (-best[q][-1][0], -best[q][-1][1]) if len(best[q]) == k else (0, -NULL_ID - 1)
                    score, place = treap.search(row[rows[here]], weights[here], k, floor, ids)
                    best[q] = sorted(best[q] + list(zip((-score).tolist(), ids[place].tolist())))[:k]
        out = [(q, owner[q], d, -s) for q, rows in enumerate(best) for s, d in rows]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*out) if out else ([], [], [], []), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["place", "item_id", "doc_id", "score"])
    return index.mapInArrow(run, "place int, item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, shard_bytes: int = SHARD_BYTES,
                  item_bytes: int = ITEM_BYTES, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id long, rank int, doc_id long, score long): the k best documents of each item."""
    n_docs, n_words = corpus_counts(docs)
    index = build_index(docs, n_docs, n_words, shard_bytes)
    asked = texts(items, item_col, text_col)
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // item_bytes)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, blocks))))
    found = None
    for block in range(blocks):
        part = [(r["doc_id"], fold_words(r["text"])) for r in asked.filter(F.col("block") == block).collect()]
        best = search(index, part, n_docs, k).withColumn("block", F.lit(block))
        found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(id_out("item_id").alias("item_id"), "rank", id_out().alias("doc_id"), "score"))
