"""Benchmark decontamination with an FM-index per shard of documents.

A shard's documents are one sequence of word codes with a separator behind each document.
Its suffixes are sorted by prefix doubling: by three words first, then equal suffixes by
the ranks twice as far on, until none are equal (separators differ, so no comparison
leaves its document). The preceding words in suffix order form a wavelet matrix: one bit
array a bit of the code, with counts every 64 bits. All test phrases are searched backward
at once: the range of suffixes that begin with a phrase narrows by two ranks a word. The
places of a range come from sampled suffix positions: every 16th position and each
document's start is stored, and the others step back through the index to one.

A phrase is a window of ``width`` consecutive words of an item, or the whole of a shorter
item. Words under an occurrence merge to spans, which are what decontamination removes.

Shards are cut from the input partitions as they stream: no shuffle and no key that could
be hot. Items go to the shards in blocks of bounded size, one pass after another in the
same tasks, each adding to the spans of the blocks before.

Words are maximal runs of digits, letters and characters beyond ASCII, only A-Z lower-
cased. Null texts and texts without words: no words, no spans; items without words match
nothing. Null doc ids return as null; items with null ids count as an item named "null".
Repeated rows and ids stay apart; items with one id count once. Empty tables are fine. Texts of any length
are indexed whole.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, id_out, strings, texts
from .wordcodes import fold_words, word_codes

#: Text bytes and documents of a shard.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1 << 16
#: Text bytes of the items that are sent to the shards at once.
ITEM_BYTES = 4 << 20
#: Every so many positions are sampled.
SAMPLE = 16


class Bits:
    """A bit array with counts every 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.counts = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.counts[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[i >> 6] + np.bitwise_count(self.words[i >> 6] & below)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Access and rank over a sequence of whole numbers below ``size``."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.zeros = [], []
        for level in reversed(range(max(1, int(size - 1).bit_length()))):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append((level, Bits(bit)))
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the next occurrence of ``symbol`` at or behind position i ends up in the last
        order: its rank there, counted from the same of position 0."""
        for (level, bits), zeros in zip(self.levels, self.zeros):
            ones = bits.ones(i)
            i = np.where((symbol >> level) & 1, zeros + ones, i - ones)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols at positions i, their places in the last order)."""
        symbol = np.zeros(len(i), np.int64)
        for (_, bits), zeros in zip(self.levels, self.zeros):
            one, ones = bits.at(i), bits.ones(i)
            symbol = (symbol << 1) | one
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i


def suffix_array(symbols: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of a sequence of numbers below ``size``; its last symbol, and
    one in every long repeat, is unique."""
    n, bits = len(symbols), max(1, int(size - 1).bit_length())
    step = max(1, min(3, 62 // bits))
    key = symbols.astype(np.int64)
    for i in range(1, step):
        key = key << bits
        key[:n - i] |= symbols[i:]
    order = np.argsort(key)
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    alone = new & np.append(new[1:], True)
    open_at = np.flatnonzero(~alone)  # places in the order that share their key
    while len(open_at):
        suffix, group = order[open_at], start[open_at]
        following = rank[suffix + step]
        by = np.lexsort((following, group))
        suffix, following = suffix[by], following[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        order[open_at], start[open_at] = suffix, open_at[first]
        rank[suffix] = open_at[first]
        open_at = open_at[~(new & np.append(new[1:], True))]
        step *= 2
    return order


class FMIndex:
    """Documents as word codes; ``lengths`` words each."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, n_words: int):
        docs = len(lengths)
        self.ends = np.cumsum(lengths + 1) - 1  # places of the separators
        n = len(codes) + docs
        text = np.empty(n, np.int64)
        word = np.ones(n, bool)
        word[self.ends] = False
        text[word] = codes + docs
        text[self.ends] = np.arange(docs)
        order = suffix_array(text, docs + n_words)
        symbols = np.where(word, text - docs + 1, 0)  # all separators are one symbol here
        before = symbols[order - 1]
        self.matrix = WaveletMatrix(before, n_words + 1)
        every = np.arange(n_words + 1)
        counts = np.bincount(symbols, minlength=n_words + 1)
        smaller = np.cumsum(counts) - counts
        self.base = smaller - self.matrix.follow(every, np.zeros(n_words + 1, np.int64))
        self.size = n
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.marks, self.places = Bits(sampled), order[sampled]

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.base[symbol] + self.matrix.follow(symbol, i)

    def find(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of word codes."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for column in phrases.T[::-1]:
            live = np.flatnonzero(lo < hi)
            symbol = column[live] + 1
            lo[live], hi[live] = self.step(symbol, lo[live]), self.step(symbol, hi[live])
        return lo, hi

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at places i of the order."""
        i, out, steps = i.copy(), np.empty(len(i), np.int64), np.zeros(len(i), np.int64)
        open_at = np.arange(len(i))
        while len(open_at):
            known = self.marks.at(i[open_at])
            done = open_at[known]
            out[done] = self.places[self.marks.ones(i[done])] + steps[done]
            open_at = open_at[~known]
            symbol, last = self.matrix.access(i[open_at])
            i[open_at] = self.base[symbol] + last
            steps[open_at] += 1
        return out


def phrases_of(items: list[tuple[str, list[str]]], width: int) -> list[tuple[int, list[str], np.ndarray, list[list[str]]]]:
    """(length, vocabulary, phrases as rows of numbers, names of the items of each phrase),
    for each length that occurs."""
    held: dict[tuple[str, ...], set[str]] = {}
    for name, words in items:
        n = min(width, len(words))
        for at in range(len(words) - n + 1) if n else ():
            held.setdefault(tuple(words[at:at + n]), set()).add(name)
    out = []
    for n in sorted({len(p) for p in held}):
        own = [p for p in held if len(p) == n]
        vocabulary = sorted({w for p in own for w in p})
        number = {w: i for i, w in enumerate(vocabulary)}
        out.append((n, vocabulary, np.array([[number[w] for w in p] for p in own], np.int64), [sorted(held[p]) for p in own]))
    return out


def shard_hits(bodies: list[bytes], phrases, spans: list, items: list) -> tuple[np.ndarray, list, list]:
    """(words, spans of words under occurrences, names of items that occur) of each document;
    ``spans`` and ``items`` are those known before."""
    words, codes, lengths = word_codes(bodies)
    words = words.cast(pa.large_binary())
    starts = np.cumsum(lengths + 1) - lengths - 1
    edge = np.zeros(int((lengths + 1).sum()) + 1, np.int64)
    for d, old in enumerate(spans):
        for s in old or ():
            edge[starts[d] + s["start"]] += 1
            edge[starts[d] + s["end"]] -= 1
    names = [set(x or ()) for x in items]
    index = FMIndex(codes, lengths, len(words)) if len(codes) else None
    for n, vocabulary, rows, owners in phrases if index else ():
        at = pc.index_in(pa.array([w.encode() for w in vocabulary], pa.large_binary()), value_set=words)
        code = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
        known = np.flatnonzero((code >= 0).all(axis=1))
        lo, hi = index.find(code[known])
        many = hi - lo
        which = np.repeat(known, many)
        place = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        place = index.locate(place)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + n, -1)
        doc = np.searchsorted(index.ends, place)
        for d, p in np.unique(np.stack([doc, which], 1), axis=0).tolist():
            names[d].update(owners[p])
    covered = np.cumsum(edge[:-1]) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    begin, end = change[::2], change[1::2]
    doc = np.searchsorted(starts, begin, "right") - 1
    out: list[list] = [[] for _ in bodies]
    for d, a, b in zip(doc.tolist(), (begin - starts[doc]).tolist(), (end - starts[doc]).tolist()):
        out[d].append({"start": a, "end": b})
    return lengths, out, [sorted(x) for x in names]


STATE = "doc_id long, text string, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search_block(state: DataFrame, phrases, shard_bytes: int) -> DataFrame:
    def run(batches):
        for part in grouped(batches, shard_bytes, rows=SHARD_ROWS):
            bodies = [t for chunk in part.column("text").chunks for t in strings(chunk)]
            n, spans, names = shard_hits(bodies, phrases, part.column("spans").to_pylist(), part.column("items").to_pylist())
            yield from pa.Table.from_arrays(
                [part.column("doc_id"), part.column("text"), pa.array(n, pa.int64()), pa.array(spans, _SPANS),
                 pa.array(names, pa.list_(pa.string()))], ["doc_id", "text", "n_words", "spans", "items"]).combine_chunks().to_batches(1024)
    return state.mapInArrow(run, STATE)


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, shard_bytes: int = SHARD_BYTES,
                  item_bytes: int = ITEM_BYTES, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, n_words long, spans array<struct<start, end>>, items array<string>): the
    words of each document that lie inside phrases of the items (spans of word numbers, end
    exclusive, in order), and the ids of these items, sorted as strings."""
    asked = (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                          F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    state = texts(docs).select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                               F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
                               F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        own = [(r["item"], fold_words(r["text"])) for r in asked.filter(F.col("block") == block).collect()]
        state = _search_block(state, phrases_of(own, width), shard_bytes)
    return state.select(id_out().alias("doc_id"), "n_words", "spans", "items")
