"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end token. The model is
learned from the training documents:

1. word counts over all training documents (Spark aggregation);
2. the HEAD most frequent words (a bounded vocabulary) become numbers, and every document a
   stored sequence of them; a rarer word becomes the number of its shape (length band,
   non-ASCII or not, last character) and is kept beside it as text;
3. exchange clustering puts each of the MOVED most frequent words in the class that gives
   the highest class-bigram likelihood. A round counts, over the whole corpus, each word's
   left and right neighbour classes (summed per block of words in Spark) and then exchanges
   words in turn on those bounded counts. All other words stay in the class of their shape;
4. the score of a text is the sum over its tokens of log10 P(class | previous class) +
   log10 P(word | class); the end token precedes the first word. Transitions are smoothed
   towards class frequencies, emissions by a constant for each word of the class and one
   for a new word. Counts of rare words come from a join with the count table.

Null text: as empty (the end token alone). A null id counts as the empty string for the
split and comes out as null. Repeated rows and ids stay separate. Without training
documents all counts are zero. Empty tables give no rows. Extra columns are ignored.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_in, id_out, prepare, stored, strings

#: Words that are numbers of their own; words that exchange moves; classes it fills.
HEAD, MOVED, CLASSES = 60_000, 16_384, 64
ROUNDS = 3
SHAPES = 32
#: Words in a block of neighbour counts.
BLOCK = 1024
#: Partial sums of a block of neighbour counts.
SALTS = 32
#: Distinct words that a task counts before it hands them on.
FLUSH = 500_000
EMIT, FALLBACK = 0.5, 5.0


def shape(word: bytes) -> int:
    last = word[-1:]
    kind = 0 if last.isalnum() or last >= b"\x80" else 1 if last == b"." else 2 if last == b"," else 3
    return kind * 8 + (not word.isascii()) * 4 + min(3, (len(word) - 1) // 4)


class Vocabulary(dict):
    """Word -> number; a word outside gives ``len(words) + its shape``."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.head = len(words)

    def __missing__(self, word: bytes) -> int:
        return self.head + shape(word)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id's text, modulo 7, is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n): counts over all texts, summed per task before the shuffle."""
    def run(batches):
        def rows(c):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c.keys()), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())],
                ["word", "n"])
        c: Counter = Counter()
        for batch in batches:
            for text in strings(batch.column("text")):
                c.update(text.lower().split())
            if len(c) >= FLUSH:
                yield rows(c)
                c = Counter()
        yield rows(c)
    return (train.select("text").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


CODED = ("row long, doc_id long, held boolean, ids binary, "
         "rare array<struct<word:string,n:int>>")
_RARE = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))


def coded(rows: DataFrame, words) -> DataFrame:
    """Documents as numbers (unsigned 16-bit, end token last), rare words beside them."""
    def run(batches):
        vocabulary = Vocabulary(words.value)
        head, end = vocabulary.head, vocabulary.head + SHAPES
        base, at = TaskContext.get().partitionId() << 36, 0
        for batch in batches:
            ids, rare = [], []
            for text in strings(batch.column("text")):
                tokens = text.lower().split()
                numbers = [vocabulary[w] for w in tokens]
                rare.append([{"word": w.decode(), "n": n} for w, n in
                             Counter([w for w, i in zip(tokens, numbers) if i >= head]).items()])
                numbers.append(end)
                ids.append(np.array(numbers, "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(base + at, base + at + len(ids))), batch.column("doc_id"),
                 batch.column("held"), pa.array(ids, pa.binary()), pa.array(rare, _RARE)],
                ["row", "doc_id", "held", "ids", "rare"])
            at += len(ids)
    return rows.mapInArrow(run, CODED)


def _pairs(ids_column) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring numbers; each document ends with the end token, which also precedes
    its first word."""
    ids = np.frombuffer(b"".join(ids_column), "<u2").astype(np.int64)
    return np.append(ids[-1:], ids[:-1]), ids


def neighbour_counts(train: DataFrame, classes: np.ndarray, moved: int, m: int):
    """Counts over all training pairs: class x class, and for the first ``moved`` words
    their left and right neighbour classes."""
    share = train.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        of = share.value
        salt = TaskContext.get().partitionId() % SALTS
        total = [np.zeros(m * m, np.int64), np.zeros(moved * m, np.int64), np.zeros(moved * m, np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _pairs(batch.column("ids").to_pylist())
            ca, cb = of[a], of[b]
            total[0] += np.bincount(ca * m + cb, minlength=m * m)
            w = a < moved
            total[1] += np.bincount(a[w] * m + cb[w], minlength=moved * m)
            w = b < moved
            total[2] += np.bincount(b[w] * m + ca[w], minlength=moved * m)
        rows = []
        for kind, t in enumerate(total):
            size = BLOCK * m
            for i in range(0, len(t), size):
                at = np.flatnonzero(t[i:i + size])
                if len(at):
                    rows.append((kind, i // size, salt, at.astype("<u4").tobytes(), t[i + at].astype("<i8").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows) if rows else [[]] * 5, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            ["kind", "block", "salt", "at", "n"])

    names = ["kind", "block", "salt", "at", "n"]

    def add(batches):
        """Sums of rows sorted by (kind, block): one dense block is held at a time."""
        salt = TaskContext.get().partitionId() % SALTS
        key, held = None, None

        def row():
            at = np.flatnonzero(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([salt], pa.int32()),
                 pa.array([at.astype("<u4").tobytes()], pa.binary()),
                 pa.array([held[at].astype("<i8").tobytes()], pa.binary())], names)
        for batch in batches:
            for kind, block, at, n in zip(*(batch.column(c).to_pylist() for c in ("kind", "block", "at", "n"))):
                if (kind, block) != key:
                    if key:
                        yield row()
                    key, held = (kind, block), np.zeros(BLOCK * m, np.int64)
                held[np.frombuffer(at, "<u4")] += np.frombuffer(n, "<i8")
        if key:
            yield row()
    schema = "kind int, block int, salt int, at binary, n binary"
    summed = train.select("ids").mapInArrow(run, schema)
    for by in (("kind", "block", "salt"), ("kind", "block")):  # many partial sums, then one
        summed = summed.repartition(*by).sortWithinPartitions("kind", "block").mapInArrow(add, schema)
    out = [np.zeros(-(-n // BLOCK) * BLOCK * m, np.int64) for n in (m, moved, moved)]
    for kind, block, _, at, n in summed.collect():  # bounded by the vocabulary and the classes
        out[kind][block * BLOCK * m + np.frombuffer(at, "<u4")] = np.frombuffer(n, "<i8")
    share.unpersist()
    return out[0][:m * m].reshape(m, m), out[1][:moved * m].reshape(moved, m), out[2][:moved * m].reshape(moved, m)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(between: np.ndarray, right: np.ndarray, left: np.ndarray, classes: np.ndarray,
             choices: int) -> int:
    """Move each word in turn to the class with the highest likelihood; returns the moves.
    The class counts follow every move; neighbour classes are those of the round's start."""
    n = between.astype(np.float64)
    moves = 0
    for w in range(len(right)):
        r, l_, old = right[w].astype(np.float64), left[w].astype(np.float64), classes[w]
        total = r.sum()
        if not total:
            continue
        n[old] -= r
        n[:, old] -= l_
        np.maximum(n, 0, out=n) if (n[old] < 0).any() or (n[:, old] < 0).any() else None
        size = n[:choices].sum(axis=1)
        rc, lc = np.flatnonzero(r), np.flatnonzero(l_)
        out_, in_ = n[:choices][:, rc], n[lc][:, :choices]
        gain = ((_xlogx(out_ + r[rc]) - _xlogx(out_)).sum(axis=1)
                + (_xlogx(in_ + l_[lc][:, None]) - _xlogx(in_)).sum(axis=0)
                - 2 * (_xlogx(size + total) - _xlogx(size)))
        new = int(np.argmax(gain))
        if gain[new] <= gain[old] + 1e-9:
            new = old
        moves += new != old
        classes[w] = new
        n[new] += r
        n[:, new] += l_
    return moves


def brown_scores(docs: DataFrame, held=None, head: int = HEAD, moved: int = MOVED,
                 choices: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    document; ``held``: the column that marks documents not to learn from."""
    spark = docs.sparkSession
    prepare(spark)
    held = held_out() if held is None else held
    rows = docs.select(id_in().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(held, F.lit(False)).alias("held"))
    train = rows.filter(~F.col("held"))
    counts = stored(word_counts(train), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(head).collect()
    words = spark.sparkContext.broadcast([r["word"].encode() for r in top])
    table = stored(coded(rows, words), "coded")
    learned = table.filter(~F.col("held"))

    # V, N and what each shape holds, over all training tokens
    h = len(top)
    end_count = learned.count()
    all_words = counts.agg(F.count("*"), F.sum("n")).first()
    n_types, n_tokens = all_words[0] + (end_count > 0), (all_words[1] or 0) + end_count
    head_n = np.array([r["n"] for r in top], np.float64)
    head_shape = np.array([shape(r["word"].encode()) for r in top], np.int64)

    moved = min(moved, h)
    m = choices + SHAPES + 1
    classes = np.empty(h + SHAPES + 1, np.int64)
    classes[:moved] = np.arange(moved) % choices
    classes[moved:h] = choices + head_shape[moved:]
    classes[h:] = choices + np.arange(SHAPES + 1)  # the end token is a class of its own
    for _ in range(rounds):
        between, right, left = neighbour_counts(learned, classes, moved, m)
        if not exchange(between, right, left, classes, choices):
            break
    between = neighbour_counts(learned, classes, 0, m)[0].astype(np.float64)

    # class sizes: tokens and types; rare types by shape from the count table
    size = between.sum(axis=0)
    types = np.bincount(classes[:h], minlength=m).astype(np.float64)
    if all_words[0] > h:
        for s, n in rare_types(counts, words):
            types[choices + s] += n
    types[m - 1] = 1
    prior = (size + 1) / (size.sum() + m)
    step = np.log10((between + FALLBACK * prior) / (between.sum(axis=1, keepdims=True) + FALLBACK))
    below = np.log10(size + EMIT * (types + 1))  # of emissions
    below[m - 1] = 0.0
    emit = np.zeros(h + SHAPES + 1)
    emit[:h] = np.log10(head_n + EMIT) - below[classes[:h]]
    emit[h:h + SHAPES] = -below[choices:choices + SHAPES]  # rare words: counts are joined in
    floor = np.log10(n_tokens + n_types + 1)
    base = np.zeros(h + SHAPES + 1)
    base[:h] = np.log10(head_n + 1)
    base[-1] = np.log10(end_count + 1)
    base -= floor
    known = np.zeros(h + SHAPES + 1, np.int64)
    known[:h], known[-1] = 1, end_count > 0
    model = spark.sparkContext.broadcast((classes, step, emit, base, known))

    def score(batches):
        classes, step, emit, base, known = model.value
        for batch in batches:
            out = []
            for raw in batch.column("ids").to_pylist():
                ids = np.frombuffer(raw, "<u2")
                c = classes[ids]
                out.append((len(ids), int(known[ids].sum()), float(base[ids].sum()),
                            float(step[np.append(c[-1:], c[:-1]), c].sum() + emit[ids].sum())))
            n, k, b, s = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held"),
                 pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(b, pa.float64()),
                 pa.array(s, pa.float64())],
                ["row", "doc_id", "held", "n_tokens", "n_known", "base", "score"])
    own = table.select("row", "doc_id", "held", "ids").mapInArrow(
        score, "row long, doc_id long, held boolean, n_tokens long, n_known long, base double, score double")
    rare = table.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("k"))
    c = F.coalesce(F.col("n"), F.lit(0))
    added = (rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(c + 1)).alias("base_more"),
        F.sum(F.col("k") * F.log10(c + F.lit(EMIT))).alias("score_more"),
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known_more")))
    zero = F.lit(0)
    return own.join(added, "row", "left").select(
        id_out().alias("doc_id"), F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known_more", zero)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score_more", zero)).alias("score"))


def rare_types(counts: DataFrame, words) -> list[tuple[int, int]]:
    """Types outside the head by shape (at most SHAPES rows)."""
    def run(batches):
        head = set(words.value)
        total = np.zeros(SHAPES, np.int64)
        for batch in batches:
            for w in strings(batch.column("word")):
                if w not in head:
                    total[shape(w)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES), pa.int32()), pa.array(total)],
                                         ["shape", "n"])
    got = counts.select("word").mapInArrow(run, "shape int, n long").groupBy("shape").agg(F.sum("n")).collect()
    return [(r[0], r[1]) for r in got]
