"""SimHash near-duplicates by a self-join of binary tries over 64-bit fingerprints.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; shingles of
``words`` words, repeats included, joined by a space (fewer words: the whole sequence;
none: fingerprint zero). A bit is set if it is set in over half of the shingles' XXH64
hashes (seed 42).

Linking. Distinct fingerprints within ``bits`` differing bits agree on one of bits + 1
blocks (pigeonhole). So there is one trie for each block, whose first bits are that block:
below the depth of the block only pairs inside one subtree can differ by at most ``bits``
overall with no difference above, and each subtree is joined with itself in one task. The
join walks pairs of nodes together, adds one for every level at which the branches differ,
and drops a pair whose sum exceeds the budget. Subtrees of very many fingerprints are cut
deeper: their children's node pairs become tasks of their own. A task sends one edge per
fingerprint at most (a spanning forest), never the pairs of a group, and components are
found on all tasks' edges.

Null text: as empty. Null ids count as the largest. Copies share a fingerprint, which takes
part once. Empty tables give no rows. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_in, id_out, prepare, strings, stored, texts
from .components import connected_components

SEED = 42
WORDS = 3
BITS = 3
#: A subtree with more fingerprints is cut SPLIT bits deeper.
SUBTREE = 1 << 16
SPLIT = 6
#: Node pairs held at once; the rest waits on a stack.
FRONTIER = 1 << 20


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = ends[words - 1:] if len(parts) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), last.tolist())),
                       np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """The majority of each bit, as an unsigned number."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[a:a + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, body long, fp long): a hash of the text, and the fingerprint's bits as a
    signed number."""
    def run(batches):
        for batch in batches:
            fps = np.array([simhash(shingle_hashes(t, words)) for t in strings(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("body"), pa.array(fps.view(np.int64))], ["doc_id", "body", "fp"])
    rows = texts(docs).withColumn("body", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, body long, fp long")


def hex_digits(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ------------------------------------------------------------------ trie join in a task
def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Forest:
    """Components of rows by hooking roots, vectorised."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j = i[open_], j[open_]
            np.minimum.at(self.root, np.maximum(a[open_], b[open_]), np.minimum(a[open_], b[open_]))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_join(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, lo2: np.ndarray, hi2: np.ndarray,
              depth: np.ndarray, used: np.ndarray, bits: int) -> np.ndarray:
    """Component roots of the sorted fingerprints x under links of at most ``bits`` differing
    bits between the paired nodes. A node is a range of x that shares its first ``depth``
    bits; ``used`` counts the differing bits above."""
    forest = Forest(len(x))
    near = _popcount(x[1:] ^ x[:-1]) <= bits
    forest.link(np.flatnonzero(near), np.flatnonzero(near) + 1)
    chain = np.append(0, np.cumsum(~near))  # neighbours linked already share a number
    stack = [(lo, hi, lo2, hi2, depth, used)]
    while stack:
        front = stack.pop()
        if len(front[0]) > FRONTIER:
            half = len(front[0]) // 2
            stack += [tuple(f[:half] for f in front), tuple(f[half:] for f in front)]
            continue
        a, b, c, d, depth, used = front
        keep = (a < b) & (c < d) & (used <= bits) & ~((a == c) & (b - a == 1))
        a, b, c, d, depth, used = (f[keep] for f in (a, b, c, d, depth, used))
        joined = (chain[a] == chain[b - 1]) & (chain[c] == chain[d - 1]) & (chain[a] == chain[c])
        a, b, c, d, depth, used = (f[~joined] for f in (a, b, c, d, depth, used))
        if not len(a):
            continue
        small = (b - a) * (d - c) <= 16
        if small.any():  # leaves: all bits below at once
            n = (d - c)[small]
            m = (b - a)[small] * n
            which = np.repeat(np.flatnonzero(small), m)
            step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            i, j = a[which] + step // np.repeat(n, m), c[which] + step % np.repeat(n, m)
            near = _popcount(x[i] ^ x[j]) <= bits
            forest.link(i[near], j[near])
            a, b, c, d, depth, used = (f[~small] for f in (a, b, c, d, depth, used))
        if not len(a):
            continue
        # the middle of a range: its members with the next bit set come last
        bit = np.uint64(63) - depth.astype(np.uint64)

        def middle(p, q):
            lo_, hi_ = p.copy(), q.copy()
            while True:
                open_ = lo_ < hi_
                if not open_.any():
                    return lo_
                mid = (lo_ + hi_) // 2
                one = (x[np.minimum(mid, len(x) - 1)] >> bit) & np.uint64(1) == 1
                hi_ = np.where(open_ & one, mid, hi_)
                lo_ = np.where(open_ & ~one, mid + 1, lo_)
        m1, m2 = middle(a, b), middle(c, d)
        own = a == c  # a node with itself: its two children cross only once
        other = ~own
        stack.append(tuple(np.concatenate(f) for f in zip(
            (a, m1, c, m2, depth + 1, used), (m1, b, m2, d, depth + 1, used),
            (a, m1, m2, d, depth + 1, used + 1),
            tuple(f[other] for f in (m1, b, c, m2, depth + 1, used + 1)))))
    return forest.root


def _rotate(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    return (x << by) | (x >> (np.uint64(63) - by) >> np.uint64(1))


def block_starts(bits: int) -> list[int]:
    return [64 * i // (bits + 1) for i in range(bits + 2)]


def _join_partition(bits: int):
    """Rows (trie, key, pair, fp) in order -> edges (u, v) of a spanning forest."""
    starts = block_starts(bits)

    def edges(trie, key, pair, fp):
        x = _rotate(fp.view(np.uint64), np.array(starts)[trie])
        order = np.lexsort((x, pair, key, trie))
        trie, key, pair, x, fp = (f[order] for f in (trie, key, pair, x, fp))
        new = np.flatnonzero(np.append(True, (trie[1:] != trie[:-1]) | (key[1:] != key[:-1])
                                       | (pair[1:] != pair[:-1])))
        end = np.append(new[1:], len(x))
        width = np.diff(starts)[trie[new]]
        lo, hi, lo2, hi2 = new.copy(), end.copy(), new.copy(), end.copy()
        used = np.zeros(len(new), np.int64)
        depth = width.copy()
        cut = pair[new] >= 0  # children a < b of a cut subtree, or a child with itself
        one, two = pair[new] >> SPLIT, pair[new] & ((1 << SPLIT) - 1)
        cross = np.flatnonzero(cut & (one != two))
        depth[cut] += SPLIT
        for i in cross:  # rows of child a come before rows of child b
            child = (x[new[i]:end[i]] >> np.uint64(64 - int(depth[i]))) & np.uint64((1 << SPLIT) - 1)
            mid = new[i] + int(np.searchsorted(child, two[i]))
            hi[i] = lo2[i] = mid
            used[i] = int(one[i] ^ two[i]).bit_count()
        root = trie_join(x, lo, hi, lo2, hi2, depth, used, bits)
        at = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], ["u", "v"])

    def run(batches):
        held, rows = [], 0
        names = ("trie", "key", "pair", "fp")
        for batch in batches:
            part = [batch.column(n).to_numpy().astype(np.int64) for n in names]
            held.append(part)
            rows += len(part[0])
            if rows >= 1 << 20:  # close at the last change of subtree
                whole = [np.concatenate(c) for c in zip(*held)]
                diff = np.flatnonzero((whole[0][1:] != whole[0][:-1]) | (whole[1][1:] != whole[1][:-1])
                                      | (whole[2][1:] != whole[2][:-1]))
                if len(diff):
                    cut = diff[-1] + 1
                    yield edges(*[w[:cut] for w in whole])
                    held, rows = [[w[cut:] for w in whole]], len(whole[0]) - cut
                else:
                    held = [whole]
        if rows:
            yield edges(*[np.concatenate(c) for c in zip(*held)])
    return run


def links(fps: DataFrame, bits: int = BITS, subtree: int = SUBTREE) -> DataFrame:
    """Edges (u, v) whose components are those of all links between distinct ``fp``."""
    spark = fps.sparkSession
    prepare(spark)
    if not bits:  # distinct fingerprints differ
        return spark.createDataFrame([], "u long, v long")
    starts = block_starts(bits)
    tries = [F.struct(F.lit(i).alias("trie"), F.shiftrightunsigned("fp", 64 - starts[i + 1])
                      .bitwiseAND(F.lit((1 << (starts[i + 1] - starts[i])) - 1)).alias("key"))
             for i in range(bits + 1)]
    rows = fps.select("fp", F.explode(F.array(*tries)).alias("t")).select("fp", "t.trie", "t.key")
    # a subtree with many fingerprints is cut into the node pairs SPLIT levels below
    large = (rows.groupBy("trie", "key").agg(F.count("*").alias("n")).filter(F.col("n") > subtree)
             .select("trie", "key", F.lit(True).alias("large")))
    rotated = F.expr("CASE trie " + " ".join(
        f"WHEN {i} THEN " + (f"(shiftleft(fp, {(starts[i + 1]) % 64}) | shiftrightunsigned(fp, {64 - starts[i + 1]}))"
                             if starts[i + 1] % 64 else "fp") for i in range(bits + 1)) + " END")
    child = F.shiftrightunsigned(rotated, 64 - SPLIT).cast("int")
    near = F.filter(F.sequence(F.lit(0), F.lit((1 << SPLIT) - 1)),
                    lambda o: F.bit_count(o.bitwiseXOR(F.col("child"))) <= bits)
    pairs = F.when(F.col("large"), F.transform(near, lambda o: F.least(o, F.col("child")) * (1 << SPLIT)
                                               + F.greatest(o, F.col("child")))
                   ).otherwise(F.array(F.lit(-1)))
    dealt = (rows.join(large, ["trie", "key"], "left").withColumn("child", child)
             .withColumn("pair", F.explode(pairs)).select("trie", "key", "pair", "fp"))
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (dealt.repartition(n, "trie", "key", "pair").sortWithinPartitions("trie", "key", "pair")
            .mapInArrow(_join_partition(bits), "u long, v long"))


def _grouped(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """(doc_id, body, fp, component_id) of every row, ids not null."""
    found = stored(fingerprints(docs, words), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(distinct.select("fp"), bits))
    member = (distinct.join(roots, distinct["fp"] == roots["id"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    component = member.join(named, "root").select("fp", "root", "component_id")
    return found.join(component, "fp")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """(doc_id, fp long, fingerprint string, component_id long): the component of each
    document under links of at most ``bits`` differing bits, named by its smallest doc_id."""
    return _grouped(docs, words, bits).select(
        id_out().alias("doc_id"), "fp", hex_digits().alias("fingerprint"),
        id_out("component_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one document: the one with
    the smallest (doc_id, text hash), once."""
    groups = _grouped(docs, words, bits)
    kept = (groups.groupBy("root").agg(F.min(F.struct("doc_id", "body")).alias("k"))
            .select(F.col("k.doc_id").alias("__id"), F.col("k.body").alias("__body")))
    rows = docs.withColumns({"__id": id_in(), "__body": F.xxhash64(F.coalesce("text", F.lit("")))})
    same = Window.partitionBy("__id", "__body").orderBy("__id")
    return (rows.join(kept, ["__id", "__body"]).withColumn("__n", F.row_number().over(same))
            .filter("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns]))
