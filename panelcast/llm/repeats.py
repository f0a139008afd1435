"""Windows that also start in a document with a smaller id: the machinery that the
suffix-array dedup (byte windows) and the substring dedup (word windows) share.

A window is ``length`` consecutive symbols of one document. Its anchor is the leftmost of
its ``gram``-symbol grams with the smallest hash (winnowing), so equal windows have equal
anchors at equal offsets. Consecutive windows with one anchor form a run.

0. Documents that equal one with a smaller id are found by digest; all their windows go,
   and they take no part in the other steps.
1. ``block_keys``: each block of documents sends the distinct hashes of its anchors,
   packed as arrays, to buckets of hashes.
2. ``bucket_shared``: a bucket returns to each block the anchors that occur in two documents
   or more. Most text stops here. Anchors of very many blocks are marked hot.
3. ``block_runs``: a block finds its runs with shared anchors, answers the runs that
   equal one of a smaller document in the block itself, and sends the others with their
   text, packed, to the bucket of their anchor. Runs of a hot anchor are cut into single
   windows and go to the buckets of the windows' contents, so that no anchor, line or
   passage fills a task: of equal windows a block sends only one.
4. ``bucket_answers``: a bucket groups equal windows, checks them symbol by symbol, and answers
   each window that a smaller document has.
5. ``removed_mask``: answers meet the texts again, block by block.

The texts are shuffled once: steps 1, 3 and 5 group them alike, in one plan, so Spark
reuses the exchange. Hash collisions in steps 1 and 2 only add runs to check.

Blocks hold whole documents (hash of id); their number follows spark.sql.shuffle.partitions.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, blocks, id_in, prepare, strings

#: Symbols handled at once; longer documents are cut into slices that overlap.
SLICE = 1 << 20
#: An anchor in at least this many blocks is hot.
HOT_BLOCKS = 64

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@dataclass(frozen=True)
class Unit:
    """What a symbol is. ``prepare`` gives the bytes that windows are cut from;
    ``symbols`` their start and end offsets; ``values`` a 64-bit value each."""
    length: int
    gram: int
    words: bool

    def prepare(self, data: bytes) -> bytes:
        return b" ".join(data.split()) if self.words else data

    def symbols(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        if not self.words:
            at = np.arange(len(data) + 1)
            return at[:-1], at[1:]
        if not data:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        return np.append(0, gaps + 1), np.append(gaps, len(data))

    def values(self, data: bytes) -> np.ndarray:
        if self.words:
            words = data.split(b" ") if data else []
            return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        return np.frombuffer(data, np.uint8)

    @property
    def middle(self) -> int:
        """Anchors at this offset or later belong to the late half of the offsets."""
        return (self.length - self.gram + 1) // 2

    def piece(self, late: bool) -> tuple[int, int]:
        """Range round an anchor that lies in every window of a half."""
        if late:
            return -self.middle, self.gram
        return 0, self.length - self.middle + 1

    def grams(self, values: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each gram."""
        k = self.gram
        if len(values) < k:
            return np.zeros(0, np.uint64)
        n = len(values) - k + 1
        if self.words:
            out = np.zeros(n, np.uint64)
            for j in range(k):
                out = out * np.uint64(_BASE) + values[j:j + n]
            return mix(out)
        h, size = values.astype(np.uint64), 1
        while size < 8:  # eight bytes as one number
            h = h[:-size] | (h[size:] << np.uint64(8 * size))
            size *= 2
        out = h[:n] * _M1
        for j in range(8, k, 8):
            out = mix(out) + h[min(j, k - 8):min(j, k - 8) + n] * _M2
        return mix(out)

    def wide(self, data: bytes) -> np.ndarray:
        """Values for polynomial hashes."""
        v = self.values(data)
        return v if self.words else _BYTE_VALUES[v]


BYTES_50 = Unit(50, 16, False)
WORDS_50 = Unit(50, 8, True)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def _slice_runs(unit: Unit, values: np.ndarray, ends: np.ndarray):
    """Runs of concatenated documents: first window, number of windows, offset of the
    anchor from the first window, anchor hash. ends[i]: end of symbol i's document."""
    hashes = unit.grams(values)
    if len(values) < unit.length:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    low = np.uint64((1 << 24) - 1)
    order = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    at = sliding_min(order, unit.length - unit.gram + 1)
    n = len(values) - unit.length + 1
    whole = np.flatnonzero(np.arange(n) + unit.length <= ends[:n])
    anchor = (at[whole] & low).astype(np.int64)
    late = anchor - whole >= unit.middle
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (late[1:] != late[:-1]))) \
        if len(whole) else whole
    first = whole[new]
    count = np.diff(np.append(new, len(whole)))
    return first, count, anchor[new] - first, _piece_hash(unit, hashes, anchor[new], late[new])


def _piece_hash(unit: Unit, hashes: np.ndarray, anchor: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Hash of the symbols round an anchor that all windows of its half hold."""
    key = np.empty(len(anchor), np.uint64)
    for half, (a, b) in ((late, unit.piece(True)), (~late, unit.piece(False))):
        total = np.zeros(int(half.sum()), np.uint64)
        for j in [*range(a, b - unit.gram, unit.gram), b - unit.gram]:
            total = mix(total) + hashes[anchor[half] + j]
        key[half] = mix(total * _M1 + np.uint64(b))
    return key


def runs(unit: Unit, values: list[np.ndarray]):
    """Runs of a list of documents: document index, first window, number of windows,
    offset of the anchor, anchor hash."""
    out, held, total = [], [], 0

    def flush():
        lengths = np.array([len(v) for _, _, v in held])
        stops = np.cumsum(lengths)
        starts = stops - lengths
        first, count, offset, key = _slice_runs(unit, np.concatenate([v for _, _, v in held]),
                                                np.repeat(stops, lengths))
        which = np.searchsorted(stops, first, "right")
        doc = np.array([d for d, _, _ in held])[which]
        out.append((doc, first - starts[which] + np.array([s for _, s, _ in held])[which],
                    count, offset, key))

    for d, v in enumerate(values):
        for s in range(0, max(1, len(v) - unit.length + 1), SLICE):
            held.append((d, s, v[s:s + SLICE + unit.length - 1]))
            total += len(held[-1][2])
            if total >= SLICE:
                flush()
                held, total = [], 0
    if held:
        flush()
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


class Polynomial:
    """Prefix polynomial hashes modulo 2^64; equal slices have equal ``of``."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        powers = self._powers(_BASE, n + 1)
        np.cumsum(values * powers[:n], out=self.prefix[1:])
        self.inverse = self._powers(pow(_BASE, -1, 1 << 64), n + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        size = 1
        while size < n:  # b^0..b^(s-1), then times b^s
            m = min(size, n - size)
            out[size:size + m] = out[:m] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
        return out

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i]+1, ... count[i] numbers each, joined."""
    total = int(count.sum())
    step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + step


# ------------------------------------------------------------------ steps in tasks
def ordered(docs: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids and texts of a block in a fixed order (id, text), and the order."""
    ids = docs.column("doc_id").to_pylist()
    data = strings(docs.column("text").combine_chunks())
    order = sorted(range(len(ids)), key=lambda i: (ids[i], data[i]))
    return np.array([ids[i] for i in order], np.int64), [data[i] for i in order], np.array(order, np.int64)


def _pack(x: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _codes(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 more bits of an anchor hash, as one number."""
    return ((key % np.uint64(buckets)) << np.uint64(32)) | (key >> np.uint64(32))


KEYS = "bucket int, block int, keys binary, several binary"


def _copied(ids: np.ndarray, data: list[bytes], copies: pa.Table) -> np.ndarray:
    """Documents of a block that are a copy of a smaller one."""
    listed = set(zip(copies.column("copy").to_pylist(), copies.column("keys").to_pylist()))
    some = {i for i, _ in listed}
    return np.array([i in some and (i, hashlib.md5(d).digest()) in listed
                     for i, d in zip(ids.tolist(), data)], bool)


def block_keys(unit: Unit, buckets: int, block: int, docs: pa.Table, copies: pa.Table) -> pa.Table:
    ids, data, _ = ordered(docs)
    copied = _copied(ids, data, copies)
    doc, _, _, _, key = runs(unit, [unit.values(unit.prepare(d)) for d, c in zip(data, copied) if not c])
    code = _codes(key, buckets)
    order = np.lexsort((doc, code))
    code, doc = code[order], doc[order]
    new = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
    last = np.append(new[1:], len(code)) - 1 if len(new) else new
    several = doc[new] != doc[last]
    code = code[new]
    bucket = (code >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(code) else new
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(code))):
        rows.append((int(bucket[a]), block, _pack(code[a:b], "<u4"), _pack(several[a:b], "u1")))
    return pa.table([pa.array(c, t) for c, t in zip(
        zip(*rows) if rows else [[]] * 4, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
        names=["bucket", "block", "keys", "several"])


SHARED = "block int, bucket int, keys binary, hot binary, copy long"


def bucket_shared(bucket: int, sent: pa.Table) -> pa.Table:
    keys = [np.frombuffer(x, "<u4") for x in sent.column("keys").to_pylist()]
    block = sent.column("block").to_pylist()
    several = np.concatenate([np.frombuffer(x, "u1") for x in sent.column("several").to_pylist()])
    allk = np.concatenate(keys)
    values, where, n = np.unique(allk, return_inverse=True, return_counts=True)
    multi = np.bincount(where, several, len(values)) > 0
    shared, hot = (n > 1) | multi, n >= HOT_BLOCKS
    rows, at = [], 0
    for b, k in zip(block, keys):
        w = where[at:at + len(k)]
        at += len(k)
        keep = shared[w]
        if keep.any():
            rows.append((b, bucket, _pack(k[keep], "<u4"), _pack(hot[w][keep], "u1"), None))
    return pa.table([pa.array(c, t) for c, t in zip(
        zip(*rows) if rows else [[]] * 5, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))],
        names=["block", "bucket", "keys", "hot", "copy"])


#: Runs on their way: arrays packed in one row for each (block, bucket) pair. ``done_*``
#: are answers a block found itself, which only travel through.
SENT = ("bucket int, block int, key binary, doc binary, row binary, first binary, "
        "count binary, offset binary, size binary, text binary, done binary")
DONE = np.dtype([("row", "<u4"), ("first", "<u8"), ("count", "<u4")])


def _done(row, first, count) -> np.ndarray:
    out = np.empty(len(row), DONE)
    out["row"], out["first"], out["count"] = row, first, count
    return out


def _same(data: list[bytes], where, start, end, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the slices a[i] and b[i] hold equal bytes, for all i."""
    w, s, e = where.tolist(), start.tolist(), end.tolist()
    return all(data[w[i]][s[i]:e[i]] == data[w[j]][s[j]:e[j]] for i, j in zip(a.tolist(), b.tolist()))


def equal_runs(key, offset, count, content, doc, data, where, start, end):
    """Leader of each run's class of equal runs: the one with the smallest document."""
    order = np.lexsort((doc, content, count, offset, key))
    k = [x[order] for x in (content, count, offset, key)]
    new = np.append(True, np.any([x[1:] != x[:-1] for x in k], axis=0)) if len(order) else np.zeros(0, bool)
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else leader
    rest = np.flatnonzero(leader != np.arange(len(leader)))
    if not _same(data, where, start, end, rest, leader[rest]):  # a hash collision: by content
        seen: dict = {}
        for i in order.tolist():
            t = (key[i], offset[i], count[i], data[where[i]][start[i]:end[i]])
            leader[i] = seen.setdefault(t, i)
    return leader


def block_runs(unit: Unit, buckets: int, block: int, docs: pa.Table, shared: pa.Table) -> pa.Table:
    names = [f.split()[0] for f in SENT.split(", ")]
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 9
    empty = pa.table([pa.array([], t) for t in kinds], names=names)
    if not len(docs) or not len(shared):
        return empty
    ids, data, _ = ordered(docs)
    copied = _copied(ids, data, shared.filter(pc.is_valid(shared.column("copy"))))
    shared = shared.filter(pc.is_null(shared.column("copy")))
    data = [unit.prepare(d) for d in data]
    doc, first, count, offset, key = runs(unit, [unit.values(d if not c else b"") for d, c in zip(data, copied)])
    # of a copy every window is answered
    windows = np.array([len(unit.symbols(d)[0]) - unit.length + 1 if c else 0 for d, c in zip(data, copied)], np.int64)
    at = np.flatnonzero(windows > 0)
    done = [_done(at, np.zeros(len(at), np.int64), windows[at])]
    none = np.zeros(1, np.uint64)  # no hash has bucket and bits 0 by the mixing, or it is checked in vain
    want = np.concatenate([none, *(np.frombuffer(k, "<u4").astype(np.uint64) | np.uint64(b << 32) for b, k in zip(
        shared.column("bucket").to_pylist(), shared.column("keys").to_pylist()))])
    hot = np.concatenate([none.astype("u1"), *(np.frombuffer(k, "u1") for k in shared.column("hot").to_pylist())])
    order = np.argsort(want)
    want, hot = want[order], hot[order]
    code = _codes(key, buckets)
    at = np.minimum(np.searchsorted(want, code), len(want) - 1)
    take = want[at] == code
    hot = hot[at][take] > 0
    doc, first, count, offset, key = (x[take] for x in (doc, first, count, offset, key))
    # the text of each run
    start, end = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    for d in np.unique(doc):
        s, e = unit.symbols(data[d])
        own = slice(*np.searchsorted(doc, [d, d + 1]))
        start[own], end[own] = s[first[own]], e[first[own] + count[own] + unit.length - 2]

    def content():
        return np.fromiter((xxhash.xxh3_64_intdigest(data[d][s:e]) for d, s, e in zip(
            doc.tolist(), start.tolist(), end.tolist())), np.uint64, len(doc))

    body = content()

    def keep_leaders():
        """Runs that equal one of a smaller document are answered; repeats go."""
        nonlocal doc, first, count, offset, key, start, end, hot, body
        leader = equal_runs(key, offset, count, body, ids[doc], data, doc, start, end)
        answered = ids[doc] > ids[doc[leader]]
        done.append(_done(doc[answered], first[answered], count[answered]))
        doc, first, count, offset, key, start, end, hot, body = (
            x[~answered] for x in (doc, first, count, offset, key, start, end, hot, body))

    keep_leaders()
    if hot.any():  # cut into single windows
        h = np.flatnonzero(hot)
        n = count[h]
        one = spread(first[h], n)
        cut = [np.repeat(x[h], n) for x in (doc, offset, key)]
        cut[1] = cut[1] - (one - np.repeat(first[h], n))
        s1, e1 = np.empty(len(one), np.int64), np.empty(len(one), np.int64)
        for d in np.unique(cut[0]):
            s, e = unit.symbols(data[d])
            own = np.flatnonzero(cut[0] == d)
            s1[own], e1[own] = s[one[own]], e[one[own] + unit.length - 1]
        cool = ~hot
        doc = np.append(doc[cool], cut[0])
        offset, key = np.append(offset[cool], cut[1]), np.append(key[cool], cut[2])
        first, count = np.append(first[cool], one), np.append(count[cool], np.ones(len(one), np.int64))
        start, end = np.append(start[cool], s1), np.append(end[cool], e1)
        hot = np.append(np.zeros(cool.sum(), bool), np.ones(len(one), bool))
        body = content()
        keep_leaders()
    bucket = (np.where(hot, mix(body ^ key), key) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    doc, first, count, offset, key, start, end, bucket = (
        x[order] for x in (doc, first, count, offset, key, start, end, bucket))
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
        text = b"".join(data[d][s:e] for d, s, e in zip(doc[a:b].tolist(), start[a:b].tolist(), end[a:b].tolist()))
        rows.append((int(bucket[a]), block, _pack(key[a:b], "<u8"), *map(_squeeze, (
            _pack(ids[doc[a:b]], "<i8"), _pack(doc[a:b], "<u4"), _pack(first[a:b], "<u8"),
            _pack(count[a:b], "<u4"), _pack(offset[a:b], "<u2"), _pack(end[a:b] - start[a:b], "<u4"), text)), None))
    found = np.concatenate(done)
    if len(found):
        rows.append((block % buckets, block, *[b""] * 8, found.tobytes()))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names) if rows else empty


ANSWER = "block int, done binary"
Classes = Callable[["Unit", np.ndarray, np.ndarray, Polynomial, np.ndarray, np.ndarray], np.ndarray]


def bucket_answers(unit: Unit, classes: Classes, sent: pa.Table) -> pa.Table:
    """Windows of the sent runs that a smaller document has, by block."""
    out = list(zip(sent.column("block").to_pylist(), sent.column("done").to_pylist()))
    out = [(b, np.frombuffer(d, DONE)) for b, d in out if d]
    got = {n: [_expand(x) if x else b"" for x in sent.column(n).to_pylist()] for n in
           ("doc", "row", "first", "count", "offset", "size", "text")}
    got["key"] = [x or b"" for x in sent.column("key").to_pylist()]
    arrays = {n: np.concatenate([np.frombuffer(x, t) for x in got[n]]) for n, t in (
        ("key", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("first", "<u8"), ("count", "<u4"),
        ("offset", "<u2"), ("size", "<u4"))}
    per = np.array([len(x) // 8 for x in got["key"]])
    block = np.repeat(np.array(sent.column("block").to_pylist(), np.int64), per)
    key, doc = arrays["key"], arrays["doc"]
    count, offset = arrays["count"].astype(np.int64), arrays["offset"].astype(np.int64)
    size = arrays["size"].astype(np.int64)
    if len(key):
        text = b"".join(got["text"])
        end = np.cumsum(size)
        start = end - size
        one = np.zeros(len(key), np.int64)
        body = np.fromiter((xxhash.xxh3_64_intdigest(text[s:e]) for s, e in zip(
            start.tolist(), end.tolist())), np.uint64, len(key))
        leader = equal_runs(key, offset, count, body, doc, [text], one, start, end)
        whole = doc > doc[leader]  # every window of it is also in its leader's document
        # windows of one run for each class, where runs of one anchor differ
        lead = np.flatnonzero(leader == np.arange(len(key)))
        k, n = np.unique(key[lead], return_counts=True)
        lead = lead[n[np.searchsorted(k, key[lead])] > 1]
        covered = _covered(unit, classes, text, start, end, key, offset, count, doc, lead)
        # runs of the leader's own document have the leader's answers
        first = arrays["first"].astype(np.int64)
        for b, r, f, c in _answers(covered, lead, leader, whole, block, arrays["row"], first, count):
            out.append((b, _done(r, f, c)))
    rows = [(int(b), d.tobytes()) for b, d in out if len(d)]
    return pa.table([pa.array(c, t) for c, t in zip(
        zip(*rows) if rows else [[]] * 2, (pa.int32(), pa.binary()))], names=["block", "done"])


def _covered(unit, classes, text, start, end, key, offset, count, doc, lead) -> np.ndarray:
    """For each window of the runs ``lead``: whether a smaller document has it. Anchors are
    taken together up to about SLICE symbols."""
    out = np.zeros(int(count[lead].sum()), bool)
    at = np.cumsum(count[lead]) - count[lead]
    order = np.argsort(key[lead], kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(key[lead][order]) != 0)) if len(lead) else order
    total = np.append(0, np.cumsum(count[lead][order] + unit.length))
    a = 0
    while a < len(lead):
        b = new[np.searchsorted(new, np.searchsorted(total, total[a] + SLICE)):]
        b = int(b[0]) if len(b) and b[0] > a else len(lead)
        part = order[a:b]
        out[spread(at[part], count[lead[part]])] = _covered_part(
            unit, classes, text, start, end, key, offset, count, doc, lead[part])
        a = b
    return out


def _covered_part(unit, classes, text, start, end, key, offset, count, doc, lead) -> np.ndarray:
    data = (b" " if unit.words else b"").join(
        text[s:e] for s, e in zip(start[lead].tolist(), end[lead].tolist()))
    symbols = count[lead] + unit.length - 1
    at = np.cumsum(symbols) - symbols
    window = spread(at, count[lead])
    step = window - np.repeat(at, count[lead])
    which = np.repeat(np.arange(len(lead)), count[lead])
    _, group = np.unique(key[lead], return_inverse=True)
    group = group[which] * (unit.length + 1) + offset[lead][which] - step
    own = doc[lead][which]
    # only windows that meet another one at the same anchor and offset
    order = np.argsort(group, kind="stable")
    g = group[order]
    alone = np.append(True, g[1:] != g[:-1]) & np.append(g[1:] != g[:-1], True)
    meet = order[~alone]
    out = np.zeros(len(window), bool)
    if len(meet):
        cls = classes(unit, group[meet], window[meet], Polynomial(unit.wide(data)),
                      data, unit.symbols(data))
        least = np.full(cls.max() + 1, NULL_ID)
        np.minimum.at(least, cls, own[meet])
        out[meet] = own[meet] > least[cls]
    return out


def _answers(covered, lead, leader, whole, block, row, first, count):
    """Covered windows of all runs, as runs, for each block."""
    parts = [(np.flatnonzero(whole), first[whole], count[whole])]
    if covered.any():
        at = np.cumsum(count[lead]) - count[lead]
        step = np.arange(len(covered)) - np.repeat(at, count[lead])
        edge = np.append(0, covered.view(np.int8))
        begin = np.flatnonzero(covered & ((edge[:-1] == 0) | (step == 0)))
        stop = np.flatnonzero(covered & np.append((edge[2:] == 0) | (step[1:] == 0), True))
        run = np.repeat(np.arange(len(lead)), count[lead])[begin]
        # the leader and the other runs of its document
        same = np.flatnonzero(~whole)
        same = same[np.isin(leader[same], lead)]
        same = same[np.argsort(leader[same], kind="stable")]
        lo = np.searchsorted(leader[same], lead[run], "left")
        hi = np.searchsorted(leader[same], lead[run], "right")
        member = same[spread(lo, hi - lo)]
        n = hi - lo
        parts.append((member, first[member] + np.repeat(step[begin], n), np.repeat(stop - begin + 1, n)))
    i, f, c = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(block[i], kind="stable")
    i, f, c = i[order], f[order], c[order]
    b = block[i]
    cuts = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else b
    for x, y in zip(cuts, np.append(cuts[1:], len(b))):
        yield b[x], row[i[x:y]], f[x:y], c[x:y]


def by_hash(unit, group, window, poly, data, at) -> np.ndarray:
    """Classes of equal windows within a group: equal hashes, then equal bytes."""
    h = poly.of(window, unit.length)
    order = np.lexsort((h, group))
    new = np.append(True, (group[order][1:] != group[order][:-1]) | (h[order][1:] != h[order][:-1]))
    cls = np.empty(len(order), np.int64)
    cls[order] = np.cumsum(new) - 1
    return checked(unit, group, window, data, at, cls, order[new])


def checked(unit, group, window, data, at, cls, leaders) -> np.ndarray:
    """The classes if every window holds its leader's bytes, else classes by the bytes."""
    s, e = at[0][window].tolist(), at[1][window + unit.length - 1].tolist()
    lead = leaders[cls].tolist()
    if all(data[s[i]:e[i]] == data[s[j]:e[j]] for i, j in enumerate(lead) if i != j):
        return cls
    seen: dict = {}
    return np.array([seen.setdefault((g, data[a:b]), len(seen)) for g, a, b in zip(group.tolist(), s, e)])


# ------------------------------------------------------------------ Spark plan
def removed_windows(docs: DataFrame, unit: Unit, classes: Classes,
                    finish: Callable[[Unit, pa.Table, pa.Table], pa.Table], schema: str,
                    carry: list[str] | None = None) -> DataFrame:
    """Run the steps over (doc_id, text) and hand each block's documents and answers to
    ``finish``. ``carry``: further columns that ``finish`` finds as struct ``carry``."""
    spark = docs.sparkSession
    prepare(spark)
    n, buckets = blocks(spark), blocks(spark, 1)
    extra = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carry")] if carry else []
    rows = docs.select(id_in().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)
    block = F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block")
    rows = rows.withColumn("block", block)

    # copies of a smaller document: all their windows are removed without a look
    whole = rows.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("keys"))
    least = whole.groupBy("keys").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    copies = (whole.join(least, "keys").filter("doc_id > least").select(
        block, F.lit(-1).alias("bucket"), "keys", F.lit(None).cast("binary").alias("hot"), F.col("doc_id").alias("copy")))

    # a group's function gets its key as a tuple of Arrow scalars
    keys = rows.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(
        lambda k, t, c: block_keys(unit, buckets, k[0].as_py(), t, c), KEYS)
    shared = keys.groupBy("bucket").applyInArrow(lambda k, t: bucket_shared(k[0].as_py(), t), SHARED)
    sent = rows.groupBy("block").cogroup(shared.union(copies).groupBy("block")).applyInArrow(
        lambda k, a, b: block_runs(unit, buckets, k[0].as_py(), a, b), SENT)
    answers = sent.groupBy("bucket").applyInArrow(lambda k, t: bucket_answers(unit, classes, t), ANSWER)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda k, a, b: finish(unit, a, b), schema)


def removed_mask(unit: Unit, lengths: np.ndarray, answers: pa.Table) -> np.ndarray:
    """For each symbol of a block's documents in order: whether a window covers it."""
    starts = np.cumsum(lengths) - lengths
    edge = np.zeros(int(lengths.sum()) + 1, np.int64)
    for d in answers.column("done").to_pylist():
        done = np.frombuffer(d, DONE)
        a = starts[done["row"]] + done["first"].astype(np.int64)
        np.add.at(edge, a, 1)
        np.add.at(edge, a + done["count"] + unit.length - 1, -1)
    return np.cumsum(edge[:-1]) > 0
