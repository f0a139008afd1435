"""SimHash near-dedup, line dedup, window dedups against brute force."""
from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
from collections import defaultdict
from urllib.parse import urlparse

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from panelcast.llm import components, line_dedup, repeats, simhash, substring_dedup, suffix_dedup
from .conftest import BIG, frame, known, shown, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# ------------------------------------------------------------------ SimHash
def brute_simhash(features) -> int:
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in features]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_fingerprint(text: str) -> int:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not w:
        return 0
    return brute_simhash([" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)])


def brute_components(ids, fps, bits):
    u = Union(len(ids))
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                u.join(i, j)
    least = {}
    for i, d in enumerate(ids):
        least[u.find(i)] = min(least.get(u.find(i), BIG), d)
    return [least[u.find(i)] for i in range(len(ids))]


def test_simhash_components(docs, rows, no_docs):
    own = known(rows)
    fps = [brute_fingerprint(t) for _, t in own]
    comp = brute_components([i for i, _ in own], fps, 3)
    want = sorted((i, f"{f:016x}", c) for (i, _), f, c in zip(own, fps, comp))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((BIG if r.doc_id is None else r.doc_id, r.fingerprint,
                   BIG if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group(docs, rows, no_docs):
    own = known(rows)
    comp = brute_components([i for i, _ in own], [brute_fingerprint(t) for _, t in own], 3)
    kept = simhash.one_of_each(docs).collect()
    assert kept[0].asDict().keys() == set(docs.columns)
    assert len(kept) == len(set(comp))
    assert {BIG if r.doc_id is None else r.doc_id for r in kept} == set(comp)
    assert simhash.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("subtree", [1 << 16, 3])
@pytest.mark.parametrize("bits", [0, 3, 5])
def test_trie_join_finds_all_links(spark, bits, subtree):
    """Clusters round a few centres, so that whole subtrees are cut when ``subtree`` is small."""
    rng = random.Random(bits)
    fps = {0, 1, 2**64 - 1, 2**63}
    for _ in range(25):
        centre = rng.getrandbits(64) if rng.random() < 0.5 else rng.getrandbits(20) << 30
        for _ in range(10):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 8))))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = {r.id % 2**64: r.root % 2**64 for r in
           components.connected_components(simhash.links(df, bits, subtree)).collect()}
    want = brute_components(list(range(len(fps))), fps, bits)
    parts = defaultdict(set)
    for i, f in enumerate(fps):
        parts[want[i]].add(f)
    have = defaultdict(set)
    for f in fps:
        have[got.get(f, f)].add(f)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, have.values()))


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)]
    edges += [(5000, 5000), (None, 3), (2000, 2001), (2001, 2000)]
    rng.shuffle(edges)
    got = {r.id: r.root for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 40)}, 2001: 2000}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ lines
def edits(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def line_fingerprint(words):
    """A number for lines of short words only is as good as any other that is not shared."""
    long = [w for w in words if len(w) >= 4]
    return brute_simhash(long) if long else xxhash.xxh64_intdigest(" ".join(words).encode(), 1)


def spark_hash(*values):
    """XXH64 over a row as Spark takes it: each value's hash seeds the next; strings as UTF-8,
    64-bit numbers as 8 bytes, Python ints as 4."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v.tobytes() if isinstance(v, np.int64) else v.to_bytes(4, "little")
        h = xxhash.xxh64_intdigest(raw, h)
    return np.uint64(h).astype(np.int64)


def line_minima(words):
    """Low halves of the minimum hashes, None for a line without units."""
    whole = " ".join(words)
    units = ([whole[i:i + line_dedup.GRAM] for i in range(max(len(whole) - line_dedup.GRAM + 1, 1))]
             if len(words) <= line_dedup.FEW else [w for w in words if len(w) >= line_dedup.SHORT])
    hashes = {spark_hash(u) for u in units}
    return [min(spark_hash(h, k) for h in hashes) & 0xFFFFFFFF for k in range(line_dedup.MINIMA)] if hashes else None


def brute_lines(own, sketch=False):
    """(n_lines, n_removed, text) for each row. ``sketch``: candidates by bands of minimum
    hashes too, as the query and the pipeline have them."""
    def split(t):
        return [tuple(w for w in regex.split(r"[^\p{L}\p{N}]+", x.lower()) if w) for x in t.split("\n")]
    lines = sorted({w for _, t in own for w in split(t) if w})
    at = {w: n for n, w in enumerate(lines)}
    fp = [line_fingerprint(w) for w in lines]
    pairs = {(j, i) for i in range(len(lines)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3}
    if sketch:
        buckets = defaultdict(list)
        for i, w in enumerate(lines):
            minima = line_minima(w)
            for k, band in enumerate(line_dedup._bands() if minima else ()):
                buckets[k, *(minima[x] for x in band)].append(i)
        low = [[m & 255 for m in line_minima(w) or ()] for w in lines]
        pairs |= {(i, j) for own_ in buckets.values() for i, j in itertools.combinations(own_, 2)
                  if sum(x == y for x, y in zip(low[i], low[j])) >= line_dedup.AGREE}
    u = Union(len(lines))
    for i, j in pairs:
        a, b = " ".join(lines[i]), " ".join(lines[j])
        most = int(max(len(a), len(b)) * 0.2 + 1e-9)
        if abs(len(a) - len(b)) <= most and u.find(i) != u.find(j) and edits(a, b) <= most:
            u.join(i, j)
    least = defaultdict(lambda: BIG + 1)
    for d, t in own:
        for w in split(t):
            if w:
                g = u.find(at[w])
                least[g] = min(least[g], d)
    out = []
    for d, t in own:
        seen, kept, parts = set(), [], t.split("\n")
        for x, w in zip(parts, split(t)):
            g = u.find(at[w]) if w else None
            if g is None or (d == least[g] and g not in seen):
                kept.append(x)
            seen.add(g)
        out.append((shown(d), len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    rng = random.Random(4)
    base = [words(rng, 30) for _ in range(6)]
    rows = []
    for i in range(40):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(30)] = rng.choice(["other", "Words", "here"])
        rows.append((i, "\n".join([" ".join(w), "Common line.", "", "common  LINE", " ".join(words(rng, 5))])))
    long_line = words(rng, 40000)
    return rows + [(50, " ".join(long_line)), (51, " ".join(long_line) + " end"), (52, " ".join(words(rng, 200)))]


def test_line_dedup(spark, docs, rows, no_docs):
    assert line_dedup.line_dedup(no_docs).count() == 0
    for df, own in ((docs, known(rows)), (frame(spark, r := line_rows()[:40]), known(r))):
        got = [tuple(r) for r in line_dedup.line_dedup(df).collect()]
        assert sorted(got, key=str) == sorted(brute_lines(own), key=str)


def test_line_dedup_as_registered(spark, docs, rows):
    """The mode of the query and the pipeline."""
    for df, own in ((docs, known(rows)), (frame(spark, r := line_rows()[:25]), known(r))):
        got = [tuple(r) for r in line_dedup.line_dedup(df, sketch=True).collect()]
        assert sorted(got, key=str) == sorted(brute_lines(own, sketch=True), key=str)


def test_line_pairs_of_linked_copies(spark, monkeypatch):
    """Copies whose buckets all have the same, unlike frequent line are linked by a pivot, and
    not compared each with each. The one long word makes all lines candidates of all."""
    rng = random.Random(9)

    def short():
        return "".join(rng.choice("abcdefghij") for _ in range(3))
    base = [short() for _ in range(30)]
    rows = [(i, " ".join(["something", *([short()] + base[1:])])) for i in range(40)]
    frequent = " ".join(["something", *(short() for _ in range(30))])
    rows += [(40 + i, frequent) for i in range(3)]
    counts, verified = [], line_dedup._verified

    def counting(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)
    monkeypatch.setattr(line_dedup, "_verified", counting)
    got = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(frame(spark, rows), sketch=True).collect()}
    assert got == {i: int(i not in (0, 40)) for i in range(43)}
    assert sum(counts) < 200, counts


def test_line_tables_are_discarded(spark, monkeypatch):
    """Tables with every line's minima, and those of each round of keys, go when they have been
    read, so that only narrow tables lie beside the texts that are shuffled."""
    made, stored = [], line_dedup.stored

    def noting(df, name):
        made.append((name, stored(df, name)))
        return made[-1][1]
    monkeypatch.setattr(line_dedup, "stored", noting)
    df = frame(spark, r := line_rows()[:25])
    got = [tuple(r) for r in line_dedup.line_dedup(df, sketch=True).collect()]
    assert sorted(got, key=str) == sorted(brute_lines(known(r), sketch=True), key=str)
    left = [(n, t) for n, t in made if any(os.path.exists(urlparse(f).path) for f in t.inputFiles())]
    assert len(left) < len(made)
    assert not [n for n, t in left if "g0" in t.columns or n in ("line-keys", "line-shared")]


def test_line_keys_are_shuffled_once(spark, monkeypatch):
    """Lines of a key are counted where they meet: one table for KEYS keys, which is not joined
    with the keys again."""
    names, stored = [], line_dedup.stored

    def noting(df, name):
        names.append(name)
        if name == "line-shared":
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Window" in plan
        return stored(df, name)
    monkeypatch.setattr(line_dedup, "stored", noting)
    df = frame(spark, r := line_rows()[:25])
    got = [tuple(r) for r in line_dedup.line_dedup(df, sketch=True).collect()]
    assert sorted(got, key=str) == sorted(brute_lines(known(r), sketch=True), key=str)
    keys = len(list(itertools.combinations(range(line_dedup.BITS + 2), 2))) + len(line_dedup._bands())
    assert names.count("line-shared") == keys // line_dedup.KEYS and "line-keys" not in names


def test_line_minima_by_steps(spark):
    """Words are hashed some at a time: lines around the bounds of steps and chunks, and lines
    of few, short or no words. The text is read once for short and long lines."""
    counts = sorted({n + d for n in (line_dedup.STEP, line_dedup.FEW, line_dedup.CHUNK, 2 * line_dedup.CHUNK) for d in (-1, 0, 1)})
    cases = [[f"w{i}x{n}" for i in range(n)] for n in counts]
    cases += [["of", "a"], ["of"] * 300, ["ab"], ["of", "something"] * 70, ["é漢"], []]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(cases)], "doc_id long, text string")
    out = line_dedup.occurrences(df, sketch=True)
    got = {r.doc_id: r for r in out.collect()}
    for i, w in enumerate(cases):
        want = line_minima(w) if w else None
        packed = [got[i][f"g{k}"] for k in range(line_dedup.MINIMA // 2)]
        halves = [h & 0xFFFFFFFF for g in packed for h in (g >> 32, g)] if packed[0] is not None else None
        assert halves == want, w
        if want:
            low = b"".join((got[i][d] % 2**64).to_bytes(8, "little") for d in ("d0", "d1"))
            assert list(low) == [m & 255 for m in want]
        if w and max(map(len, w)) >= line_dedup.SHORT:
            assert got[i].fp % 2**64 == line_fingerprint(w), w
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.partition("== Initial Plan ==")[0]
    assert final.count("LocalTableScan") + final.count("Scan ExistingRDD") <= 1, final


def test_line_distance_from_either_end(spark):
    """Lines that differ at their start, their end, both or in the middle, with and without the
    walk: always the plain edit distance."""
    rng = random.Random(12)
    rows = []
    for n in (20, 60, 150):
        for i in range(16):
            a = words(rng, n, 90)
            b = list(a)
            for at in [(0,), (n - 1,), (0, n - 1), (n // 2,)][i % 4]:
                new = words(rng, max(1, n * rng.choice([2, 10, 30]) // 100), 90)
                b[at:at + len(new)] = new
            rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    most = line_dedup.most_edits(F.length("a"), F.length("b"), 0.8)
    got = df.select((F.levenshtein("a", "b") <= most).alias("want"),
                    line_dedup._within_from_worse_end(F.col("a"), F.col("b"), most).alias("end"),
                    line_dedup.similar(F.col("a"), F.col("b"), 0.8, False).alias("exact"),
                    line_dedup.similar(F.col("a"), F.col("b"), 0.8).alias("walked")).collect()
    assert len({r.want for r in got}) == 2 and all(r.want == r.end == r.exact == r.walked for r in got)


def test_line_walk_is_an_upper_bound(spark):
    """Near copies with lost, new and changed words pass, and none that is too far apart."""
    rng = random.Random(5)
    rows = []
    for _ in range(80):
        a = words(rng, 60, 90)
        b = list(a)
        for _ in range(rng.choice([1, 3, 10, 25])):
            at = rng.randrange(len(b))
            b[at:at + 1] = rng.choice([[], ["other"], [b[at], "new"]])
        rows.append((" ".join(a), " ".join(b)))
    rows += [("", ""), ("a", ""), ("", "a"), ("a b", "b a"), ("é" * 99, "é" * 99)]
    df = spark.createDataFrame(rows, "a string, b string")
    most = line_dedup.most_edits(F.length("a"), F.length("b"), 0.8)
    got = df.select(line_dedup._word_by_word(F.col("a"), F.col("b"), most).alias("walk"),
                    (F.levenshtein("a", "b") <= most).alias("near")).collect()
    assert not [r for r in got if r.walk and not r.near]
    assert sum(r.walk for r in got) > 0.7 * sum(r.near for r in got) > 0 and not all(r.near for r in got)


def test_line_simhash(spark):
    """Lines of one word to very many words."""
    rng = random.Random(8)
    cases = [[f"w{i}x{n}" for i in range(n)] for n in (1, 2, 126, 127, 128, 129, 3000, 40000)]
    cases += [["same"] * 200, ["of", "a", "of"], words(rng, 500, 90)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(cases)], "doc_id long, text string")
    got = line_dedup.occurrences(df).collect()
    want = {i: brute_simhash(w) for i, w in enumerate([[x for x in c if len(x) >= 4] for c in cases]) if w}
    assert len(got) == len(cases) and {r.doc_id: r.fp % 2**64 for r in got if r.doc_id in want} == want
    assert all(r.fp == r.id for r in got if r.doc_id not in want)


def test_line_groups_of_near_copies(spark):
    rows = line_rows()
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got[50].n_removed == 0 and got[51].n_removed == 1 and got[52].n_removed == 0


def test_line_typos_by_characters(spark):
    """Typos in two of five words, and lines of two words, by the character edit similarity."""
    rows = [(0, "international conference programme committee announcement\nannual report\nalpha"),
            (1, "internationel conference programm committee announcement"), (2, "annual reports"),
            (3, "annual budget"), (4, "beta")]
    got = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(frame(spark, rows), sketch=True).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0}


def near_pairs(rng, n, change):
    """Lines of n words, each with a copy in which a fifth of the characters' worth of
    words (``change`` of them) is replaced by words as long."""
    for _ in range(40):
        a = [f"{rng.getrandbits(24):06x}" for _ in range(n)]
        b = list(a)
        for i in rng.sample(range(n), change):
            b[i] = f"{rng.getrandbits(24):06x}"
        yield " ".join(a), " ".join(b)


@pytest.mark.parametrize("n, change", [(8, 1), (20, 1), (20, 3), (40, 7), (80, 15)])
def test_line_recall(spark, n, change):
    """Against brute force without a filter of bits: every pair is similar enough."""
    pairs = list(near_pairs(random.Random(n + change), n, change))
    assert all(edits(a, b) <= 0.2 * len(a) for a, b in pairs[:5])
    rows = [(2 * k + j, t) for k, p in enumerate(pairs) for j, t in enumerate(p)]
    got = line_dedup.line_dedup(frame(spark, rows), sketch=True).agg({"n_removed": "sum"}).first()[0]
    print(f"recall of {change} in {n} words: {got / len(pairs):.3f}")
    assert got >= 0.9 * len(pairs)


def test_equal_bytes(spark):
    rng = random.Random(6)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(50)]
    pairs += [(a, a ^ (rng.choice([1, 128, 255]) << 8 * rng.randrange(7))) for a, _ in pairs] + [(-1, 0), (-1, -1), (0, -256), (-1 << 63, 0)]
    got = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", line_dedup.equal_bytes(F.col("a").bitwiseXOR(F.col("b"))).alias("n")).collect()
    assert all(r.n == sum(x == y for x, y in zip(np.int64(r.a).tobytes(), np.int64(r.b).tobytes())) for r in got)


def test_line_dedup_is_native(docs, capsys):
    line_dedup.line_dedup(docs).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


# ------------------------------------------------------------------ windows
def brute_windows(units, length):
    """Mask of covered symbols for each (id, symbols)."""
    first = {}
    for d, u in units:
        for i in range(len(u) - length + 1):
            w = tuple(u[i:i + length])
            first[w] = min(first.get(w, BIG + 1), d)
    out = []
    for d, u in units:
        gone = [False] * len(u)
        for i in range(len(u) - length + 1):
            if first[tuple(u[i:i + length])] < d:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def spans(mask):
    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.array(mask, np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def test_suffix_dedup(docs, rows, no_docs):
    own = known(rows)
    masks = brute_windows([(d, t.encode()) for d, t in own], 50)
    want = [(str(shown(d)), len(m), spans(m), bytes(b for b, g in zip(t.encode(), m) if not g))
            for (d, t), m in zip(own, masks)]
    got = [(str(r.doc_id), r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept))
           for r in suffix_dedup.suffix_dedup(docs).collect()]
    assert sorted(got) == sorted(want)
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


def test_substring_dedup(docs, rows, no_docs):
    own = [(d, [w.decode() for w in t.encode().split()]) for d, t in known(rows)]
    masks = brute_windows(own, 50)
    want = [(str(shown(d)), len(w), spans(m), " ".join(x for x, g in zip(w, m) if not g))
            for (d, w), m in zip(own, masks)]
    got = [(str(r.doc_id), r.n_words, [(s.start, s.end) for s in r.removed], r.kept)
           for r in substring_dedup.substring_dedup(docs).collect()]
    assert sorted(got) == sorted(want)
    out = substring_dedup.substring_dedup(docs, carry=["fingerprint", "text"], layout=True).collect()
    assert all(r.kept == (r.carry.text or "") for r in out if not r.removed)
    assert all(r.kept.split() != r.carry.text.split() for r in out if r.removed)
    assert substring_dedup.substring_dedup(no_docs, carry=["block"]).count() == 0


@pytest.mark.parametrize("hot_blocks", [2, 64])
@pytest.mark.parametrize("unit", [repeats.BYTES_50, repeats.WORDS_50])
@pytest.mark.parametrize("with_copies", [True, False])
def test_steps_without_spark(unit, hot_blocks, with_copies, monkeypatch):
    """The steps by hand, over four blocks, also with hot anchors and small slices."""
    import pyarrow as pa
    monkeypatch.setattr(repeats, "HOT_BLOCKS", hot_blocks)
    monkeypatch.setattr(repeats, "SLICE", 97)
    rng = random.Random(7)
    shared = words(rng, 90, 50)
    docs = [(i, " ".join(words(rng, rng.randrange(60), 50) + shared[rng.randrange(20):] + words(rng, 20, 50)))
            for i in range(30)]
    docs += [(40 + i, docs[3][1]) for i in range(5)] + [(60, "ab" * 100), (61, "ab" * 80), (62, "")]
    tables = [pa.table({"doc_id": pa.array([d for d, _ in part], pa.int64()),
                        "text": pa.array([t for _, t in part], pa.string())})
              for part in (docs[b::4] for b in range(4))]
    buckets = 3
    first = {}
    for d, t in docs:
        first.setdefault(t, d)
    copies = pa.Table.from_pylist(
        [{"block": b, "bucket": -1, "keys": hashlib.md5(r["text"].encode()).digest(), "hot": None, "copy": r["doc_id"]}
         for b, t in enumerate(tables) for r in t.to_pylist() if first[r["text"]] < r["doc_id"] and with_copies],
        pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("hot", pa.binary()), ("copy", pa.int64())]))
    sent = pa.concat_tables([repeats.block_keys(unit, buckets, b, t, _where(copies, "block", b))
                             for b, t in enumerate(tables)])
    shared_ = pa.concat_tables([repeats.bucket_shared(k, s) for k in range(buckets)
                                if len(s := _where(sent, "bucket", k))] + [copies])
    runs = pa.concat_tables([repeats.block_runs(unit, buckets, b, t, _where(shared_, "block", b))
                             for b, t in enumerate(tables)])
    classes = repeats.by_hash if unit.words else suffix_dedup.by_suffix_sort
    answers = pa.concat_tables([repeats.bucket_answers(unit, classes, s) for k in range(buckets)
                                if len(s := _where(runs, "bucket", k))])
    symbols = [(d, t.split() if unit.words else t.encode()) for d, t in docs]
    want = dict(zip((d for d, _ in docs), brute_windows(symbols, 50)))
    for b, t in enumerate(tables):
        ids, data, _ = repeats.ordered(t)
        lengths = np.array([len(unit.symbols(unit.prepare(x))[0]) for x in data])
        mask = repeats.removed_mask(unit, lengths, _where(answers, "block", b))
        for d, m in zip(ids.tolist(), np.split(mask, np.cumsum(lengths)[:-1])):
            assert m.tolist() == want[d], (unit, d)


def _where(table, column, value):
    import pyarrow.compute as pc
    return table.filter(pc.equal(table.column(column), value))


def test_merge_sort_orders_suffixes():
    rng = random.Random(9)
    data = bytes(rng.choice(b"ab") for _ in range(400))
    poly, raw = repeats.Polynomial(repeats.BYTES_50.wide(data)), np.frombuffer(data, np.uint8)
    start = np.array([rng.randrange(350) for _ in range(120)])
    group = np.array([rng.randrange(3) for _ in range(120)])
    order = suffix_dedup.merge_sort(poly, raw, group, start, 50)
    keys = [(group[i], data[start[i]:start[i] + 50]) for i in order]
    assert keys == sorted(keys)


def test_hash_collisions_fall_back_to_bytes():
    data = b"abcabdabc"
    at = (np.arange(9), np.arange(1, 10))
    unit = repeats.Unit(3, 2, False)
    cls = repeats.checked(unit, np.zeros(3, int), np.array([0, 3, 6]), data, at, np.zeros(3, int), np.array([0]))
    assert cls[0] == cls[2] != cls[1]


def test_line_similarity_is_the_plain_edit_distance(spark):
    """Trimming and the word-by-word bound change no answer: replaced, inserted and lost
    words, no common word, empty and non-ASCII lines, on both sides of LONG."""
    import random
    from pyspark.sql import functions as F
    from panelcast.llm import line_dedup
    rnd = random.Random(3)

    def word():
        return "".join(rnd.choice("abcdeéß漢") for _ in range(rnd.randint(3, 8)))
    rows = [("", ""), ("a", ""), ("é" * 700, "é" * 699 + "x"), ("x" * 600, "y" * 600), ("ab " * 300, "ba " * 300)]
    for i in range(60):
        n = rnd.choice([5, 30, 120])
        a = [word() for _ in range(n)]
        b = list(a)
        for _ in range(rnd.choice([0, 1, 3, n // 8, n // 4, n // 3])):
            at = rnd.randrange(len(b))
            b[at:at + 1] = rnd.choice([[word()], [word(), word()], [], [b[at][1:]]])
            b = b or [word()]
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    most = line_dedup.most_edits(F.length("a"), F.length("b"), 0.8)
    got = df.select(line_dedup.similar(F.col("a"), F.col("b"), 0.8).alias("got"),
                    (F.levenshtein("a", "b") <= most).alias("want")).collect()
    assert len({r.want for r in got}) == 2 and all(r.got == r.want for r in got)
