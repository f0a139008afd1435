"""K2-treap search against brute force over all pairs of items and documents."""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import k2treap, wordcodes
from .conftest import DOCS, frame, known, shown

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, rank int, score string, doc_id long"


def terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(small)


def brute(rows, items, k):
    bags = [(i, Counter(terms(t))) for i, t in rows]
    total = sum(sum(b.values()) for _, b in bags)
    n_docs = sum(1 for _, b in bags if b)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // max(1, total)
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((1000000000 * b[w]) // (1000 * b[w] + 12 * m)) for w, n in Counter(terms(text)).items() if b[w])
            if s > 0:
                scores.append((-s, i))
        out += [(str(item), r + 1, str(shown(i)), -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def asked(rows):
    own = [t for _, t in rows if t and len(t) > 30]
    return [(1, " ".join(own[0].split()[:20])), (2, "Same line HERE same"), (3, None), (4, ""), (5, " ,;\x00\x7f"),
            (6, "nowhere to be found"), (7, own[3]), (7, own[5][:200]), (None, own[2][:150]), (8, "Ünïcode ßtraße"),
            (9, "w1x w2x w3x w4x w5x w6x"), (10, max(own, key=len))]


@pytest.mark.parametrize("shard_bytes, item_bytes", [(1 << 24, 1 << 22), (3000, 400)])
def test_against_brute_force(spark, docs, rows, shard_bytes, item_bytes):
    items = asked(rows)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], ITEMS).repartition(2)
    got = k2treap.ranked_search(docs, df, k=5, shard_bytes=shard_bytes, item_bytes=item_bytes).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == brute(known(rows), items, 5)


def test_copies_and_ties(spark):
    """Many equal scores: the smallest ids win."""
    rows = [(i, "tie of words") for i in range(300, 0, -1)] + [(i, "other") for i in range(1000, 1040)]
    df = spark.createDataFrame([(5, "words tie", 1, "x", 2)], ITEMS)
    got = k2treap.ranked_search(frame(spark, rows), df, k=20, shard_bytes=500).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == brute(rows, [(5, "words tie")], 20)


def test_empty(spark, docs, no_docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(5, "words tie", 1, "x", 2)], ITEMS)
    assert k2treap.ranked_search(docs, none).count() == 0
    out = k2treap.ranked_search(no_docs, some)
    assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]
    blank = spark.createDataFrame([(1, None, None, None, None, None, None, None)] * 2, DOCS)
    assert k2treap.ranked_search(blank, some).count() == 0


def test_treap_holds_its_points():
    rng = np.random.default_rng(3)
    rows, cols = rng.integers(0, 37, 400), rng.integers(0, 9, 400)
    cells = np.unique(rows << 32 | cols)
    rows, cols = cells >> 32, cells & 0xFFFFFFFF
    impact = rng.integers(1, 10**6, len(cells))
    treap = k2treap.Treap(*k2treap.build(rows, cols, impact, 6), 6, 9)
    ids = np.arange(9) * 10
    for r in range(37):
        score, place = treap.search(np.array([r]), np.array([1]), 99, (0, -2**63), ids)
        assert dict(zip(place.tolist(), score.tolist())) == dict(zip(cols[rows == r].tolist(), impact[rows == r].tolist()))


def test_words(rows):
    own = [t.encode() for _, t in known(rows)]
    words, codes, lengths = wordcodes.word_codes(own)
    assert lengths.tolist() == [len(terms(t.decode())) for t in own]
    assert [words[c].as_py().decode() if isinstance(words[c].as_py(), bytes) else words[c].as_py() for c in codes.tolist()] == [
        w for t in own for w in terms(t.decode())]
    import pyarrow as pa
    assert wordcodes.count_words(pa.array([t.decode() for t in own])).tolist() == lengths.tolist()
    assert wordcodes.count_words(pa.array(["a", "b c", "", "d"]).slice(1)).tolist() == [2, 0, 1]
