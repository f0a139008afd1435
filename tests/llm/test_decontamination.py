"""FM-index decontamination against a plain scan of all windows."""
from __future__ import annotations

import random
import re

import numpy as np
import pytest

from panelcast.llm import fm_index
from .conftest import frame, known, shown, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, spans int, n_words string"


def fold(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, width):
    windows = {}
    for name, text in items:
        own = fold(text)
        n = min(width, len(own))
        for at in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[at:at + n]), set()).add(str(name) if name is not None else "null")
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        own, hit, names = fold(text), set(), set()
        for n in sizes:
            for at in range(len(own) - n + 1):
                found = windows.get(tuple(own[at:at + n]))
                if found:
                    hit.update(range(at, at + n))
                    names |= found
        out.append((str(shown(i)), len(own), sorted(hit), sorted(names)))
    return sorted(out, key=str)


def listed(rows):
    return sorted(((str(r.doc_id), r.n_words, [i for s in r.spans for i in range(s["start"], s["end"])], r["items"])
                   for r in rows), key=str)


def planted(rows):
    rng = random.Random(4)
    texts = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(i, " ".join(texts[i].split()[3:3 + 12 + i])) for i in range(10)]
    items += [(20, "same line"), (21, ""), (22, None), (23, " .\x00"), (24, "x"), (25, "zzz yyy"), (None, "a b"),
              (26, " ".join(words(rng, 30))), (26, texts[12].upper()), (27, "ÜNÏCODE Ünïcode"), (28, "Ünïcode ßtraße")]
    return items


@pytest.mark.parametrize("width, shard_bytes, item_bytes", [(10, 1 << 24, 1 << 22), (4, 2500, 300)])
def test_against_brute_force(spark, docs, rows, width, shard_bytes, item_bytes):
    items = planted(rows)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS).repartition(2)
    got = fm_index.decontaminate(docs, df, width, shard_bytes, item_bytes).collect()
    assert listed(got) == brute(known(rows), items, width)


def test_copies_and_repeats(spark):
    """Large groups of copies, and one word that repeats."""
    rows = [(i, "the cat sat on a mat and it sat there for ever and a day") for i in range(200)]
    rows += [(1000, "go " * 500), (1001, "go " * 9), (1002, "the cat sat on a mat and it sat")]
    items = [(1, "on a mat and it sat there for ever and a day or two"), (2, "go " * 10), (3, "cat sat on")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    assert listed(fm_index.decontaminate(frame(spark, rows), df, shard_bytes=4000).collect()) == brute(rows, items, 10)


def test_empty(spark, docs, rows, no_docs):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c", 1, "x")], ITEMS)
    out = fm_index.decontaminate(no_docs, some)
    assert out.count() == 0 and out.columns == ["doc_id", "n_words", "spans", "items"]
    assert listed(fm_index.decontaminate(docs, none).collect()) == brute(known(rows), [], 10)


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(0)
    for size in (2, 5, 300):
        text = np.append(rng.integers(1, size, 400), 0)
        text[100:200] = text[:100]
        order = fm_index.suffix_array(text, size)
        assert order.tolist() == sorted(range(401), key=lambda i: text[i:].tolist())
        wavelet = fm_index.WaveletMatrix(text, size)
        assert wavelet.access(np.arange(401))[0].tolist() == text.tolist()
        for s in np.unique(text)[:5]:
            start = wavelet.follow(np.array([s]), np.array([0]))[0]
            got = wavelet.follow(np.full(402, s), np.arange(402)) - start
            assert got.tolist() == [int((text[:i] == s).sum()) for i in range(402)]


def test_query_against_brute_force(spark):
    import hashlib

    from panelcast.llm.queries import REGISTRY
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = sorted((int(i), n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
                  for i, n, hit, names in brute(rows, items, 10))
    assert sorted(tuple(r) for r in REGISTRY["op13_fm_decontamination"](spark, sf).collect()) == want
    assert any(w[-1] for w in want)
