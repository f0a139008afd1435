"""Exact top-k search and Merkle fingerprints against brute force."""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from panelcast.llm import merkle, topk
from .conftest import frame, known, shown

VECTORS = "vec_id long, embedding array<float>, score int, rank string"


def brute_top(rows, k, every):
    valid = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in valid:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in valid if j != i)
            out += [(i, r + 1, j, -n) for r, (n, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k(spark, block):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=13).round(3).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5] * 13) for i in range(30)]  # ties
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan")] * 13), (203, [float("inf")] * 13),
             (204, [1.0, -2.0]), (205, []), (None, [1.0] * 13), (206, [0.0] * 13)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    v = topk.quantised(df)
    got = topk.top_k(v.filter("vec_id % 20 = 0"), v, k=9, block=block).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top(rows, 9, 20)


def test_top_k_large_components_and_empty(spark):
    rows = [(i, [2.0**24 * (i + 1), -3.0]) for i in range(5)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    v = topk.quantised(df, scale=8)
    got = topk.top_k(v, v, k=2).collect()
    assert {(r.query_id, r["rank"]): r.vec_id for r in got}[(0, 1)] == 4
    assert got[0].score == 2**27 * (got[0].query_id + 1) * 2**27 * (got[0].vec_id + 1) + 576
    none = topk.quantised(df.filter("false"))
    assert topk.top_k(none, v).count() == 0 and topk.top_k(v, none).count() == 0


def test_bounds_never_fall_below_scores():
    rng = np.random.default_rng(1)
    q, c = rng.integers(-20, 20, (9, 21)).astype(float), rng.integers(-20, 20, (11, 21)).astype(float)
    for s in topk.RESOLUTIONS:
        assert (topk.segment_features(q, s) @ topk.segment_features(c, s).T >= q @ c.T - 1e-9).all()


def test_merkle_against_next(docs, rows, no_docs):
    order = sorted(known(rows))
    want = []
    for n, (i, t) in enumerate(order):
        e = merkle.edited(t, order[(n + 1) % len(order)][1])
        a, b, c = merkle.build(t), merkle.build(e), merkle.build(order[(n + 1) % len(order)][1])
        want.append((str(shown(i)), len(t), e.encode(), a[0].hex(), b[0].hex(), round(merkle.likeness(a, b), 9),
                     round(merkle.likeness(a, c), 9)))
    got = [(str(r.doc_id), r.n_chars, bytes(r.edited), r.fingerprint, r.edited_fingerprint,
            round(r.near_edited, 9), round(r.near_next, 9)) for r in merkle.compare_with_edits(docs).collect()]
    # of rows with one id, the one that follows the range of the id before is the smallest text
    assert sorted(got) == sorted(want)
    assert merkle.compare_with_edits(no_docs).count() == 0


def test_merkle_one_row(spark):
    r = merkle.compare_with_edits(frame(spark, [(3, "one two three four five six")])).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert hashlib.sha256(bytes(r[0].edited)).hexdigest()


def test_merkle_tree(docs, rows):
    assert merkle.likeness(merkle.build("a b"), merkle.build("a b")) == 1.0
    assert merkle.likeness(merkle.build(""), merkle.build("")) == 1.0
    assert merkle.likeness(merkle.build("abc. def"), merkle.build("xyz! uvw")) == 0.0
    text = "First one. Second one.\nThird line here.\n\nNext section."
    assert merkle.edited_spans(text, text) == []
    assert merkle.edited_spans(text, text.replace("Third line here", "Third line gone")) == [(23, 41)]  # with the line feeds that end it
    for _, t in known(rows):
        spans = [(n["start"], n["length"]) for n in _leaves(t)]
        assert sum(n for _, n in spans) == len(t)
    got = {(r.doc_id, r.fingerprint) for r in merkle.merkle_fingerprints(docs).collect()}
    assert got == {(i, merkle.build(t or "")[0].hex()) for i, t in rows}


def _leaves(text):
    out, at = [], 0
    for section in merkle.build(text)[2]:
        for paragraph in section[2]:
            for leaf in paragraph[2]:
                out.append({"start": at, "length": leaf[1]})
                at += leaf[1]
    return out
