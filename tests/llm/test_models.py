"""Brown language model and co-trained classifier."""
from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import brown, cotraining
from .conftest import frame, known


def language(seed=0, n=300):
    """Texts of two topics whose words follow each other by class."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = i % 2
        rows.append((i, " ".join(f"{'ab'[t]}{'xyz'[j % 3]}{rng.randrange(60)}" for j in range(rng.randrange(10, 60)))))
    return rows


def base_scores(rows):
    own = [(i, (t or "").encode().lower().split()) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in own]
    c, n = Counter(), 0
    for (_, w), h in zip(own, held):
        if not h:
            c.update(w)
            n += 1
    total, types = sum(c.values()) + n, len(c) + (n > 0)
    out = []
    for (i, w), h in zip(own, held):
        counts = [c[x] for x in w] + [n]
        out.append((str(i), h, len(counts), sum(x > 0 for x in counts), total,
                    round(sum(math.log10((x + 1) / (total + types + 1)) for x in counts), 6)))
    return sorted(out)


@pytest.mark.parametrize("head", [brown.HEAD, 25])
def test_counts_and_base(docs, rows, head):
    got = brown.brown_scores(docs, head=head, moved=10, choices=3, rounds=1).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == base_scores(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_model_beats_base_on_held_out_texts(spark):
    got = [r for r in brown.brown_scores(frame(spark, language()), choices=8).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.2 * sum(r.n_tokens for r in got)


def test_no_training_rows(spark, no_docs):
    assert brown.brown_scores(no_docs).count() == 0
    from pyspark.sql import functions as F
    r = brown.brown_scores(frame(spark, [(1, "a b")]), held=F.lit(True)).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(r.score)


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(0)
    words, choices = 40, 4
    m = choices + 1
    kind = np.arange(words) % 2  # words of one kind follow words of the other
    pairs = rng.integers(0, 20, (words, words)) * (kind[:, None] != kind[None, :])
    classes = np.append(rng.integers(0, choices, words), m - 1)

    def tables(c):
        one = np.eye(m, dtype=np.int64)[c[:words]]
        return one.T @ pairs @ one, pairs @ one, pairs.T @ one

    def likelihood(c):
        n = tables(c)[0].astype(float)
        return brown._xlogx(n).sum() - 2 * brown._xlogx(n.sum(axis=1)).sum()
    before = likelihood(classes)
    for _ in range(3):
        brown.exchange(*tables(classes), classes, choices)
    assert likelihood(classes) > before
    assert all(len(set(kind[classes[:words] == c])) <= 1 for c in range(choices))


def labelled(n=400):
    """Bad texts hold a bad word; bad pages mostly have another source."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["awful", "nasty", "vile"])
        docs.append((i, " ".join(w), "en", "junk" if bad and rng.random() < 0.8 else "press", len(w), "x"))
        if i % 2 == 0:
            labels.append((i, 1, int(bad)) if i % 8 else (i, int(not bad), 0))
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
LABELS = "doc_id long, quality int, toxic int"


def test_classifier_on_documents_without_labels(spark):
    docs, labels = labelled()
    labels += [(1, None, 0), (None, 1, 0), (2, 1, 0)]
    docs += [(None, None, None, None, None, None), (999, "", "en", None, None, None)]
    got = cotraining.quality_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS),
                                    carry=["score", "text"]).collect()
    assert len(got) == len(docs)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 2]
    assert np.mean([r.keep for r in unseen if r.doc_id % 4]) > 0.95
    bad = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0]
    assert np.mean([r.keep for r in bad]) < 0.1
    assert all(0 <= r.score <= 1 for r in got)


def test_classifier_without_usable_labels(spark, no_docs):
    docs, labels = labelled(20)
    df = spark.createDataFrame(docs, DOCS)
    for have in ([], [(i, 1, 0) for i in range(20)], [(1, None, None)]):
        out = cotraining.quality_scores(df, spark.createDataFrame(have, LABELS)).collect()
        assert len(out) == 20 and all(r.keep and r.score == 1.0 for r in out)
    assert cotraining.quality_scores(no_docs, spark.createDataFrame(labels, LABELS)).count() == 0


def test_views_hand_over_confident_rows():
    held = np.array([3.0] * 30 + [-3.0] * 30)
    truth = np.array([1] * 30 + [0] * 30)
    good, bad = cotraining._surest(np.array([5.0, 0.0, -5.0]), held, truth)
    assert good.tolist() == [0] and bad.tolist() == [2]
    assert known([(None, None)])[0][1] == ""


def test_samples_are_bounded_whatever_the_labels(spark, monkeypatch):
    """Label ids without documents, repeated ids and long texts send no more rows."""
    docs, labels = labelled()
    docs += [(7001, "clean words of a long text " * 40_000, "en", "press", 1, "x")] + [(7002, "same id", "en", None, None, None)] * 300
    labels += [(i, 1, 0) for i in range(10_000, 10_900)]
    seen = []
    monkeypatch.setattr(cotraining, "co_train", lambda pairs, y, aside, rounds: seen.append(y))
    for sample, pool in ((50, 40), (5, 400), (10_000, 10_000)):
        cotraining.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), sample, pool)
        y = seen.pop()
        assert 0 < (y >= 0).sum() <= sample and (y < 0).sum() <= pool
    assert len(y) == len(docs) - 299  # repeated rows count once


def test_sample_features_lie_in_one_array():
    """The driver keeps the sample's features as parts of few large arrays, with equal values."""
    rows = [np.array(x, "<u4") for x in ([0, 3, 9], [0], [], [0, 2**31, 7])]
    column = pa.chunked_array([pa.array([r.tobytes() for r in rows[:2]]), pa.array([], pa.binary()),
                               pa.array([b"skipped"] + [r.tobytes() for r in rows[2:]])[1:]])
    got = cotraining._numbers(column)
    assert [list(g) for g in got] == [list(r) for r in rows]
    use = np.ones(10, bool)
    use[3] = False
    few = [np.array(x, np.uint32) for x in ([0, 3, 9], [3], [], [0, 7])]
    kept = cotraining._only(few, use)
    assert [list(k) for k in kept] == [[0, 9], [], [], [0, 7]] and kept[0].base is kept[3].base
