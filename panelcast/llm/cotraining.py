"""Co-trained quality classifier: a text view and a page-metadata view teach each other.

Text view: which words, word beginnings and trailing symbol runs a text holds, and how much
it repeats words or shouts. Metadata view: language, source, length, and the layout of the
page (lines, digits, symbols). Each view is a logistic regression with sparse weights.

A document is good if it is labelled quality 1 and toxic 0, bad if a label says otherwise.
Training uses a bounded sample: documents whose hashed id falls in a share chosen so that
about SAMPLE labelled and POOL unlabelled documents are expected; the features of the
sample go to the driver. A view uses the features that tell the classes apart. A fifth of the labelled sample is set aside. In each round both
views are fitted, and each hands the unlabelled documents it is surest of (at a confidence
that is at least PRECISION right on the documents set aside) to the other view as labelled.
At the end both views are calibrated on the documents set aside, their log-odds are added
with fitted weights, and every document of the table is scored. A document is kept if its
score reaches the threshold, which is chosen on the documents set aside: the best balanced
accuracy among thresholds that keep KEEP of the good ones.

Null text counts as empty, a null metadata value as a value of its own, and null labels as
no label. With several labels for an id one bad label is enough. Without both good and bad
labelled documents nothing can be learned: all scores are 1 and all documents are kept. An
empty table gives no rows. Repeated rows stay; extra columns are ignored or carried along.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_in, id_out, prepare, release, strings

#: Expected numbers of labelled and of unlabelled documents in the sample.
SAMPLE = 16_000
POOL = 4_000
ROUNDS = 3
EPOCHS = 8
CHI2 = 6.63
PRECISION = 0.98
#: Most documents that a view hands over in a round, for each class.
HANDED = 500
KEEP = 0.995
DIMENSIONS = 1 << 18
_SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _slot(feature: bytes) -> int:
    return xxhash.xxh3_64_intdigest(feature) % (DIMENSIONS - 1) + 1  # 0 is the bias


def _level(share: float) -> bytes:
    """A share of 0..1 as one of a few steps."""
    return b"%d" % round(10 * math.sqrt(max(0.0, min(1.0, share))))


def _size(n: float) -> bytes:
    return b"%d" % int(math.log2(1 + max(0, n)))


def text_features(data: bytes) -> np.ndarray:
    words = data.lower().split()
    out = {0}
    for w in set(words):
        core = w.strip(_SYMBOLS)
        out.add(_slot(b"w " + core))
        if len(core) > 5:
            out.add(_slot(b"p " + core[:5]))
        tail = w[len(w.rstrip(_SYMBOLS)):]
        if tail:
            out.add(_slot(b"s " + tail[:4]))
    n = max(1, len(words))
    letters = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    out.add(_slot(b"again " + _level(sum(map(bytes.__eq__, words, words[1:])) / n)))
    out.add(_slot(b"types " + _level(len(set(words)) / n) + b" " + _size(n)))
    out.add(_slot(b"upper " + _level(upper / max(1, letters))))
    return np.fromiter(out, np.uint32, len(out))


def meta_features(data: bytes, lang, source, n_chars) -> np.ndarray:
    lines = data.split(b"\n")
    n = max(1, len(data))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lang, source = str(lang).encode(), str(source).encode()
    size = b"none" if n_chars is None else _size(n_chars)
    found = [b"lang " + lang, b"source " + source, b"size " + size, b"lines " + _size(len(lines)),
             b"width " + _size(n / len(lines)), b"digits " + _level(digits / n),
             b"symbols " + _level(symbols / n), b"lang size " + lang + b" " + size,
             b"same lines " + _level(1 - len(set(lines)) / len(lines))]
    return np.array(sorted({0, *map(_slot, found)}), np.uint32)


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Features whose presence differs between the classes: a chi-square test, with
    continuity correction, beyond CHI2. The rare words of a text, which would only be
    learned by heart, are left out."""
    flat = np.concatenate(rows)
    own = np.repeat(labels == 1, [len(r) for r in rows])
    n1, n0 = float(labels.sum()), float(len(labels) - labels.sum())
    a = np.bincount(flat[own], minlength=DIMENSIONS).astype(float)
    b = np.bincount(flat[~own], minlength=DIMENSIONS).astype(float)
    c, d, n = n1 - a, n0 - b, n1 + n0
    chi2 = n * np.maximum(np.abs(a * d - b * c) - n / 2, 0) ** 2 / np.maximum((a + b) * (c + d) * n1 * n0, 1e-9)
    out = chi2 >= CHI2
    out[0] = True
    return out


def _only(rows: list[np.ndarray], use: np.ndarray) -> list[np.ndarray]:
    """The features of each row that are in use, as parts of one array: many small arrays
    would leave the driver's memory in pieces that it cannot give back."""
    ends = np.cumsum([0, *(np.count_nonzero(use[at]) for at in rows)])
    flat = np.empty(ends[-1], np.uint32)
    for at, start, end in zip(rows, ends, ends[1:]):
        flat[start:end] = at[use[at]]
    return [flat[start:end] for start, end in zip(ends, ends[1:])]


def _numbers(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a binary column as numbers, without copies of them."""
    out = []
    for chunk in column.chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            data = np.frombuffer(chunk.buffers()[2], np.uint8)
            out += [data[start:end].view("<u4") for start, end in zip(ends, ends[1:])]
    return out


class Sparse:
    """Logistic regression on the telling features that are present, fitted by
    FTRL-proximal steps (per-feature rates, L1), one document at a time in a fixed order."""

    ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.6, 1.0

    def __init__(self):
        self.z, self.n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.L1, 0.0, -(z - np.sign(z) * self.L1)
                        / ((self.BETA + np.sqrt(n)) / self.ALPHA + self.L2))

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> "Sparse":
        rows = _only(rows, telling(rows, labels))
        order = np.random.default_rng(0).permutation(len(rows))
        for _ in range(EPOCHS):
            for i in order:
                at = rows[i]
                w = self.weights(at)
                g = 1 / (1 + math.exp(-max(-30.0, min(30.0, w.sum())))) - labels[i]
                n = self.n[at]
                self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.ALPHA * w
                self.n[at] = n + g * g
        return self


def _odds(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    return np.array([weights[at].sum() for at in rows])


def _platt(x: np.ndarray, y: np.ndarray, steps: int = 200) -> np.ndarray:
    """Logistic regression of y on the columns of x and a constant, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 1e-2 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Model:
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    both: np.ndarray
    threshold: float

    def score(self, text_odds: np.ndarray, meta_odds: np.ndarray):
        """Calibrated probabilities of each view and of both together."""
        t = text_odds * self.text_scale[0] + self.text_scale[1]
        m = meta_odds * self.meta_scale[0] + self.meta_scale[1]
        return _sigmoid(t), _sigmoid(m), _sigmoid(t * self.both[0] + m * self.both[1] + self.both[2])


def _surest(odds: np.ndarray, held: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unlabelled rows that a view is sure to be good, and bad: beyond the mildest log-odds
    at which the rows set aside are at least PRECISION right."""
    out = []
    for sign, right in ((1, truth), (-1, 1 - truth)):
        s = sign * held
        order = np.argsort(-s, kind="stable")
        ok = np.cumsum(right[order]) >= PRECISION * np.arange(1, len(s) + 1)
        ok &= np.arange(1, len(s) + 1) >= 20
        limit = s[order][np.flatnonzero(ok)[-1]] if ok.any() else np.inf
        at = np.flatnonzero(sign * odds >= limit)
        out.append(at[np.argsort(-sign * odds[at], kind="stable")][:HANDED])
    return out[0], out[1]


def co_train(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, aside: np.ndarray,
             rounds: int = ROUNDS) -> Model | None:
    """Fit both views. ``label``: 1 good, 0 bad, -1 none; ``aside``: rows to calibrate on."""
    text, meta = [r[0] for r in rows], [r[1] for r in rows]
    known = np.flatnonzero((label >= 0) & ~aside)
    held = np.flatnonzero((label >= 0) & aside)
    pool = np.flatnonzero(label < 0)
    if len(set(label[known])) < 2 or len(set(label[held])) < 2:
        return None
    given = {"text": {}, "meta": {}}  # unlabelled row -> label, by the view that learns it
    for round_ in range(rounds + 1):
        weights = {}
        for name, view in (("text", text), ("meta", meta)):
            more = given[name]
            use = np.concatenate([known, np.array(sorted(more), np.int64)])
            y = np.concatenate([label[known], np.array([more[i] for i in sorted(more)], np.int64)])
            weights[name] = Sparse().fit([view[i] for i in use], y).weights()
        if round_ == rounds:
            break
        for name, view, other in (("text", text, "meta"), ("meta", meta, "text")):
            free = np.array([i for i in pool if i not in given[other]], np.int64)
            if len(free):
                good, bad = _surest(_odds(weights[name], [view[i] for i in free]),
                                    _odds(weights[name], [view[i] for i in held]), label[held])
                given[other].update({int(free[i]): 1 for i in good} | {int(free[i]): 0 for i in bad})
    y = label[held].astype(float)
    t, m = _odds(weights["text"], [text[i] for i in held]), _odds(weights["meta"], [meta[i] for i in held])
    ts, ms = _platt(t[:, None], y), _platt(m[:, None], y)
    both = _platt(np.column_stack([t * ts[0] + ts[1], m * ms[0] + ms[1]]), y)
    model = Model(weights["text"], weights["meta"], ts, ms, both, 0.0)
    p = model.score(t, m)[2]
    # thresholds half-way between neighbouring scores
    s = np.unique(p)
    cuts = np.concatenate([[0.0], (s[:-1] + s[1:]) / 2]) if len(s) > 1 else np.array([0.0])
    kept = np.array([(p[y == 1] >= c).mean() for c in cuts])
    out = np.array([(p[y == 0] < c).mean() for c in cuts])
    allowed = kept >= KEEP
    best = np.flatnonzero(allowed)[np.argmax((kept + out)[allowed])]
    return Model(weights["text"], weights["meta"], ts, ms, both, float(cuts[best]))


def _columns(docs: DataFrame) -> list:
    """Text and metadata; metadata that a table lacks counts as null."""
    have = {c.lower() for c in docs.columns}
    return [id_in().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
            *[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c)
              for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]]


def _views(batch):
    for text, lang, source, n in zip(strings(batch.column("text")), *(
            batch.column(c).to_pylist() for c in ("lang", "source", "n_chars"))):
        yield text_features(text), meta_features(text, lang, source, n)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, pool: int = POOL,
          rounds: int = ROUNDS) -> Model | None:
    """The co-trained model from a bounded sample of documents and labels."""
    prepare(docs.sparkSession)
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    known = (labels.filter(F.col("doc_id").isNotNull() & good.isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good.cast("int")).alias("label")))
    rank = ("place", "doc_id", "body")
    rows = docs.select(*_columns(docs)).withColumns({"place": F.xxhash64(F.lit("sample"), "doc_id"), "body": F.xxhash64("text")})
    held = rows.select(*rank).distinct().join(known, "doc_id", "left")
    n = held.filter("label is not null").count()
    if not n:
        return None

    def first(part: DataFrame, size: int):
        """Whether a row is among the ``size`` first different rows of ``part`` by hash. Only
        their last rank comes to the driver, so that the rows stay where they are."""
        last = part.select(*rank).orderBy(*rank).limit(size).agg(F.max(F.struct(*rank)).alias("m")).first()["m"]
        if last is None:
            return F.lit(False)
        p, d, b = (F.lit(x).cast("long") for x in last)
        return ((F.col("place") < p) | (F.col("place") == p) & (
            (F.col("doc_id") < d) | (F.col("doc_id") == d) & (F.col("body") <= b)))
    labelled = rows.filter(first(held.filter("label is not null"), sample)).join(known, "doc_id")
    unlabelled = (rows.filter(first(held.filter("label is null"), pool)).join(known, "doc_id", "left_anti")
                  .withColumn("label", F.lit(-1)))
    names = ["doc_id", "text", "lang", "source", "n_chars", "label"]

    def run(batches):
        for batch in batches:
            pairs = list(_views(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([np.sort(t).astype("<u4").tobytes() for t, _ in pairs], pa.binary()),
                 pa.array([m.astype("<u4").tobytes() for _, m in pairs], pa.binary())],
                ["doc_id", "label", "text", "meta"])
    got = (labelled.select(*names).union(unlabelled.select(*names))
           .mapInArrow(run, "doc_id long, label int, text binary, meta binary").distinct().toArrow()  # repeated rows count once
           .sort_by([("doc_id", "ascending"), ("text", "ascending")]))
    pairs = list(zip(_numbers(got.column("text")), _numbers(got.column("meta"))))
    ids = got.column("doc_id").to_pylist()
    aside = np.array([xxhash.xxh3_64_intdigest(str(i).encode()) % 5 == 0 for i in ids], bool)
    return co_train(pairs, np.array(got.column("label").to_pylist(), np.int64), aside, rounds)


def score(docs: DataFrame, model: Model | None, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, text_score, meta_score, score double, keep boolean) of every document.
    ``carry``: columns to hand through, as struct ``carry``."""
    spark = docs.sparkSession
    prepare(spark)
    extra = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carry")] if carry else []
    rows = docs.select(*_columns(docs), *extra)
    share = spark.sparkContext.broadcast(model)  # two weight vectors of DIMENSIONS

    def run(batches):
        model = share.value
        for batch in batches:
            n = batch.num_rows
            if model is None:
                columns = [np.ones(n)] * 3 + [np.ones(n, bool)]
            else:
                odds = np.array([(model.text[t].sum(), model.meta[m].sum()) for t, m in _views(batch)]).reshape(-1, 2)
                columns = [*model.score(odds[:, 0], odds[:, 1])]
                columns.append(columns[2] >= model.threshold)
            arrays = [batch.column("doc_id"), *map(pa.array, columns)]
            names = ["doc_id", "text_score", "meta_score", "score", "keep"]
            if carry:
                arrays.append(batch.column("carry"))
                names.append("carry")
            yield pa.RecordBatch.from_arrays(arrays, names)
    schema = "doc_id long, text_score double, meta_score double, score double, keep boolean"
    if carry:
        schema += f", carry {rows.schema['carry'].dataType.simpleString()}"
    return rows.mapInArrow(run, schema).withColumn("doc_id", id_out())


def quality_scores(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Train on the labelled sample and score every document."""
    model = train(docs, labels)
    release(docs.sparkSession)  # the sample is not needed any more
    return score(docs, model, carry)
