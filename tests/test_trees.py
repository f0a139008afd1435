"""Tree ensembles against growers in plain Python, on exact numbers."""
from __future__ import annotations

import heapq

import numpy as np
import pytest

from panelcast.operators import trees
from panelcast.operators.trees import Spec

COLS = ["a", "b", "c"]


def table(n=240, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 30, n), rng.integers(0, 4, n), rng.integers(0, 2, n)], 1).astype(float)
    y = 4 * np.floor(x[:, 0] / 7) + 8 * x[:, 1] * x[:, 2] + rng.integers(0, 5, n)
    return x, y.astype(float)


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, y))],
                                 "a double, b double, c double, y double, id int").repartition(3)


def brute_tree(x, r, w, spec):
    """(nodes as nested tuples) grown one node at a time over all cuts between values."""
    def best(rows):
        g, h = (r * w)[rows].sum(), w[rows].sum()
        top = (0.0, None, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                gl, hl = (r * w)[left].sum(), w[left].sum()
                if min(hl, h - hl) < spec.least or min(hl, h - hl) <= 0 or h < spec.split:
                    continue
                gain = gl**2 / (hl + spec.l2) + (g - gl)**2 / (h - hl + spec.l2) - g**2 / (h + spec.l2)
                if gain > top[0] + 1e-9:
                    top = (gain, f, cut)
        return top
    split, depth = {}, {1: 0}
    rows_of = {1: np.flatnonzero(w > 0)}
    top = best(rows_of[1])
    queue = [(-top[0], 1, top)]
    while queue and (not spec.leaves or len(split) < spec.leaves - 1):
        gain, node, top = heapq.heappop(queue)
        if gain >= -1e-9 or depth[node] >= spec.depth:
            continue
        split[node] = top[1:]
        rows = rows_of[node]
        for child, part in ((2 * node, rows[x[rows, top[1]] <= top[2]]), (2 * node + 1, rows[x[rows, top[1]] > top[2]])):
            rows_of[child], depth[child] = part, depth[node] + 1
            t = best(part)
            heapq.heappush(queue, (-t[0], child, t))

    def value(row):
        node = 1
        while node in split:
            f, cut = split[node]
            node = 2 * node + (row[f] > cut)
        own = rows_of[node]
        return (r * w)[own].sum() / (w[own].sum() + spec.l2)
    return np.array([value(row) for row in x]), len(split) + 1


def brute(x, y, spec, cuts):
    layout = trees.Layout(cuts)
    bins = layout.bins(x)
    keys = trees.row_keys(bins, y)
    base, fitted, out, leaves = y.mean(), np.zeros(len(y)), np.zeros(len(y)), []
    for t in range(spec.trees):
        allowed = np.flatnonzero(trees.columns_of(spec, t, x.shape[1]))
        value, n = brute_tree(x[:, allowed], y - base - fitted, trees.drawn(spec, t, keys), spec)
        leaves.append(n)
        if spec.forest:
            out += value / spec.trees
        else:
            fitted += spec.rate * value
    return base + (out if spec.forest else fitted), leaves


SPECS = {
    "forest": Spec(True, 3, 6, rows=0.0, least=2, split=5, seed=1),
    "level by level": Spec(False, 4, 4, rate=0.5, rows=0.8, cols=0.7, least=3, l2=1.0, seed=2),
    "best-first": Spec(False, 3, 6, leaves=9, rate=0.5, least=4, seed=3),
    "unbounded": Spec(False, 2, 9, leaves=50, rate=0.25, least=1, seed=3),
}


@pytest.mark.parametrize("name", list(SPECS))
@pytest.mark.parametrize("local", [True, False])
def test_against_brute_force(spark, monkeypatch, name, local):
    """The same trees on broadcast rows and a job a level over many blocks."""
    if not local:
        monkeypatch.setattr(trees, "LOCAL_BYTES", 0)
        monkeypatch.setattr(trees, "ROUNDS_KEPT", 2)
    x, y = table()
    spec, df = SPECS[name], frame(spark, *table())
    model = trees.fit(df, COLS, "y", spec, rows=50)
    want, leaves = brute(x, y, spec, trees.cut_points(df, COLS))
    got = {r.id: r.pred for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], want)
    assert [sum(f < 0 for f in r.feature) for r in model.trees.orderBy("tree").collect()] == leaves
    assert model.trees.count() == spec.trees
    if spec.leaves:
        assert max(leaves) <= spec.leaves


@pytest.mark.parametrize("local", [True, False])
def test_search_scores_every_candidate(spark, monkeypatch, local):
    """Equal to fitting each candidate by itself; forests of one family share their trees."""
    if not local:
        monkeypatch.setattr(trees, "LOCAL_BYTES", 0)
    x, y = table(150)
    df, tune = frame(spark, x, y), frame(spark, *table(60, 9))
    specs = [Spec(True, 3, 5, rows=0.0, least=2, split=5), Spec(True, 2, 3, rows=0.0, least=2, split=12),
             Spec(False, 2, 3, rate=0.3, l2=1.0, rows=0.7), Spec(False, 2, 5, leaves=5, rate=0.3, least=3)]
    got = trees.search(df, tune, COLS, "y", specs, rows=40)
    for spec, score in zip(specs, got):
        rows = trees.fit(df, COLS, "y", spec, rows=40).transform(tune).collect()
        want = 100 * sum(abs(r.y - r.pred) for r in rows) / sum(r.y for r in rows)
        assert score == pytest.approx(want)


def test_fifty_leaves_and_odd_rows(spark):
    x, y = table(1500, 4)
    y = y + x[:, 0] ** 2
    df = frame(spark, x, y)
    model = trees.fit(df.unionByName(df.selectExpr("a", "b", "c", "cast(null as double) y", "-id id").limit(5)), COLS, "y",
                      Spec(False, 5, 10, leaves=50, rate=0.3, least=5))
    assert max(sum(f < 0 for f in r.feature) for r in model.trees.collect()) == 50
    asked = spark.createDataFrame([(1.0, 2.0, None), (None, None, None), (1e9, -1e9, 0.5)], "a double, b double, c double")
    got = [r.pred for r in model.transform(asked).collect()]
    assert got[0] is None and got[1] is None and got[2] is not None
    assert abs(sum(model.importances()) - 1) < 1e-9 and model.importances()[0] > 0.4
    empty = trees.fit(df.limit(0), COLS, "y", Spec(False, 2, 3))
    assert [r.pred for r in empty.transform(asked.limit(1).fillna(0.0)).collect()] == [0.0]


def test_cut_points_are_within_the_error_of_the_sketch(spark):
    rng = np.random.default_rng(1)
    values = np.sort(rng.normal(size=20_000))
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "v double").repartition(7)
    for accuracy in (100, 10_000):
        cuts = trees.cut_points(df, ["v"], 16, accuracy)[0]
        ranks = np.searchsorted(values, cuts, "right") / len(values)
        assert len(cuts) == 15 and np.abs(ranks - np.arange(1, 16) / 16).max() <= 1 / accuracy + 1e-4


# ---------------------------------------------------------------- Parzen search
SPACE = {"n": (1, 60), "learning_rate": (0.001, 1.0), "share": (0.0, 1.0)}


def surface(p):
    return ((p["n"] - 41) / 60) ** 2 + (np.log10(p["learning_rate"]) + 1.2) ** 2 + (p["share"] - 0.3) ** 2


def test_parzen_search_beats_the_seeded_sampler(spark):
    from panelcast.operators import ml, parzen
    better = 0
    for seed in range(6):
        got = parzen.minimise(spark, {"m": SPACE}, lambda cands: [surface(p) for _, p in cands], 40, seed)["m"]
        assert [t for t, _, _ in got] == list(range(40))
        assert all(SPACE[k][0] <= v <= SPACE[k][1] and isinstance(v, int) == (k == "n") for _, p, _ in got for k, v in p.items())
        plain = [surface(p) for p in ml.sample_params(SPACE, 40, seed)]
        better += min(s for *_, s in got) < min(plain)
        assert np.mean([s for *_, s in got[20:]]) < np.mean(plain) / 2
    assert better >= 5


def test_parzen_search_goes_on_after_a_crash(spark, tmp_path):
    from panelcast.operators import parzen
    spaces, calls = {"a": SPACE, "b": {"n": (1, 60), "learning_rate": (0.001, 1.0), "share": (0.0, 1.0)}}, []

    def score(cands, limit=10**9):
        if len(calls) >= limit:
            raise RuntimeError("lost")
        calls.append(len(cands))
        return [surface(p) for _, p in cands]
    whole = parzen.minimise(spark, spaces, score, 22, 3)
    study = str(tmp_path / "study")
    calls.clear()
    with pytest.raises(RuntimeError):
        parzen.minimise(spark, spaces, lambda c: score(c, 2), 22, 3, study)
    done = sum(calls)
    assert parzen.minimise(spark, spaces, score, 22, 3, study) == whole
    assert sum(calls) == 44 and done == 30
    assert parzen.minimise(spark, spaces, lambda c: 1 / 0, 22, 3, study) == whole  # nothing left to try


def test_densities_are_densities():
    from panelcast.operators import parzen
    x = (np.arange(20_000) + 0.5) / 20_000
    for centres in ([], [0.5], [0.0, 1.0], [0.1, 0.12, 0.9, 0.9]):
        assert parzen.density(x, np.array(centres)).mean() == pytest.approx(1, abs=1e-3)
