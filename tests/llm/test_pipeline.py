"""Entry, SQL and the pipeline against the operators' brute force."""
from __future__ import annotations

import importlib
import os
import shutil

import pytest

import __spark_entry__ as entry
from panelcast.llm import packing
from panelcast.llm.queries import REGISTRY
from .test_near_duplicates import brute_components, brute_fingerprint, brute_lines, brute_windows

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(REGISTRY) <= set(names)


def test_top_k_against_sql(spark):
    from oracle_check import compare, duck
    name = "op1_topk_search"
    messages, _, _ = compare(spark, duck(SMALL), name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert not messages, messages


def test_stages_against_brute_force(spark):
    """Each stage after the classifier on its own input."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    source = docs.columns
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality", "line_dedup", "simhash_near_dedup",
                                               "substring_dedup", "packing"]
    kept = stages["quality"](spark, docs, SMALL)
    assert kept.columns == source
    kept = kept.limit(60).cache()  # a small fixture
    own = [(r.doc_id, r.text or "") for r in kept.collect()]

    lines = stages["line_dedup"](spark, kept, SMALL)
    assert lines.columns == source
    got = {r.doc_id: r for r in lines.collect()}
    want = {d: t for d, _, _, t in brute_lines(own, sketch=True)}
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for d, r in got.items() if r.text != dict(own)[d])

    own = sorted(want.items())
    near = stages["simhash_near_dedup"](spark, lines, SMALL)
    assert near.columns == source
    stay = set(brute_components([d for d, _ in own], [brute_fingerprint(t) for _, t in own], 3))
    assert sorted(r.doc_id for r in near.collect()) == sorted(stay)

    own = [(d, t) for d, t in own if d in stay]
    passages = stages["substring_dedup"](spark, near, SMALL)
    assert passages.columns == source
    masks = brute_windows([(d, t.encode().split()) for d, t in own], 50)
    for (d, t), mask in zip(own, masks):
        text = next(r.text for r in passages.collect() if r.doc_id == d) if any(mask) else None
        if text is not None:
            assert text.encode().split() == [w for w, g in zip(t.encode().split(), mask) if not g]
    texts = {r.doc_id: r.text for r in passages.collect()}
    assert all(texts[d] == t for (d, t), mask in zip(own, masks) if not any(mask))

    pieces = stages["packing"](spark, passages, SMALL).collect()
    from .test_tokens import _ids, check_pieces
    check_pieces(pieces, {d: _ids(t) for d, t in texts.items()})
    assert packing.WINDOW == 2048


def test_pipeline_takes_odd_rows(spark, docs, no_docs, tmp_path):
    """Nulls, empty and long texts, repeats and clashing columns pass all stages."""
    for n, df in enumerate((docs, no_docs)):
        folder = str(tmp_path / str(n))
        df.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        pipeline = importlib.import_module("corpus_pipeline")
        got = pipeline.run(spark, folder).collect()
        assert bool(got) == bool(n == 0)


def test_entry_without_the_subpackage(tmp_path):
    """__spark_entry__ imports and keeps the other queries when llm and the pipeline are gone."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "tests"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"],
                         cwd=tmp_path / "repo", capture_output=True, text=True)
    assert out.returncode == 0 and int(out.stdout.split()[-1]) == len(entry.queries()) - 14, out.stderr


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in ("op1_topk_search", "op10_quality_classifier")])
def test_queries_take_odd_tables(spark, docs, no_docs, tmp_path, name):
    for n, df in enumerate((docs, no_docs)):
        folder = str(tmp_path / str(n))
        df.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "Same line here."), (2, None)], "item_id long, text string") \
            .write.parquet(f"{folder}/benchmark.parquet")
        rows = REGISTRY[name](spark, folder).count()
        # op11 has rows per item; no phrase occurs often enough for op12
        least = {"op11_k2treap_search": 1, "op12_phrase_collocations": 0}.get(name, df.count())
        assert rows == 0 if n else rows >= least
