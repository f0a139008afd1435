"""Fixtures of the training-data operators: odd rows that every operator must take."""
from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, block int, part int"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def corpus(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, repeats inside a text, odd and long texts."""
    rng = random.Random(seed)
    passage = words(rng, 80)
    base = [words(rng, rng.randrange(20, 200)) for _ in range(12)]
    out: list[tuple[int | None, str | None]] = []
    for i, w in enumerate(base):
        out.append((10 * i, " ".join(w)))
        if i % 3 == 0:
            out.append((10 * i + 1, " ".join(w)))  # a copy
        if i % 3 == 1:
            near = list(w)
            near[len(near) // 2] = "changed"
            out.append((10 * i + 2, " ".join(near)))
        if i % 4 == 0:
            out.append((10 * i + 3, " ".join(words(rng, 9) + passage + words(rng, 7))))
    out.append((500, " ".join(passage + passage[:60])))  # repeats itself
    out.append((501, "\n".join([" ".join(passage[:30]), "", "Same line here.", "Same line here."])))
    out.append((502, "same LINE here!\n \n\t"))
    out += [(600, None), (601, ""), (602, " \t\n"), (603, "x"), (604, "Ünïcode ßtraße   Über"),
            (605, "a b"), (606, "ab" * 60), (607, "ab" * 60)]
    out.append((700, " ".join(words(rng, 4000)) + "\n" + "z" * 500))  # long
    out.append((701, out[0][1]))
    out.append((701, out[0][1]))  # a repeated row
    out.append((702, "one text"))
    out.append((702, " ".join(base[2])))  # a repeated id
    out.append((None, " ".join(base[3])))
    out.append((None, None))
    return out


@pytest.fixture(scope="session")
def rows():
    return corpus()


def frame(spark, rows):
    """Documents with extra columns whose names operators use for their results."""
    return spark.createDataFrame(
        [(i, t, "en", None, None, "clash", 7, None) for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


BIG = 2**63 - 1


def known(rows):
    """(id, text) with the rules for nulls applied."""
    return [(BIG if i is None else i, t or "") for i, t in rows]


def shown(i: int):
    return None if i == BIG else i
