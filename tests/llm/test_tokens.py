"""BPE round trip, packing."""
from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from panelcast.llm import bpe, packing
from .conftest import frame

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
GPT = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_round_trip_equals_library(docs, rows, no_docs):
    enc = bpe.encoding(RANKS)
    got = bpe.decode_documents(bpe.encode_documents(docs, RANKS), RANKS).collect()
    want = sorted((i is None, i or 0, tuple(enc.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.encode_documents(no_docs, RANKS).count() == 0


@pytest.mark.parametrize("text", [
    "word, " * 9000, "a\n b  c\t d" * 4000, "x" * 70000, " " * 70000 + "y", "é ü 漢字 don't 12 " * 5000,
    "tail   \n" * 9000 + "   "])
def test_long_texts_cut_at_safe_boundaries(text):
    enc = bpe.encoding(RANKS)
    for size in (7, 100, 4096):
        cut = bpe.pieces(text[:20000], size)
        assert "".join(cut) == text[:20000]
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text[:20000])
    assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)


def test_decodes_ids_that_split_characters(spark):
    enc = bpe.encoding(RANKS)
    ids = enc.encode_ordinary("漢")[:1]
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode_documents(df, RANKS).collect()}
    assert got == {1: enc.decode_bytes(ids), 2: b"", 3: b""}


def _ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")


def check_pieces(pieces, want):
    """Every id in one piece, sequences gapless and within the window."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by_sequence.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW and (at == packing.WINDOW or at & (at - 1) == 0)
    assert set(by_doc) == set(want)
    for doc, parts in by_doc.items():
        ids = want[doc]
        at = 0
        for start, length, raw, n in sorted(parts):
            assert (start, n) == (at, len(ids)) and raw == ids[start:start + length].tobytes()
            at += length
        assert at == len(ids)
    return by_sequence


def test_packing_covers_every_id(spark, rows):
    own = [(k, t) for k, (_, t) in enumerate(rows)]
    own += [(1000, "say <|endoftext|> twice <|endoftext|>"), (1001, "long " * 6000)]
    want = {i: _ids(t) for i, t in own}
    for shard in (1 << 20, 3000, 1):
        shards = packing.encoded_shards(frame(spark, own), GPT, shard)
        check_pieces(packing.pack(shards).collect(), want)


def test_different_pieces_are_encoded_once(monkeypatch):
    """The ids are the library's for odd cuts, and a repeated word costs no second encoding."""
    import random
    import pyarrow as pa
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "b", "é", "漢", "'s", "1", "!", "<|endoftext|>", "\u3000", "\xa0", "\t", "\r", "\x85", "~"]
    odd = ["", " x", "x  ", "<|endoftext|> a <|endoftext|>  b", "don't  stop\r\n now ", " " * 70000 + "y z", "tail   \n" * 50, ""]
    odd += ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    enc = bpe.encoding(GPT, packing.SPECIAL)
    want = [packing.encode_ids(enc, t) + [packing.END_ID] for t in odd]
    for kept in (1 << 18, 10):
        monkeypatch.setattr(packing, "KEPT_PIECES", kept)
        ids = packing.PieceIds(enc)
        assert [x.tolist() for n in range(0, len(odd), 500) for x in ids.of(pa.array(odd).slice(n, 500))] == want

    class Counted:
        n_vocab, seen = enc.n_vocab, 0
        decode_single_token_bytes = staticmethod(enc.decode_single_token_bytes)

        def encode_ordinary(self, text):
            self.seen += len(text)
            return enc.encode_ordinary(text)
    counted = Counted()
    ids = packing.PieceIds(counted)
    for _ in range(3):
        ids.of(pa.array(["say one word " + "more words " * 1000] * 20))
    assert counted.seen < 100


def test_used_documents_are_not_scored():
    """Dropping postings changes no score of the documents that stay."""
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 30, 40)
    index = packing.ShardIndex(lengths, rng.integers(0, 50, lengths.sum()), rng.random(60), 9.0)
    before = [index.scores(q) for q in range(40)]
    kept = rng.random(40) < 0.5
    index.keep(kept)
    assert len(index.doc) < index.terms.size
    for q in range(40):
        assert np.array_equal(index.scores(q), np.where(kept, before[q], 0))


def test_packing_null_ids_and_empty(docs, rows, no_docs):
    got = packing.pack_documents(docs, GPT).collect()
    assert sum(r.length for r in got) == sum(len(_ids(t)) for _, t in rows)
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    assert packing.pack_documents(no_docs, GPT).count() == 0


def test_neighbours_are_lexical(spark):
    """Two topics in one shard: windows hold one topic as long as its documents last."""
    a, b = "alpha beta gamma delta ", "river stone cloud meadow "
    rows = [(i, (a if i % 2 else b) * 60) for i in range(40)]
    got = packing.pack_documents(frame(spark, rows).coalesce(1), GPT).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, set()).add(r.doc_id % 2)
    assert sum(len(s) == 1 for s in sequences.values()) >= 0.7 * len(sequences)


def test_neighbours_come_from_other_shards(spark):
    """Documents of a topic lie far apart in the input, more than a shard of tokens."""
    rng = np.random.default_rng(5)
    topics = [[f"{''.join(rng.choice(list('bcdfglmnprst'), 3))}{k}" for _ in range(40)] for k in range(30)]
    rows = [(i, " ".join(rng.choice(topics[i % 30], 90))) for i in range(600)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID], "<u4") for i, t in rows}
    got = packing.pack_documents(frame(spark, rows).coalesce(1), GPT, shard_tokens=10_000).collect()
    sequences = check_pieces(got, want)
    topics_of = {}
    for r in got:
        topics_of.setdefault(r.sequence_id, set()).add(r.doc_id % 30)
    full = [s for s, parts in sequences.items() if sum(n for _, n in parts) == packing.WINDOW]
    few = sum(len(topics_of[s]) <= 2 for s in full) / len(full)
    print(f"windows of at most two topics: {few:.3f}")
    assert few >= 0.5


def test_bm25_scores_against_formula():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 30, n) for n in (5, 9, 14, 3, 20)]
    lengths = np.array([len(d) for d in docs])
    idf, mean = rng.random(40), 8.5
    index = packing.ShardIndex(lengths, np.concatenate(docs), idf, mean)
    for q, query in enumerate(docs):
        want = [sum(idf[t] * (tf := (d == t).sum()) * (packing.K1 + 1)
                    / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))
                    for t in set(query) if t in d) for d in docs]
        assert np.allclose(index.scores(q), want)


@pytest.mark.parametrize("size", [1_000_000, 5_000_000])
@pytest.mark.parametrize("space", [" ", "\n", "\t", "\u3000", " \n"])
def test_long_white_space(size, space):
    """At the start, in the middle and at the end, against the tokenizers library and by round trip."""
    from panelcast.llm.bpe import encode_text, encoding
    run = (space * size)[:size]
    for text in (run + "word", "a word" + run + "x", "a word" + run) if size == 1_000_000 else ("a" + run + " b",):
        ids = packing.encode_ids(encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.SPECIAL), text)
        assert list(ids) == list(_ids(text))[:-1]
        enc = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
        assert enc.decode_bytes(encode_text(enc, text)) == text.encode()


def test_long_runs_are_matches_of_the_pattern():
    """What is cut out is what the pattern takes as one match."""
    from panelcast.llm import bpe
    for text in ("a" + " " * 70_000 + "b", " " * 70_000, "\n" * 70_000 + "\u3000x", "a \x1c" + " " * 70_000 + "!"):
        want = regex.findall(public_tokenizers.PATTERN, text)
        got = [m for run, part in bpe.without_long_runs(text) for m in ([part] if run else regex.findall(public_tokenizers.PATTERN, part))]
        assert got == want
