"""Lexical retrieval packing: sequences of one document and its nearest unused neighbours.

Documents are encoded to byte-level BPE ids followed by an end id (cut at safe boundaries,
equal pieces encoded once), and dealt by content into
shards of a bounded number of tokens: a document's keys are the terms that KEYS weighted
minimum hashes choose, so two documents share a key as often as they share weight of terms
(the square of the inverse document frequency; terms of one document have none). Documents
are range-partitioned and sorted by their keys, and a key of more documents than a shard
holds goes on in the next ones, parted by the keys after it. Each shard is a BM25 inverted index whose terms are token ids.
Document frequencies, document count and mean length cover all documents; they are bounded
by the vocabulary, so they travel with the tasks.

Packing a shard: whole windows of a long document are sequences of their own. The rest of
each document is packed by the index: a seed (longest rest first) opens a window, its BM25
neighbours that are still unused and fit go in by rank, and the best remaining neighbour is
cut to fill the window; its own rest stays unused. What is left at a shard's end is cut
into sequences whose lengths are powers of two, so no sequence is padded.

The encoded shards are stored in the shared folder, in the order of the input and again as
dealt. Nothing else is shuffled.

Null text: as empty (the end id alone). Null ids come out as null. Repeated rows stay.
Empty tables give no rows. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CUT_CHARS, encode_long, encoding
from .common import grouped, id_out, prepare, scratch_path, texts

WINDOW = 2048
SHARD_TOKENS = 1 << 20
#: Ids fit 16 bits; a shard's document numbers too.
SHARD_DOCS = 1 << 16
END_ID = 1
SPECIAL = (("<|endoftext|>", 50256),)
K1, B = 1.2, 0.75
KEYS = 3
SHARD = ("shard long, docs binary, lengths binary, ids binary, "
         "terms array<int>, term_docs array<int>")


def encode_ids(enc, text: str) -> list[int]:
    """Ids as the tokenizers library gives them: special tokens in a text are one id."""
    special = [s for s, _ in SPECIAL if s in text]
    if len(text) <= CUT_CHARS and not special:
        return enc.encode_ordinary(text)
    return encode_long(enc, text, lambda piece: enc.encode(piece, allowed_special="all"))


#: Bytes of texts whose pieces are told apart together.
GROUP = 8 << 20
#: Pieces of texts, and ids of theirs, that a task keeps.
KEPT_PIECES, KEPT_IDS = 1 << 18, 1 << 22


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, edges) of a large binary column without nulls: value k lies between edges k
    and k + 1."""
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[edges[0]:edges[-1]] if data else np.zeros(0, np.uint8), edges - edges[0]


def cut_pieces(texts_: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces as binary, number of pieces of each text), by the texts' UTF-8 bytes.

    A text is cut before every space or newline that follows a visible ASCII character. No
    match of the splitting pattern runs from there into white space, and the pattern looks
    ahead only after white space, so the pieces encode to the ids of the whole text. Special
    tokens hold neither a space nor a newline and stay whole."""
    body, edges = _bytes_of(texts_.cast(pa.large_binary()))
    first = np.zeros(len(body) + 1, bool)
    first[1:-1] = ((body[1:] == 32) | (body[1:] == 10)) & (body[:-1] > 32) & (body[:-1] < 127)
    first[edges[:-1][np.diff(edges) > 0]] = True
    at = np.flatnonzero(first[:-1])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(body))), pa.py_buffer(body)])
    return pieces, np.diff(np.searchsorted(at, edges))


class PieceIds:
    """Ids of texts: each different piece of a batch that is not known yet is encoded once.
    Known pieces are forgotten when they are many."""

    def __init__(self, enc):
        self.enc = enc
        self.sizes = np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)])
        self._forget()

    def _forget(self):
        self.pieces, self.n, self.ids = pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece). Pieces that are cut safely at both ends are
        encoded in one string and told apart by their bytes; the others go one by one."""
        body, edges = _bytes_of(pieces)
        start, end = body[edges[:-1]], body[edges[1:] - 1]
        joined = ((start == 32) | (start == 10)) & (end > 32) & (end < 127) & (np.diff(edges) <= CUT_CHARS)
        for token, _ in SPECIAL:
            joined &= ~pc.match_substring(pieces, token).to_numpy(zero_copy_only=False)
        n, parts = np.zeros(len(pieces), np.int64), [np.zeros(0, np.uint32)]
        for k, piece in zip(np.flatnonzero(~joined), pieces.filter(pa.array(~joined)).to_pylist()):
            parts.append(np.array(encode_ids(self.enc, piece.decode()), np.uint32))
            n[k] = len(parts[-1])
        single = np.concatenate(parts)
        text, cuts = _bytes_of(pieces.filter(pa.array(joined)))
        many = np.array(self.enc.encode_ordinary(text.tobytes().decode()), np.uint32)
        done = np.cumsum(self.sizes[many])
        after = np.searchsorted(done, cuts[1:], "right")
        if not np.array_equal(done[after - 1], cuts[1:]):
            raise ValueError("a token runs over the end of a piece")
        n[joined] = np.diff(np.append(0, after))
        of_joined = np.repeat(joined, n)
        ids = np.empty(n.sum(), np.uint32)
        ids[of_joined], ids[~of_joined] = many, single
        return ids, n

    def of(self, texts_: pa.Array) -> list[np.ndarray]:
        """The ids of every text and its end id."""
        pieces, count = cut_pieces(texts_)
        coded = pieces.dictionary_encode()
        row = pc.index_in(coded.dictionary, value_set=self.pieces).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = row < 0
        if new.any():
            row[new] = len(self.pieces) + np.arange(new.sum())
            fresh = coded.dictionary.filter(pa.array(new))
            ids, n = self.encoded(fresh)
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.ids, self.n = np.concatenate([self.ids, ids]), np.concatenate([self.n, n])
        # the end id is one more piece, after the last one of each text
        flat, n = np.append(self.ids, np.uint32(END_ID)), np.append(self.n, 1)
        last = np.cumsum(count + 1) - 1
        own = np.ones(len(pieces) + len(count), bool)
        own[last] = False
        codes = np.full(len(own), len(n) - 1)
        codes[own] = row[coded.indices.to_numpy(zero_copy_only=False)]
        m = n[codes]
        after = np.cumsum(m)
        ids = flat[np.repeat((np.cumsum(n) - n)[codes] - after + m, m) + np.arange(after[-1])]
        if len(self.pieces) > KEPT_PIECES or len(self.ids) > KEPT_IDS:
            self._forget()
        return np.split(ids, after[last][:-1])


def shard_row(number: int, ids: list[int], tokens: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.array([len(t) for t in tokens], "<u4")
    flat = np.concatenate(tokens)
    own = np.unique((flat.astype(np.uint32) << np.uint32(16))
                    | np.repeat(np.arange(len(ids), dtype=np.uint32), lengths))
    terms, n = np.unique(own >> np.uint32(16), return_counts=True)
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([(task << 20) | number], pa.int64()),
         pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
         pa.array([lengths.tobytes()], pa.binary()), pa.array([flat.astype("<u2").tobytes()], pa.binary()),
         pa.array([terms], pa.list_(pa.int32())), pa.array([n], pa.list_(pa.int32()))],
        ["shard", "docs", "lengths", "ids", "terms", "term_docs"])


def shard_rows(documents, shard_tokens: int):
    """Shards of (id, token ids) in their order."""
    ids, tokens, total, number = [], [], 0, 0
    for doc_id, own in documents:
        ids.append(doc_id)
        tokens.append(own)
        total += len(own)
        if total >= shard_tokens or len(ids) == SHARD_DOCS:
            yield shard_row(number, ids, tokens)
            ids, tokens, total, number = [], [], 0, number + 1
    if ids:
        yield shard_row(number, ids, tokens)


def stored_shards(shards: DataFrame) -> DataFrame:
    target = scratch_path(shards.sparkSession, "shards")
    # small row groups: a reader holds one at a time
    shards.write.option("compression", "zstd").option("parquet.block.size", str(16 << 20)).parquet(target)
    return shards.sparkSession.read.schema(shards.schema).parquet(target)


def encoded_shards(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per shard: document ids, lengths and token ids packed as arrays, and how
    many of its documents hold each token."""
    def run(batches):
        ids = PieceIds(encoding(path, SPECIAL))
        documents = (row for group in grouped(batches, GROUP)
                     for row in zip(group.column("doc_id").to_pylist(), ids.of(pa.concat_arrays(group.column("text").chunks))))
        yield from shard_rows(documents, shard_tokens)

    return stored_shards(texts(docs).mapInArrow(run, SHARD))


def corpus_statistics(shards: DataFrame, vocabulary: int) -> tuple[np.ndarray, int, int]:
    """Document frequencies, documents and tokens of all shards, bounded by the vocabulary."""
    counts = (shards.select(F.explode(F.arrays_zip("terms", "term_docs")).alias("t"))
              .groupBy("t.terms").agg(F.sum("t.term_docs").alias("df")).collect())
    n, tokens = shards.agg(F.sum(F.octet_length("lengths") / 4), F.sum(F.octet_length("ids") / 2)).first()
    df = np.zeros(vocabulary)
    for term, d in counts:
        df[term] = d
    return df, n or 0, tokens or 0


def key_ranks(df: np.ndarray, n: int) -> np.ndarray:
    """For each key a rank of every term; a document's key is its least rank."""
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    weight = np.where(df > 1, idf ** 2, 0) + 1e-12
    draws = -np.log(1 - np.random.default_rng(0).random((KEYS, len(df)))) / weight
    return draws.argsort(axis=1).argsort(axis=1).astype(np.int32)


def routed(shards: DataFrame, shard_tokens: int = SHARD_TOKENS, vocabulary: int = 50257) -> DataFrame:
    """The same documents in shards dealt by content."""
    prepare(shards.sparkSession)
    df, n, _ = corpus_statistics(shards, vocabulary)
    ranks = key_ranks(df, n)
    keys = [f"k{j}" for j in range(KEYS)]

    def split(batches):
        for batch in batches:
            for shard, docs, lengths, ids in zip(*(batch.column(c).to_pylist() for c in
                                                   ("shard", "docs", "lengths", "ids"))):
                lengths, flat = np.frombuffer(lengths, "<u4").astype(np.int64), np.frombuffer(ids, "<u2")
                first = np.cumsum(lengths) - lengths  # every document has its end id
                least = [pa.array(np.minimum.reduceat(rank[flat], first)) for rank in ranks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(docs, "<i8")), *least, pa.array([shard] * len(lengths), pa.int64()),
                     pa.array(np.arange(len(lengths))),
                     pa.array([flat[a:a + m].tobytes() for a, m in zip(first.tolist(), lengths.tolist())], pa.binary())],
                    ["doc", *keys, "shard", "place", "ids"])

    def gather(batches):
        documents = ((doc, np.frombuffer(ids, "<u2").astype(np.uint32)) for batch in batches
                     for doc, ids in zip(batch.column("doc").to_pylist(), batch.column("ids").to_pylist()))
        yield from shard_rows(documents, shard_tokens)

    order = [*keys, "shard", "place"]  # of one key, the place parts the documents
    single = shards.select("shard", "docs", "lengths", "ids").mapInArrow(
        split, "doc long, " + ", ".join(f"{k} int" for k in keys) + ", shard long, place long, ids binary")
    return stored_shards(single.repartitionByRange(*order).sortWithinPartitions(*order)
                         .select("doc", "ids").mapInArrow(gather, SHARD))


class ShardIndex:
    """The BM25 inverted index of one shard."""

    def __init__(self, lengths: np.ndarray, ids: np.ndarray, idf: np.ndarray, mean: float):
        self.n = len(lengths)
        doc = np.repeat(np.arange(self.n, dtype=np.uint32), lengths)
        code, tf = np.unique((ids.astype(np.uint32) << np.uint32(16)) | doc, return_counts=True)
        term, self.doc = (code >> np.uint32(16)).astype(np.int64), (code & np.uint32(0xFFFF)).astype(np.int64)
        norm = K1 * (1 - B + B * lengths / mean)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.start = np.zeros(len(idf) + 1, np.int64)
        self.start[term[first] + 1] = np.diff(np.append(first, len(term)))
        self.start = np.cumsum(self.start)
        # terms of each document
        order = np.argsort(self.doc.astype(np.uint16), kind="stable")
        self.terms = term[order]
        self.at = np.searchsorted(self.doc[order], np.arange(self.n + 1))

    def keep(self, docs: np.ndarray):
        """Drop the postings of all but the documents marked in ``docs``."""
        kept = docs[self.doc]
        self.start = np.append(0, np.cumsum(kept))[self.start]
        self.doc, self.weight = self.doc[kept], self.weight[kept]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the distinct terms of ``seed``."""
        terms = self.terms[self.at[seed]:self.at[seed + 1]]
        lo, n = self.start[terms], self.start[terms + 1] - self.start[terms]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.doc[at], self.weight[at], self.n)


def pack_shard(lengths: np.ndarray, index: ShardIndex, window: int = WINDOW):
    """Pieces (document, start, length, sequence, offset) of a shard."""
    pieces_, sequence = [], 0
    start = np.zeros(len(lengths), np.int64)
    left = lengths.astype(np.int64).copy()

    def put(doc, length, offset):
        pieces_.append((doc, int(start[doc]), length, sequence, offset))
        start[doc] += length
        left[doc] -= length

    for doc in np.flatnonzero(left >= window).tolist():
        while left[doc] >= window:
            put(doc, window, 0)
            sequence += 1
    total = int(left.sum())
    order = np.argsort(-left, kind="stable").tolist()
    seeds = iter(order)
    seed = next(seeds, None)
    held = len(left)
    while total >= window:
        alive = np.count_nonzero(left)
        if alive <= 0.75 * held:  # used documents are not scored any more
            index.keep(left > 0)
            held = alive
        while not left[seed]:
            seed = next(seeds)
        n = int(left[seed])
        put(seed, n, 0)
        filled = n
        score = np.where(left > 0, index.scores(seed), -1.0)
        ranked, size = [], 32
        while filled < window:
            if not ranked:
                if size == 32 and np.count_nonzero(left) > size:
                    ranked = np.argpartition(-score, size)[:size]
                else:
                    ranked = np.arange(len(left))
                    size = len(left)
                ranked = ranked[left[ranked] > 0]
                ranked = ranked[np.lexsort((ranked, -score[ranked]))].tolist()
            best = None
            for doc in ranked:  # whole neighbours that fit, by rank
                if not left[doc]:
                    continue
                if left[doc] <= window - filled:
                    n = int(left[doc])
                    put(doc, n, filled)
                    filled += n
                    if filled == window:
                        break
                elif best is None:
                    best = doc
            if filled < window and best is not None:  # the best other one is cut
                n = window - filled
                put(best, n, filled)
                filled = window
            ranked, size = [], len(left)
        sequence += 1
        total -= window
    # the rest of the shard, in sequences of powers of two
    room = filled = 0
    for doc in order:
        while left[doc]:
            if not room:
                room = 1 << (total.bit_length() - 1)
            n = int(min(left[doc], room - filled))
            put(doc, n, filled)
            filled += n
            total -= n
            if filled == room:
                sequence += 1
                room, filled, total = 0, 0, total
    return pieces_


PIECE = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
         "sequence_id long, offset long")


def pack(shards: DataFrame, vocabulary: int = 50257, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit)."""
    prepare(shards.sparkSession)
    df, n, tokens = corpus_statistics(shards, vocabulary)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    mean = (tokens or 1) / (n or 1)

    def run(batches):
        names = [f.split()[0] for f in PIECE.split(", ")]
        for batch in batches:
            for shard, docs, lengths, ids in zip(*(batch.column(c).to_pylist() for c in
                                                   ("shard", "docs", "lengths", "ids"))):
                doc_ids, lengths = np.frombuffer(docs, "<i8"), np.frombuffer(lengths, "<u4").astype(np.int64)
                ids = np.frombuffer(ids, "<u2")
                first = np.cumsum(lengths) - lengths
                made = np.array(pack_shard(lengths, ShardIndex(lengths, ids, idf, mean), window), np.int64)
                doc, start, length, sequence, offset = made.T
                at = first[doc] + start
                wide = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[doc]), pa.array(start), pa.array(length),
                     pa.array([wide[a:b].tobytes() for a, b in zip(at.tolist(), (at + length).tolist())], pa.binary()),
                     pa.array(lengths[doc]), pa.array((shard << 22) | sequence), pa.array(offset)], names)
    return shards.select("shard", "docs", "lengths", "ids").mapInArrow(run, PIECE) \
        .withColumn("doc_id", id_out())


def pack_documents(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids binary, doc_tokens, sequence_id, offset): every id of
    every document, end id included, in exactly one piece."""
    return pack(routed(encoded_shards(docs, path, shard_tokens), shard_tokens))
