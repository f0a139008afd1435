"""Byte-level BPE encoding and decoding with a local rank file.

``encode_documents`` runs the tiktoken library on whole texts. A long text is first cut
at safe boundaries: between an ASCII letter, digit or punctuation mark and a following
space or newline. No match of the splitting pattern runs from a visible character into
white space, and the pattern looks ahead only after white space, so the pieces encode to
the same ids as the whole. White space of LONG_RUN characters or more, too long for the
library's pattern, is cut out first: at the end of a text it is one match of the pattern,
elsewhere all but its last character is, which stays with the text after it.
``decode_documents`` joins the raw bytes of the ids.

Null ids of documents return as null. Texts of any length are encoded whole. Null text: as empty (no ids). Null ids array: as empty. Ids outside the vocabulary raise.
Repeated rows stay; extra columns are ignored. An empty table gives an empty table.
"""
from __future__ import annotations

import base64
import functools
import re

import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_out, prepare, texts

#: Texts longer than this many characters are cut before encoding.
CUT_CHARS = 65_536
#: White space of so many characters is encoded by itself.
LONG_RUN = 65_536
_RUN = regex.compile(r"\p{White_Space}{%d,}" % LONG_RUN)
_BOUNDARY = re.compile(r"(?<=[!-~])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(path: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 token and rank a line), one per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=dict(special))


def pieces(text: str, size: int = CUT_CHARS) -> list[str]:
    """Cut a long text at safe boundaries, at least ``size`` characters apart."""
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size:
        cut = _BOUNDARY.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


def without_long_runs(text: str) -> list[tuple[bool, str]]:
    """(whether it is one match of the pattern, part) in order."""
    out, at = [], 0
    for run in _RUN.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += [(False, text[at:run.start()]), (True, text[run.start():end])]
        at = end
    return [*out, (False, text[at:])]


def encode_long(enc: tiktoken.Encoding, text: str, encode) -> list[int]:
    """Ids of a long text: ``encode`` takes the pieces between long runs of white space."""
    return [i for run, part in without_long_runs(text)
            for piece in ([part] if run else pieces(part))
            for i in (enc._encode_single_piece(piece) if run else encode(piece))]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= CUT_CHARS:
        return enc.encode_ordinary(text)
    return encode_long(enc, text, enc.encode_ordinary)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id long, ids array<int>): one row per document."""
    def run(batches):
        enc = encoding(path)
        for batch in batches:
            ids = [encode_text(enc, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    out = texts(docs).mapInArrow(run, "doc_id long, ids array<int>")
    return out.select(id_out().alias("doc_id"), "ids")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the raw bytes of the ids, also where they are not
    whole UTF-8 characters."""
    def run(batches):
        enc = encoding(path)
        for batch in batches:
            decoded = [enc.decode_bytes(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])
    prepare(encoded.sparkSession)
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
