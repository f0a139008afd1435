"""Substring dedup by seed and extend: remove each word under a window of 50 consecutive
words that also starts in a document with a smaller id.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Seeds are winnowed anchors of eight words;
documents meet on equal anchors (``repeats``). A seed is extended to both sides over the
words that a 50-word window round it can hold, for all documents that share it at once:
windows at the same seed and offset are equal when their word hashes and then their bytes
are. Adjoining equal windows join to maximal repeats of at least 50 words. Windows are
judged on the input, and every copy but the one in the smallest document is removed.

Null text: no words. Null ids count as the largest; of repeated ids, no row removes words
of another. Empty tables give no rows. Extra columns are ignored or carried along.
"""
from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import id_out

_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _rest(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    """The text without the removed words and the white space after them; the other white
    space stays as it is."""
    words = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for a, b in removed:
        out.append(data[at:words[a][0]])
        at = words[b][0] if b < len(words) else len(data)
    return b"".join([*out, data[at:]])


def _finish(unit, docs: pa.Table, answers: pa.Table, layout: bool) -> pa.Table:
    ids, raw, order = repeats.ordered(docs)
    data = [unit.prepare(d) for d in raw]
    bounds = [unit.symbols(d) for d in data]
    lengths = np.array([len(s) for s, _ in bounds], np.int64)
    mask = repeats.removed_mask(unit, lengths, answers)
    spans, kept, at = [], [], 0
    for whole, d, (s, e) in zip(raw, data, bounds):
        m = mask[at:at + len(s)]
        at += len(s)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], m.view(np.int8), [0])))).tolist()
        removed = list(zip(edge[::2], edge[1::2]))
        spans.append([{"start": a, "end": b} for a, b in removed])
        if layout:
            kept.append(_rest(whole, removed) if removed else whole)
        else:
            stay = zip([0, *edge[1::2]], [*edge[::2], len(s)])
            kept.append(b" ".join(d[s[a]:e[b - 1]] for a, b in stay if a < b) if removed else d)
    columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(spans, _SPAN),
               pa.array(kept, pa.binary()).cast(pa.string())]
    names = ["doc_id", "n_words", "removed", "kept"]
    if "carry" in docs.column_names:
        columns.append(docs.column("carry").take(pa.array(order)))
        names.append("carry")
    return pa.table(columns, names=names)


SCHEMA = "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept string"


def substring_dedup(docs: DataFrame, carry: list[str] | None = None, layout: bool = False) -> DataFrame:
    """(doc_id, n_words, removed array<struct<start,end>> in words, kept string): the
    maximal repeats removed from every document, and its other words joined by a space, or
    with ``layout`` by the white space that was there. ``carry``: columns of ``docs`` to
    hand through, as struct ``carry``."""
    schema = SCHEMA
    if carry:
        schema += ", carry " + docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("c")
                                           ).schema["c"].dataType.simpleString()
    out = repeats.removed_windows(docs, repeats.WORDS_50, repeats.by_hash,
                                  functools.partial(_finish, layout=layout), schema, carry)
    return out.withColumn("doc_id", id_out())
