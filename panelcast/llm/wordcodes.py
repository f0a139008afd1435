"""Words of whole texts as dictionary codes, without a Python object a word.

A word is a maximal run of digits, letters and characters beyond ASCII; only A-Z are
lower-cased. All other ASCII characters separate words, so UTF-8 bytes can be handled one
by one.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WORD = [48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]
#: Separators become spaces, A-Z small letters.
FOLD = bytes(32 if not _WORD[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array(_WORD)


def count_words(texts: pa.Array) -> np.ndarray:
    """Number of words of each text."""
    texts = texts.cast(pa.binary())
    offsets = np.asarray(pa.array(texts).buffers()[1]).view(np.int32)[texts.offset:][:len(texts) + 1]
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
    inside = _IN_WORD[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets - offsets[0]
    starts = at[:-1][np.diff(at) > 0]  # a word may go on from the text before
    first[starts] = inside[starts]
    running = np.concatenate([[0], np.cumsum(first)])
    return running[at[1:]] - running[at[:-1]]


def word_codes(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(dictionary of distinct words, code of each word, number of words of each text)."""
    folded = pa.array([t.translate(FOLD) for t in texts], pa.large_binary()).cast(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(folded))
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words = split.values
    empty = np.asarray(pc.equal(pc.binary_length(words), 0))  # a text without words gives one empty string
    if empty.any():
        lengths = lengths - np.bincount(np.repeat(np.arange(len(lengths)), lengths)[empty], minlength=len(lengths))
        words = words.filter(pa.array(~empty))
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lengths


def fold_words(text: str | None) -> list[str]:
    """The words of one text."""
    return [w.decode() for w in (text or "").encode().translate(FOLD).split()]
