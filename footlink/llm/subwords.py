"""Hashed features of words and of the byte n-grams inside them."""

from __future__ import annotations

import numpy as np

from footlink.llm import text as T


def subword_hashes(buf: np.ndarray, bounds: np.ndarray, sizes: tuple[int, ...], codes: np.ndarray,
                   bigrams: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word and of every n-gram of ``sizes`` bytes
    inside a word (one at a word's start differs from one inside). With
    ``bigrams``, also of every two neighbouring words, by the difference of
    their hashes: a repeated word gives the same feature whatever it is."""
    start, end, first = T.runs((~T.IS_SPACE[buf]).view(np.uint8), bounds)
    word = T.run_hashes(buf, start, end, codes)
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(first))
    out, owner = [word], [doc]
    # Byte codes are folded n at a time, so no running sum over the text is kept.
    code = codes[buf]
    at_end = np.zeros(len(buf), np.int64)
    if len(start):
        at_end[start] = end - np.concatenate([[0], end[:-1]])
        np.cumsum(at_end, out=at_end)                       # end of the word that a byte belongs to
    head = np.zeros(len(buf), bool)
    head[start] = True
    byte_doc = None
    for n in sizes:
        at = np.flatnonzero((~T.IS_SPACE[buf])[:max(len(buf) - n + 1, 0)] & (np.arange(max(len(buf) - n + 1, 0)) + n
                                                                           <= at_end[:max(len(buf) - n + 1, 0)]))
        h = np.full(len(at), n, T.U64) + head[at].astype(T.U64) * T.U64(1 << 32)
        for i in range(n):
            h *= T.U64(0xD1342543DE82EF95)
            h += code[at + i]
        if byte_doc is None:
            byte_doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        out.append(T.mix(h))
        owner.append(byte_doc[at])
    if bigrams and len(word) > 1:
        same = doc[1:] == doc[:-1]
        out.append(T.mix((word[1:] - word[:-1])[same] + T.U64(0xB16)))
        owner.append(doc[1:][same])
    return np.concatenate(out), np.concatenate(owner)
