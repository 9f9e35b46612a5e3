"""Hashes of word shingles over whole texts, vectorised over blocks of documents."""

from __future__ import annotations

import numpy as np

from .common import mix64

STEP = 1 << 20  # bytes hashed at a time, so that memory beside a text grows with its words, not its bytes
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_B, STEP), _powers(_B_INV, STEP)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def span_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of a byte array of any length, which come in order and do not overlap; equal bytes
    have equal hashes wherever they stand."""
    edge = np.stack([start, end], 1).ravel()
    sums = np.zeros(edge.size, np.uint64)
    total = 0
    scale = 1
    for at in range(0, text.size, STEP):
        piece = text[at : at + STEP].astype(np.uint64)
        piece += np.uint64(1)
        piece *= _UP[: piece.size]
        piece *= np.uint64(scale)
        np.cumsum(piece, out=piece)
        a, b = np.searchsorted(edge, [at + 1, at + piece.size + 1])
        sums[a:b] = np.uint64(total) + piece[edge[a:b] - (at + 1)]
        total = (total + int(piece[-1])) % (1 << 64)
        scale = scale * pow(int(_B), STEP, 1 << 64) % (1 << 64)
    far = _powers(np.uint64(pow(int(_B_INV), STEP, 1 << 64)), text.size // STEP + 1)
    h = (sums[1::2] - sums[::2]) * _DOWN[start % STEP] * far[start // STEP]
    return mix64(h ^ ((end - start).astype(np.uint64) << np.uint64(40)))


def word_hashes(text: np.ndarray):
    """(start, end, hash) of each word of a byte array of any length."""
    edges = []
    last = True  # is the byte before white space?
    for at in range(0, text.size, STEP):
        white = _WHITE[text[at : at + STEP]]
        edges.append(np.flatnonzero(np.concatenate([[white[0] != last], white[1:] != white[:-1]])) + at)
        last = bool(white[-1])
    if not last:
        edges.append(np.array([text.size]))
    edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    start, end = edge[::2], edge[1::2]
    return start, end, span_hashes(text, start, end)


def shingle_hashes(texts: list[bytes], k: int):
    """(document number, word number, 63-bit hash) of each k-word shingle; a text with 1 to k - 1 words is one shingle."""
    text = np.frombuffer(b" ".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size + 1) - size - 1
    start, _, h = word_hashes(text)
    doc = np.searchsorted(at, start, "right") - 1
    words = np.bincount(doc, minlength=len(texts)) if doc.size else np.zeros(len(texts), np.int64)
    first = np.cumsum(words) - words
    m = max(0, h.size - k + 1)
    acc = np.zeros(m, np.uint64)
    for j in range(k):
        acc = (acc + h[j : j + m]) * _B
        acc ^= acc >> np.uint64(31)
    whole = np.flatnonzero(doc[:m] == doc[k - 1 : k - 1 + m]) if m else np.zeros(0, np.int64)
    docs, word, out = [doc[whole]], [whole - first[doc[whole]]], [mix64(acc[whole])]
    short = np.flatnonzero((words > 0) & (words < k))
    if short.size:
        value = np.zeros(short.size, np.uint64)
        for i, d in enumerate(short):
            v = int(words[d])
            for x in h[first[d] : first[d] + words[d]].tolist():
                v = ((v + x) * int(_B)) & 0xFFFFFFFFFFFFFFFF
                v ^= v >> 31
            value[i] = v
        docs.append(short)
        word.append(np.zeros(short.size, np.int64))
        out.append(mix64(value ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(docs), np.concatenate(word), np.concatenate(out) >> np.uint64(1), words
