"""Rule statistics of whole texts, vectorised over blocks of documents. Null texts count as empty."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .shingles import STEP, _B, span_hashes, word_hashes

BATCH = 1 << 20
_IS = {name: np.zeros(256, bool) for name in ("symbol", "upper", "lower", "digit", "stop", "comma", "quote", "mark", "bracket", "wide")}
_IS["symbol"][[ord(c) for c in "#*$%&|<>"]] = True
_IS["upper"][ord("A") : ord("Z") + 1] = True
_IS["lower"][ord("a") : ord("z") + 1] = True
_IS["digit"][ord("0") : ord("9") + 1] = True
_IS["stop"][[ord(c) for c in "."]] = True
_IS["comma"][[ord(c) for c in ",;:"]] = True
_IS["mark"][[ord(c) for c in "!?"]] = True
_IS["bracket"][[ord(c) for c in "{}[]()=_/\\@"]] = True
_IS["quote"][[ord(c) for c in "\"'`~^+-"]] = True
_IS["wide"][0xC0:] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower", "n_digit", "n_stop", "n_comma", "n_mark", "n_bracket", "n_quote", "n_wide", "n_short", "n_long", "n_capital", "n_same_next", "n_top_word")


def _per(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n).astype(np.int64)


def _by_bytes(is_: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes of a class in each text; texts begin at `at`, and each has one byte at least."""
    out = np.zeros(at.size, np.int64)
    for a in range(0, text.size, STEP):
        first = np.searchsorted(at, a, "right") - 1
        cut = np.maximum(at[first : np.searchsorted(at, a + STEP)] - a, 0)
        out[first : first + cut.size] += np.add.reduceat(is_[text[a : a + STEP]], cut, dtype=np.int64)
    return out


def _code_points(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points in the spans [start, end), which come in order and do not overlap."""
    edge = np.stack([start, end], 1).ravel()
    sums, total = np.zeros(edge.size, np.int64), 0
    for at in range(0, text.size, STEP):
        lead = np.cumsum((text[at : at + STEP] & 0xC0) != 0x80)
        a, b = np.searchsorted(edge, [at + 1, at + lead.size + 1])
        sums[a:b] = total + lead[edge[a:b] - (at + 1)]
        total += int(lead[-1])
    return sums[1::2] - sums[::2]


def _repeats(doc: np.ndarray, value: np.ndarray):
    """For (doc, value) pairs: sorted order, first index and size of each run of equal pairs."""
    by = np.lexsort((value, doc))
    d, v = doc[by], value[by]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])])) if by.size else np.zeros(0, np.int64)
    return by, first, np.diff(np.append(first, by.size))


def counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """COUNTS of each text, as int64 arrays."""
    n = len(texts)
    text = np.frombuffer(b"".join(t + b"\n" for t in texts) if n > 1 else b"\n".join([*texts, b""]), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size + 1) - size - 1
    of = lambda pos: np.searchsorted(at, pos, "right") - 1
    start, end, h = word_hashes(text)
    doc = of(start)
    out = {"n_words": _per(doc, n)}
    length = _code_points(text, start, end)
    out["word_chars"] = np.bincount(doc, length, minlength=n).astype(np.int64)
    for name in ("symbol", "upper", "lower", "digit", "stop", "comma", "mark", "bracket", "quote"):
        out["n_symbols" if name == "symbol" else f"n_{name}"] = _by_bytes(_IS[name], text, at)
    out["n_wide"] = _by_bytes(_IS["wide"], text, at)
    out["n_short"] = _per(doc[length <= 3], n)
    out["n_long"] = _per(doc[length >= 14], n)
    out["n_capital"] = _per(doc[_IS["upper"][text[start]]], n)
    same = (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
    out["n_same_next"] = _per(doc[1:][same], n)
    by, first, runs = _repeats(doc, h)
    out["n_distinct"] = _per(doc[by[first]], n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc[by[first]], runs)
    out["n_top_word"] = top
    # Lines: between line feeds, which also end the texts here.
    l_end = np.flatnonzero(text == 10)
    l_start = np.concatenate([[0], l_end[:-1] + 1]) if n else l_end
    with_word = np.searchsorted(start, l_end, "left") > np.searchsorted(start, l_start, "left")
    l_start, l_end = l_start[with_word], l_end[with_word]
    l_doc = of(l_start)
    out["n_lines"] = _per(l_doc, n)
    by, first, _ = _repeats(l_doc, span_hashes(text, l_start, l_end))
    out["n_dup_lines"] = out["n_lines"] - _per(l_doc[by[first]], n)
    # Words inside five-word windows that occur twice or more in their text.
    m = max(0, h.size - 4)
    acc = np.zeros(m, np.uint64)
    for j in range(5):
        acc = (acc + h[j : j + m]) * _B
        acc ^= acc >> np.uint64(31)
    window = np.flatnonzero(doc[:m] == doc[4 : 4 + m]) if m else np.zeros(0, np.int64)
    by, first, runs = _repeats(doc[window], acc[window])
    twice = window[by[np.repeat(runs > 1, runs)]]
    mark = np.zeros(h.size + 6, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + 5, -1)
    out["n_repeat_words"] = _per(doc[np.cumsum(mark)[: h.size] > 0], n)
    return out


FEATURES = ("log_words", "word_len", "symbols", "dup_lines", "repeats", "distinct", "upper", "digit", "stop", "comma", "mark", "bracket", "quote", "wide", "short", "long", "capital", "same_next", "top_word", "line_words")


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """The statistics as ratios, one column each of FEATURES; all are finite, and 0 for empty texts."""
    words = np.maximum(c["n_words"], 1).astype(float)
    chars = np.maximum(c["word_chars"], 1).astype(float)
    lines = np.maximum(c["n_lines"], 1).astype(float)
    letters = np.maximum(c["n_upper"] + c["n_lower"] + c["n_wide"], 1).astype(float)
    cols = [
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_distinct"] / words,
        c["n_upper"] / letters, c["n_digit"] / chars, c["n_stop"] / words, c["n_comma"] / words, c["n_mark"] / words, c["n_bracket"] / chars, c["n_quote"] / chars,
        c["n_wide"] / letters, c["n_short"] / words, c["n_long"] / words, c["n_capital"] / words, c["n_same_next"] / words, c["n_top_word"] / words, np.log1p(c["n_words"] / lines),
    ]
    return np.stack([np.asarray(x, float) for x in cols], 1)


def in_blocks(column: pa.Array, most: int = BATCH) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of a string column, at most about `most` bytes at a time."""
    first, texts, held = 0, [], 0
    for i, t in enumerate(column):
        body = t.as_buffer().to_pybytes() if t.is_valid else b""
        if texts and held + len(body) > most:
            yield first, texts
            first, texts, held = i, [], 0
        texts.append(body)
        held += len(body)
    if texts:
        yield first, texts


def batch_counts(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [counts(texts) for _, texts in in_blocks(column)]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in COUNTS}
