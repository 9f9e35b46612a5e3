"""SentencePiece encoding and decoding with a forward pass over the shared prefixes of distinct words.

A text's marked words (white space shown as U+2581) are cut where no piece can cross. The distinct words of a block are
sorted, which walks their trie depth-first, and the forward states of a common prefix are kept for the next word.

Unigram models: the forward state of a prefix is its best score (Viterbi). BPE models: maximal score sums do not give
the ids of the merge rules, so the forward state is the last piece of the prefix's encoding instead. A piece may follow
another only where the merge rules give just these two pieces for both together, which makes the path unique.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import kept_columns, place, plain

MARK = "▁"
BLOCK = 2 << 20
CACHED_WORDS, CACHED_PAIRS, LONGEST_CACHED = 250_000, 400_000, 64
_UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in model files


def _fields(raw: bytes):
    """(number, value) of each field of a protocol-buffer message; values are int, or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class PieceModel:
    """Pieces with scores and kinds, and the options of the text's preparation."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int
    prefix: bool = True
    trim: bool = False
    index: dict[str, int] = field(default_factory=dict)
    unk: int = 0
    bytes_at: dict[int, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, raw: bytes) -> "PieceModel":
        out = cls([], [], [], UNIGRAM)
        out.trim = True
        for number, value in _fields(raw):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        (score,) = struct.unpack("<f", v)
                    elif n == 3:
                        kind = v
                out.pieces.append(piece)
                out.scores.append(score)
                out.kinds.append(kind)
            elif number == 2:
                out.model = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                out.prefix, out.trim = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                if spec.get(2) or not spec.get(5, 1):
                    raise ValueError("only models without character maps and with escaped white space are supported")
        if out.model not in (UNIGRAM, BPE) or USER in out.kinds:
            raise ValueError("only unigram and BPE models without user-defined symbols are supported")
        # Texts are cut before each run of marks and around line feeds, so no piece may reach across such a place.
        if any("\n" in p and p != "\n" or MARK in p.lstrip(MARK) for p, k in zip(out.pieces, out.kinds) if k == NORMAL):
            raise ValueError("only models whose pieces have marks at their beginning and no line feeds are supported")
        return out.indexed()

    def indexed(self) -> "PieceModel":
        self.index = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.unk = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.bytes_at = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        return self


class Codec:
    """Encoder and decoder; keeps what it learned about pairs of pieces and the words it met."""

    def __init__(self, model: PieceModel):
        self.m = model
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.cost = {p: -model.scores[k] for p, k in model.index.items()}
        self.trie: dict = {}  # by character; "" holds a piece's id
        for piece, k in model.index.items():
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = k
        self.floor = min((s for s, k in zip(model.scores, model.kinds) if k == NORMAL), default=0.0) - 10.0
        text = [p.replace(MARK, " ").encode() for p in model.pieces]
        for b, i in model.bytes_at.items():
            text[i] = bytes([b])
        for i, k in enumerate(model.kinds):
            if k == CONTROL:
                text[i] = b""
            elif k == UNKNOWN:
                text[i] = " ⁇ ".encode()
        self.text = text

    def merged(self, chars: str) -> list[str]:
        """The merge rules as they stand: the best-scored neighbours first, then the leftmost."""
        index, scores = self.m.index, self.m.scores
        part = list(chars)
        n = len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int):
            if i >= 0 and j < n:
                both = part[i] + part[j]
                k = index.get(both)
                if k is not None:
                    heapq.heappush(heap, (-scores[k], i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if right[i] != j or part[i] + part[j] != both or not part[i] or not part[j]:
                continue
            part[i], part[j] = both, ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p]

    def merged_short(self, chars: str) -> list[str]:
        """The same for a few characters, by looking through all neighbours at each step."""
        cost, none = self.cost, float("inf")
        part = list(chars)
        pair = [cost.get(x + y, none) for x, y in zip(part, part[1:])]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = cost.get(part[i - 1] + part[i], none)
            if i < len(pair):
                pair[i] = cost.get(part[i] + part[i + 1], none)
        return part

    def _fit(self, a: int, b: int) -> bool:
        """May piece b follow a (or stand first or after an unknown character: a is -1)?"""
        found = self.fits.get((a, b))
        if found is None:
            x, y = "" if a < 0 else self.m.pieces[a], self.m.pieces[b]
            found = self.fits[a, b] = self.merged_short(x + y) == ([x, y] if x else [y])
        return found

    def sorted_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of sorted distinct words; -1 - c stands for a character c without a piece.

        Beside the forward states, each prefix keeps the places of the piece trie that its ends may still grow from."""
        scores, root, floor, fit = self.m.scores, self.trie, self.floor, self._fit
        bpe, fits = self.m.model == BPE, self.fits
        last, back, best = [-1], [0], [0.0]
        grow: list[list[tuple[int, dict]]] = [[]]
        before = ""
        for word in words:
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], back[same + 1 :], best[same + 1 :], grow[same + 1 :]
            for i in range(same, len(word)):
                ch = word[i]
                alive = [(j, n[ch]) for j, n in grow[i] if ch in n]
                if ch in root:
                    alive.append((i, root[ch]))
                found, at = -1 - ord(ch), i
                if bpe:  # the longest piece comes first
                    for j, n in alive:
                        k = n.get("")
                        if k is not None:
                            p = last[j]
                            if p < 0:
                                p = -1
                            ok = fits.get((p, k))
                            if ok or ok is None and fit(p, k):
                                found, at = k, j
                                break
                    best.append(0.0)
                else:
                    score = best[i] + floor
                    for j, n in alive:
                        k = n.get("")
                        if k is not None and best[j] + scores[k] > score:
                            found, at, score = k, j, best[j] + scores[k]
                    best.append(score)
                last.append(found)
                back.append(at)
                grow.append(alive)
            ids, i = [], len(word)
            while i:
                ids.append(last[i])
                i = back[i]
            before = word
            yield word, ids[::-1]

    def _packed(self, ids: list[int]) -> bytes:
        out, unknown = [], False
        for k in ids:
            if k >= 0:
                out.append(k)
                unknown = False
            elif self.m.bytes_at:
                out += [self.m.bytes_at[b] for b in chr(-1 - k).encode()]
            elif not unknown:  # neighbouring unknown characters are one unknown piece
                out.append(self.m.unk)
                unknown = True
        return array("i", out).tobytes()

    def units(self, text: str) -> list[str]:
        if self.m.trim:
            text = re.sub(" +", " ", text.replace(MARK, " ")).strip(" ")
        if not text:
            return []
        return _UNITS.findall((MARK if self.m.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed int32."""
        units = [self.units(t) for t in texts]
        if len(self.fits) > CACHED_PAIRS:
            self.fits.clear()
        known = self.words
        new = {w for u in units for w in u} - known.keys()
        if len(known) + len(new) > CACHED_WORDS:
            new |= {w for u in units for w in u}
            known = self.words = {}
        odd = [w for w in new if w.startswith(MARK + MARK)] if self.m.model == BPE else []
        for w in odd:  # runs of marks may have equal scores: the rules decide by place
            known[w] = self._packed([self.m.index.get(p, -1 - ord(p[0])) for p in self.merged(w)])
        for w, ids in self.sorted_words(sorted(new.difference(odd))):
            known[w] = self._packed(ids)
        out = [b"".join([known[w] for w in u]) for u in units]
        if new and max(map(len, new)) > LONGEST_CACHED:
            for w in [w for w in new if len(w) > LONGEST_CACHED]:
                del known[w]
        return out

    def decode(self, ids: np.ndarray) -> str:
        text = self.text
        if ids.size and (ids.min() < 0 or ids.max() >= len(text)):
            raise ValueError(f"ids are from 0 to {len(text) - 1}, but there are {ids.min()} and {ids.max()}")
        body = b"".join([text[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return body[1:] if self.m.prefix and body.startswith(" ") else body


_CODECS: dict[int, Codec] = {}


def _codec(model: PieceModel) -> Codec:
    """One codec for each model and worker, so that words met in earlier tasks are known."""
    key = hash((len(model.pieces), model.pieces[-1] if model.pieces else "", model.model))
    if key not in _CODECS or _CODECS[key].m.pieces != model.pieces:
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    first, texts, held = 0, [], 0
    for i, t in enumerate(column):
        body = t.as_py()
        size = len(body) if body else 0
        if texts and held + size > BLOCK:
            yield first, texts
            first, texts, held = i, [], 0
        texts.append(body)
        held += size
    if texts:
        yield first, texts


def encode_pieces(docs: DataFrame, model: PieceModel, text_col: str = "text") -> DataFrame:
    """docs with ids (array of int), n_tokens, and round_trip (decoding gives the prepared text back) added.

    Whole texts are encoded; null and empty texts have no ids, and n_tokens 0. Every row keeps its columns, repeated rows
    included; columns of the three names, whatever their case, are replaced; an empty table gives an empty result. U+2581
    in a text counts as a space, as the model's preparation has it.
    """
    added = ("ids", "n_tokens", "round_trip")
    keep, places = kept_columns(docs, added)
    names = [*places, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for first, texts in _blocks(batch.column(len(keep))):
                texts = [t or "" for t in texts]
                packed = codec.encode(texts)
                offsets = np.cumsum([0, *[len(p) // 4 for p in packed]])
                flat = np.frombuffer(b"".join(packed), np.int32)
                trips = []
                for t, p in zip(texts, packed):
                    want = t.replace(MARK, " ")
                    trips.append(codec.decode(np.frombuffer(p, np.int32)) == (re.sub(" +", " ", want).strip(" ") if model.trim else want))
                cols = [batch.column(i).slice(first, len(texts)) for i in range(len(keep))]
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*cols, ids, pa.array(np.diff(offsets), pa.int64()), pa.array(trips, pa.bool_())], names=names)

    rows = plain(docs)
    src = rows.select(*places, F.col(place(docs, text_col)).alias("_text"))
    schema = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in places) + "ids array<int>, n_tokens long, round_trip boolean"
    return src.mapInArrow(run, schema).toDF(*keep, *added)


def decode_pieces(rows: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """rows with the text of their ids; null ids give null, and a null among the ids counts as none. Ids outside the model,
    negative ones too, raise an error. A column named like the result, whatever its case, is replaced."""
    keep, places = kept_columns(rows, (out_col,))
    names = [*places, "_out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            texts = [codec.decode(np.array([i for i in v.as_py() if i is not None], np.int64)) if v.is_valid else None for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(texts, pa.string())], names=names)

    named = plain(rows)
    src = named.select(*places, F.col(place(rows, ids_col)).alias("_ids"))
    schema = "".join(f"{c} {named.schema[c].dataType.simpleString()}, " for c in places) + "_out string"
    return src.mapInArrow(run, schema).toDF(*keep, out_col)
