"""Removal of byte strings that occur earlier in the corpus, by blockwise suffix sorting with a difference cover.

Every window of `length` bytes is a suffix cut at `length`. Windows are dealt to suffix buckets by content: the
smallest hash of the k-byte strings inside a window (its anchor) names the bucket, so equal windows always meet.
Anchors are counted before any text moves, and windows of anchors that occur once are done. Each part of the input
then sorts its own repeated windows, keeps one of each and ships what is left; a bucket therefore gets at most one copy
of a window from each part, however often a passage repeats.

However many parts ship a passage to one bucket, the bucket takes them in bites and keeps one copy of each window after
every bite, so what a task holds grows with its distinct windows only.

A bucket is sorted by itself: its text is laid out once, the positions p with p mod 31 in a difference cover are
ranked on their first length - 30 bytes, its windows are sorted on their first and last 32 bytes, and windows that
still tie are split around pivots by comparing the cover ranks at the shift, of at most 30, that the cover guarantees
for the pair of residues. Head, ranked middle and tail overlap, so equal ranks mean equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import buckets_for, mix64, pack, partitions_for, place, plain, plain_size, ranges, unpack, with_row_ids

#: A perfect difference cover modulo 31.
COVER_PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

BLOCK = 1 << 20  # bytes hashed at a time
BATCH = 4 << 20  # bytes deduplicated among themselves before anything is shipped
SUFFIXES = 1 << 18  # windows sorted at a time
BITE = 24 << 20  # bytes of a bucket taken in before its windows are reduced to one of each
_POS_BITS = np.uint64(21)
_POS_MASK = np.uint64((1 << 21) - 1)

_IN_COVER = np.full(COVER_PERIOD, -1, np.int64)
_IN_COVER[list(COVER)] = np.arange(len(COVER))
#: _SHIFT[a, b]: the least d with a + d and b + d both in the cover.
_SHIFT = np.array(
    [
        [next(d for d in range(COVER_PERIOD) if (a + d) % COVER_PERIOD in COVER and (b + d) % COVER_PERIOD in COVER) for b in range(COVER_PERIOD)]
        for a in range(COVER_PERIOD)
    ],
    np.int64,
)


def _gram(length: int) -> int:
    """Bytes of the strings whose hashes name the buckets: a multiple of 8, about a third of the window."""
    return 8 * max(1, length // 24)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number; the end is padded with zeros."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((text.size + 1,), ">u8", padded.data, 0, (1,))


def _anchors(text: np.ndarray, seg_at: np.ndarray, seg_len: np.ndarray, length: int):
    """Anchors of all windows inside the segments of one block: (hash, position, first start, number of starts)."""
    k = _gram(length)
    w = length - k + 1
    n = text.size
    empty = np.zeros(0, np.int64)
    full = seg_len >= length
    if n < length or not full.any():
        return empty.astype(np.uint64), empty, empty, empty
    words = np.ndarray((n - 7,), "<u8", text.data, 0, (1,)).astype(np.uint64)
    m = n - k + 1
    h = np.zeros(m, np.uint64)
    for j in range(0, k, 8):
        h ^= words[j : j + m] * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = (h & ~_POS_MASK) | np.arange(m, dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        low = np.minimum(low[: low.size - span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[: low.size - (w - span)], low[w - span :])
    starts = ranges(seg_at[full], seg_len[full] - length + 1)
    at = (low[starts] & _POS_MASK).astype(np.int64)
    cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate([[0], cut])
    count = np.diff(np.concatenate([first, [starts.size]]))
    return h[at[first]], at[first], starts[first], count


class _Records:
    """Runs of windows that share an anchor: key, row id, first start in the row, windows, anchor's offset, bytes."""

    def __init__(self, key, rid, pos, n, aoff, text, at):
        self.key, self.rid, self.pos, self.n, self.aoff, self.text, self.at = key, rid, pos, n, aoff, text, at

    def take(self, i: np.ndarray) -> "_Records":
        return _Records(self.key[i], self.rid[i], self.pos[i], self.n[i], self.aoff[i], self.text, self.at[i])

    def blocks(self, length: int) -> bytes:
        size = self.n + (length - 1)
        return pack(self.key, self.rid, self.pos.astype(np.uint32), self.n.astype(np.uint16), self.aoff.astype(np.uint16), self.text[ranges(self.at, size)])

    @staticmethod
    def load(blocks: list[bytes], length: int) -> "_Records":
        cols = [unpack(b) for b in blocks]
        key, rid, pos, n, aoff, text = (np.concatenate(c) for c in zip(*cols))
        n = n.astype(np.int64)
        size = n + (length - 1)
        return _Records(key, rid, pos.astype(np.int64), n, aoff.astype(np.int64), text, np.cumsum(size) - size)


def _split(order: np.ndarray, group: np.ndarray, value: np.ndarray):
    """Sort within groups by value; returns the new order, group numbers and values, groups of one dropped."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([first, [group.size]]))
    mixed_group = np.logical_or.reduceat(value != np.repeat(value[first], size), first)
    if mixed_group.any():
        mixed = np.repeat(mixed_group, size)
        where = np.flatnonzero(mixed)
        by = where[np.lexsort((value[where], group[where]))]
        order, value = order.copy(), value.copy()
        order[where], value[where] = order[by], value[by]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])])
        first = np.flatnonzero(new)
        size = np.diff(np.concatenate([first, [group.size]]))
    keep = np.repeat(size > 1, size)
    size = size[size > 1]
    return order[keep], np.repeat(np.arange(size.size), size)


def _cover_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks, by their first `depth` bytes, of the positions whose residue is in the cover, in order of position."""
    base = np.arange(0, text.size + COVER_PERIOD, COVER_PERIOD)
    at = (base[:, None] + np.array(COVER)[None, :]).ravel()
    padded = np.concatenate([text, np.zeros(COVER_PERIOD * 2 + depth + 8, np.uint8)])
    words = _words(padded)
    value = words[at].astype(np.uint64)
    order = np.argsort(value)
    value = value[order]
    rank = np.zeros(at.size, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.concatenate([begin, [value.size]]))
    rank[order] = np.repeat(begin, size)
    done = 8
    live = np.repeat(size > 1, size)
    order = order[live]
    while done < depth and order.size:
        step = min(8, depth - done)
        value = words[at[order] + done].astype(np.uint64)
        if step < 8:
            value >>= np.uint64(8 * (8 - step))
        group = rank[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([first, [group.size]]))
        mixed_group = np.logical_or.reduceat(value != np.repeat(value[first], size), first)
        if mixed_group.any():
            where = np.flatnonzero(np.repeat(mixed_group, size))
            by = where[np.lexsort((value[where], group[where]))]
            order[where], value[where] = order[by], value[by]
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])])
            begin = np.flatnonzero(new)
            head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            offset = np.arange(group.size) - np.repeat(head, np.diff(np.concatenate([head, [group.size]])))
            size = np.diff(np.concatenate([begin, [group.size]]))
            rank[order] = np.repeat(group[begin] + offset[begin], size)
            keep = np.repeat(size > 1, size)
            order = order[keep]
        done += step
    return rank


def _later_windows(recs: _Records, length: int) -> np.ndarray:
    """For the records' windows, laid end to end: does the same window start earlier among them? Records in (rid, pos) order."""
    n = recs.n
    size = n + (length - 1)
    text = recs.text[ranges(recs.at, size)]
    at = np.cumsum(size) - size
    rec = np.repeat(np.arange(n.size), n)
    t = ranges(np.zeros(n.size, np.int64), n)
    start = at[rec] + t
    bucket = recs.key[rec] + (recs.aoff[rec] - t).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(bucket)
    sorted_bucket = bucket[order]
    new = np.concatenate([[True], sorted_bucket[1:] != sorted_bucket[:-1]])
    run = np.diff(np.concatenate([np.flatnonzero(new), [order.size]]))
    keep = np.repeat(run > 1, run)
    order = order[keep]
    run = run[run > 1]
    group = np.repeat(np.arange(run.size), run)
    later = np.zeros(rec.size, bool)
    words = _words(text)
    for done in (0, 8, 16, 24, length - 32, length - 24, length - 16, length - 8):
        if not order.size:
            return later
        order, group = _split(order, group, words[start[order] + done].astype(np.uint64))
    if not order.size:
        return later
    ranks = _cover_ranks(text, length - COVER_PERIOD + 1)
    while order.size:
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([first, [group.size]]))
        here, pivot = start[order], np.repeat(start[order[first]], size)
        shift = _SHIFT[here % COVER_PERIOD, pivot % COVER_PERIOD]
        here, pivot = here + shift, pivot + shift
        of = len(COVER)
        side = np.sign(
            ranks[here // COVER_PERIOD * of + _IN_COVER[here % COVER_PERIOD]]
            - ranks[pivot // COVER_PERIOD * of + _IN_COVER[pivot % COVER_PERIOD]]
        )
        same = side == 0
        members = order[same]
        head = np.flatnonzero(np.concatenate([[True], group[same][1:] != group[same][:-1]]))
        least = np.minimum.reduceat(members, head)
        later[members] = True
        later[least] = False
        rest = ~same
        if not rest.any():
            break
        sub = group[rest] * 2 + (side[rest] > 0)
        by = np.argsort(sub, kind="stable")
        order, sub = order[rest][by], sub[by]
        size = np.diff(np.concatenate([np.flatnonzero(np.concatenate([[True], sub[1:] != sub[:-1]])), [sub.size]]))
        keep = np.repeat(size > 1, size)
        order = order[keep]
        size = size[size > 1]
        group = np.repeat(np.arange(size.size), size)
    return later


def _by_bucket(recs: _Records, length: int):
    """Yield (records, later) for chunks of whole keys that occur more than once, SUFFIXES windows or so at a time."""
    by = np.argsort(recs.key, kind="stable")
    key = recs.key[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([first, [key.size]]))
    by = by[np.repeat(size > 1, size)]
    size = size[size > 1]
    if not size.size:
        return
    load = np.add.reduceat(recs.n[by], np.cumsum(size) - size)
    chunk = (np.cumsum(load) - load) // SUFFIXES
    chunk = np.repeat(chunk, size)
    for c in np.unique(chunk):
        own = np.sort(by[chunk == c])
        if recs.n[own].sum() <= 4 * SUFFIXES:
            yield own, _later_windows(recs.take(own), length)
            continue
        later = np.zeros(int(recs.n[own].sum()), bool)  # one crowded bucket: its windows meet only at the same offset
        base = np.cumsum(recs.n[own]) - recs.n[own]
        for off in range(int(recs.aoff[own].max()) + 1):
            t = recs.aoff[own] - off
            has = (t >= 0) & (t < recs.n[own])
            part = recs.take(own[has])
            t = t[has]
            one = _Records(part.key, part.rid, part.pos + t, np.ones(t.size, np.int64), np.zeros(t.size, np.int64), part.text, part.at + t)
            later[base[has] + t] = _later_windows(one, length)
        yield own, later


def _runs(recs: _Records, own: np.ndarray, flags: np.ndarray):
    """Runs of set flags within records: (record, first window, windows)."""
    rec = np.repeat(own, recs.n[own])
    t = ranges(np.zeros(own.size, np.int64), recs.n[own])
    on = np.flatnonzero(flags)
    if not on.size:
        return (np.zeros(0, np.int64),) * 3
    cut = np.flatnonzero((np.diff(on) != 1) | (np.diff(rec[on]) != 0)) + 1
    first = np.concatenate([[0], cut])
    return rec[on[first]], t[on[first]], np.diff(np.concatenate([first, [on.size]]))


def _spans(recs: _Records, own: np.ndarray, later: np.ndarray, length: int):
    rec, t, n = _runs(recs, own, later)
    start = recs.pos[rec] + t
    return recs.rid[rec], start, start + n + (length - 1)


def _rows_of_spans(parts: list, buckets: int):
    """Spans as one row a document: (bucket, rid, int64 pairs)."""
    if not parts:
        return [], [], []
    rid, start, end = (np.concatenate(c) for c in zip(*parts))
    by = np.lexsort((start, rid))
    rid, pairs = rid[by], np.stack([start[by], end[by]], 1).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]])) if rid.size else []
    ends = np.append(first[1:], rid.size) if rid.size else []
    return [int(r) % buckets for r in rid[first]] if rid.size else [], [int(r) for r in rid[first]] if rid.size else [], [pairs[a:b].tobytes() for a, b in zip(first, ends)]


_PART = pa.schema([("bucket", pa.int32()), ("rid", pa.int64()), ("data", pa.binary())])


def _limits(values: tuple[int, int, int, int]) -> None:
    """Workers take the driver's limits."""
    global BLOCK, BATCH, SUFFIXES, BITE
    BLOCK, BATCH, SUFFIXES, BITE = values


def _segments(rid: int, text: bytes, length: int):
    """Pieces of at most BLOCK bytes that overlap by length - 1, so that each window lies in exactly one."""
    at = 0
    while len(text) - at >= length:
        yield rid, at, text[at : at + BLOCK]
        at += max(1, BLOCK - length + 1)


class _Anchored:
    """Anchors of whole texts that come one after another."""

    def __init__(self, length: int):
        self.length, self.cols, self.bodies, self.base, self.block, self.filled = length, [], [], 0, [], 0

    def _flush(self):
        if not self.block:
            return
        text = np.frombuffer(b"".join(b for _, _, b in self.block), np.uint8)
        size = np.array([len(b) for _, _, b in self.block], np.int64)
        seg_at = np.cumsum(size) - size
        key, at, lo, n = _anchors(text, seg_at, size, self.length)
        seg = np.searchsorted(seg_at, lo, "right") - 1
        rid = np.array([r for r, _, _ in self.block], np.int64)[seg]
        off = np.array([o for _, o, _ in self.block], np.int64)[seg]
        self.cols.append((key, rid, off + lo - seg_at[seg], n, at - lo, lo + self.base))
        self.bodies.append(text)
        self.base += text.size
        self.block, self.filled = [], 0

    def add(self, rid: int, text: bytes):
        for s in _segments(rid, text, self.length):
            if self.filled + len(s[2]) > BLOCK and self.block:
                self._flush()
            self.block.append(s)
            self.filled += len(s[2])

    def records(self) -> "_Records":
        self._flush()
        if not self.cols:
            none = np.zeros(0, np.int64)
            return _Records(none.astype(np.uint64), none, none, none, none, np.zeros(0, np.uint8), none)
        key, rid, pos, n, aoff, at = (np.concatenate(c) for c in zip(*self.cols))
        return _Records(key, rid, pos, n, aoff, np.concatenate(self.bodies), at)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(44)) % np.uint64(buckets)).astype(np.int64)


_SHORT = np.uint64((1 << 40) - 1)  # with the bucket, what tells anchors apart while they are counted; a clash only adds work


def _cuts(sorted_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if sorted_key.size else np.zeros(0, np.int64)
    return first, np.append(first[1:], sorted_key.size)


def _marks(rid: np.ndarray, key: np.ndarray) -> tuple[list[int], list[bytes]]:
    by = np.argsort(rid, kind="stable")
    first, last = _cuts(rid[by])
    short = (key & _SHORT)[by]
    return [int(r) for r in rid[by[first]]], [short[a:z].tobytes() for a, z in zip(first, last)]


def _count_part(rec: _Records, buckets: int) -> pa.RecordBatch:
    """Anchors met more than once in this part are marked at once; each anchor is shipped for its first row only."""
    by = np.lexsort((rec.rid, rec.key))
    key, rid = rec.key[by], rec.rid[by]
    first, last = _cuts(key)
    many = np.repeat(last - first > 1, last - first)
    r_col, d_col = _marks(rid[many], key[many])
    b_col = [r % buckets for r in r_col]
    key, rid = key[first], rid[first]
    bucket = _bucket(key, buckets)
    by = np.lexsort((rid, bucket))
    key, rid, bucket = key[by], rid[by], bucket[by]
    for a, z in zip(*_cuts(bucket)):
        b_col.append(int(bucket[a]))
        r_col.append(None)
        short = np.ascontiguousarray(key[a:z].view(np.uint8).reshape(-1, 8)[:, :5]).ravel()
        d_col.append(pack(rid[a:z], short))
    return pa.RecordBatch.from_arrays([pa.array(b_col, pa.int32()), pa.array(r_col, pa.int64()), pa.array(d_col, pa.binary())], schema=_PART)


def _count_anchors(length: int, buckets: int):
    limits = (BLOCK, BATCH, SUFFIXES, BITE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limits(limits)
        part, held = _Anchored(length), 0
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid or len(body := text.as_buffer().to_pybytes()) < length:
                    continue
                if held and held + len(body) > BATCH:
                    yield _count_part(part.records(), buckets)
                    part, held = _Anchored(length), 0
                part.add(rid, body)
                held += len(body)
        if held:
            yield _count_part(part.records(), buckets)

    return run


def _by_bucket_rows(batches: Iterator[pa.RecordBatch]):
    """From rows ordered by bucket: ("pass", rids, datas) for rows that only pass, ("bucket", datas) for each bucket."""
    held, current = [], None
    for batch in batches:
        rids, datas = [], []
        for b, rid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if rid is not None:
                rids.append(rid)
                datas.append(data.as_py())
                continue
            if b != current and held:
                yield "bucket", held, None
                held = []
            current = b
            held.append(data.as_py())
        if rids:
            yield "pass", rids, datas
    if held:
        yield "bucket", held, None


def _out(rids: list[int], datas: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(datas, pa.binary())], names=["rid", "data"])


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for kind, a, b in _by_bucket_rows(batches):
        if kind == "pass":
            yield _out(a, b)
            continue
        cols = [unpack(x) for x in a]
        rid = np.concatenate([r for r, _ in cols])
        short = np.concatenate([k for _, k in cols]).reshape(-1, 5)
        key = np.zeros((rid.size, 8), np.uint8)
        key[:, :5] = short
        key = key.view(np.uint64).ravel()
        by = np.argsort(key)
        first, last = _cuts(key[by])
        many = by[np.repeat(last - first > 1, last - first)]
        if many.size:
            yield _out(*_marks(rid[many], key[many]))


def _reduced(recs: _Records, length: int) -> tuple[list, _Records]:
    """Spans of the windows that start earlier among the records, and records of all other windows."""
    spans, whole, extra = [], np.ones(recs.key.size, bool), []
    for own, later in _by_bucket(recs, length):
        if later.any():
            spans.append(_spans(recs, own, later, length))
            touched = own[np.logical_or.reduceat(later, np.cumsum(recs.n[own]) - recs.n[own])]
            whole[touched] = False
            r, t, m = _runs(recs, own, ~later)
            mine = ~whole[r]
            extra.append((r[mine], t[mine], m[mine]))
    keep = np.flatnonzero(whole)
    src, t, m = (np.concatenate(c) for c in zip((keep, np.zeros(keep.size, np.int64), recs.n[keep]), *extra))
    return spans, _Records(recs.key[src], recs.rid[src], recs.pos[src] + t, m, recs.aoff[src] - t, recs.text, recs.at[src] + t)


def _dedup_part(rec: _Records, marks: np.ndarray, length: int, buckets: int) -> pa.RecordBatch | None:
    """What one part of the input ships: its spans that repeat inside it, and its other windows by bucket."""
    rec = rec.take(np.flatnonzero(np.isin(_tag(rec.rid, rec.key), marks)))
    recs = rec.take(np.lexsort((rec.pos, rec.rid)))
    if not recs.key.size:
        return None
    spans, out = _reduced(recs, length)
    bucket = _bucket(out.key, buckets)
    by = np.lexsort((out.pos, out.rid, bucket))
    b_col, r_col, d_col = _rows_of_spans(spans, buckets)
    for a, z in zip(*_cuts(bucket[by])):
        b_col.append(int(bucket[by[a]]))
        r_col.append(None)
        d_col.append(out.take(by[a:z]).blocks(length))
    return pa.RecordBatch.from_arrays([pa.array(b_col, pa.int32()), pa.array(r_col, pa.int64()), pa.array(d_col, pa.binary())], schema=_PART)


def _tag(rid: np.ndarray, key: np.ndarray) -> np.ndarray:
    return mix64(rid.view(np.uint64)) ^ (key & _SHORT)


def _ship(length: int, buckets: int):
    limits = (BLOCK, BATCH, SUFFIXES, BITE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limits(limits)
        part, marks, held = _Anchored(length), [], 0

        def flush():
            return _dedup_part(part.records(), np.concatenate(marks), length, buckets)

        for batch in batches:
            for rid, text, mark in zip(batch.column("_rid").to_pylist(), batch.column("_bytes"), batch.column("_marks")):
                if not mark.is_valid or not len(mark) or not text.is_valid:
                    continue
                body = text.as_buffer().to_pybytes()
                if held and held + len(body) > BATCH:
                    if (out := flush()) is not None:
                        yield out
                    part, marks, held = _Anchored(length), [], 0
                part.add(rid, body)
                short = np.frombuffer(b"".join(mark.as_py()), np.uint64)
                marks.append(_tag(np.full(short.size, rid, np.int64), short))
                held += len(body)
        if held and (out := flush()) is not None:
            yield out

    return run


def _sort_buckets(length: int, buckets: int):
    """Rows arrive ordered by bucket; one bucket is held at a time, in bites."""
    limits = (BLOCK, BATCH, SUFFIXES, BITE)

    def taken_in(before: bytes | None, blocks: list[bytes]) -> tuple[pa.RecordBatch | None, _Records]:
        recs = _Records.load([before, *blocks] if before else blocks, length)
        spans, left = _reduced(recs.take(np.lexsort((recs.pos, recs.rid))), length)
        rows = _rows_of_spans(spans, buckets)
        return _out(rows[1], rows[2]) if rows[1] else None, left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _limits(limits)
        current, before, blocks, size, most = None, None, [], 0, BITE
        for batch in batches:
            rids, datas = [], []
            for b, rid, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if rid is not None:
                    rids.append(rid)
                    datas.append(data.as_py())
                    continue
                if b != current:
                    if blocks and (out := taken_in(before, blocks)[0]) is not None:
                        yield out
                    current, before, blocks, size, most = b, None, [], 0, BITE
                blocks.append(data.as_py())
                size += plain_size(blocks[-1])
                if size > most:
                    out, left = taken_in(before, blocks)
                    if out is not None:
                        yield out
                    before, blocks, size = left.blocks(length), [], 0
                    most = max(BITE, plain_size(before))  # work stays linear where little repeats
            if rids:
                yield _out(rids, datas)
        if blocks and (out := taken_in(before, blocks)[0]) is not None:
            yield out

    return run


def _by_row(base: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """base with the data found for each row as an array; both uses ask for the same columns, so base moves once."""
    gathered = found.groupBy("rid").agg(F.collect_list("data").alias(name))
    return base.join(gathered.hint("shuffle_hash"), F.col("_rid") == F.col("rid"), "left").drop("rid")


def repeated_spans(base: DataFrame, length: int = 100) -> DataFrame:
    """(rid, data): byte spans, as little-endian int64 pairs, covered by windows that start earlier in the corpus.

    base has _rid and _bytes. Anchors are counted first, so that only text around repeated anchors is shipped."""
    if length < 40:
        raise ValueError("length must be at least 40 bytes")
    buckets = buckets_for(base)
    parts = partitions_for(base.sparkSession, buckets)
    schema = "bucket int, rid long, data binary"
    dealt = lambda df: df.repartition(parts, "bucket").sortWithinPartitions("bucket")
    marks = dealt(base.select("_rid", "_bytes").mapInArrow(_count_anchors(length, buckets), schema)).mapInArrow(_repeated_anchors, "rid long, data binary")
    # A row order of their own makes the parts the same when a lost task runs again: what a part keeps depends on its rows.
    shipped = _by_row(base, marks, "_marks").sortWithinPartitions("_rid").mapInArrow(_ship(length, buckets), schema)
    return dealt(shipped).mapInArrow(_sort_buckets(length, buckets), "rid long, data binary")


def _merge(datas: list[bytes]) -> np.ndarray:
    pairs = np.concatenate([np.frombuffer(d, np.int64).reshape(-1, 2) for d in datas])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], pairs.shape[0]) - 1
    return np.stack([pairs[first, 0], reach[last]], 1)


def _cut(with_kept: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, data = batch.column("_bytes"), batch.column("_spans")
            n_bytes, n_removed, n_spans, sha, spans, kept = [], [], [], [], [], []
            for t, d in zip(text, data):
                body = t.as_buffer().to_pybytes() if t.is_valid else b""
                n_bytes.append(len(body))
                cut = _merge(d.as_py()) if d.is_valid and len(d) else np.zeros((0, 2), np.int64)
                removed = 0
                if len(cut):
                    removed = int((cut[:, 1] - cut[:, 0]).sum())
                    edges = [0, *cut.ravel().tolist(), len(body)]
                    body = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                n_removed.append(removed)
                n_spans.append(len(cut))
                sha.append(hashlib.sha256(body).hexdigest())
                spans.append(cut.ravel().tolist())
                kept.append(body)
            keep = [batch.column(c) for c in names]
            extra = [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.int64()))]
            labels = [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
            if with_kept:
                extra.append(pa.array(kept, pa.binary()))
                labels.append("kept")
            yield pa.RecordBatch.from_arrays(keep + extra, names=labels)

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, with_kept: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every byte that a `length`-byte string covers which also starts earlier (smaller id, or earlier in the row).

    Returns one row for each input row: the id, the columns of `carry`, n_bytes, n_removed, n_spans, kept_sha256,
    removed (the maximal removed runs as start, end, start, end ...) and, if asked for, kept (remaining bytes).

    Texts are UTF-8 bytes and matches never cross rows. Null and empty texts, and those shorter than `length`, lose
    nothing; a null text counts as empty. Ids may be of any type that sorts; rows with a null id come before all others. Rows that repeat an id count as
    separate rows in the order of their text. Strings are judged on the input, not on what is left. An empty table
    gives an empty result; other columns of the input are not looked at, whatever their names.
    """
    base = plain(docs).select(
        F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_text"), *[F.col(place(docs, c)).alias(f"_c{i}") for i, c in enumerate(carry)]
    )
    base = with_row_ids(base, "_id", "_text")
    base = base.withColumn("_bytes", F.col("_text").cast("binary")).drop("_text")
    joined = _by_row(base, repeated_spans(base, length), "_spans")
    names = ["_id", *[f"_c{i}" for i in range(len(carry))]]
    types = {f.name: f.dataType.simpleString() for f in base.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in names)
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>" + (", kept binary" if with_kept else "")
    out = joined.select(*names, "_bytes", "_spans").mapInArrow(_cut(with_kept, names), schema)
    return out.toDF(id_col, *carry, *out.columns[len(names) :])
