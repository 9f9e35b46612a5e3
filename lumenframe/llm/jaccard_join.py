"""Exact Jaccard self-join of documents' word shingles with a token-group matrix.

1. The distinct shingles of each part of the input go to token buckets, which count in how many documents a shingle
   occurs. A shingle that several documents of a part share goes there once, with their number; which ones they are waits
   where the answers of that part return. A bucket therefore gets a shingle at most once from each part, however
   common it is. A shingle of one document can be in no intersection, so only repeated ones return; a document
   with less than the threshold's share of repeated shingles has no partner and is done.
2. Documents with the same repeated shingles and the same set size behave alike towards all others: one class.
3. Shingles are ordered rarest first. Two linked classes share one of the first r - ceil(t n) + 1 repeated shingles.
   Each class is checked against the likeliest leader (least class) of these; the links found partition similar
   documents into groups.
4. Token-group matrix: a class that shares such a shingle with another group is a query of that group. The overlap of
   its shingles with the union of the group's shingles bounds its overlap with any member; only groups whose bound
   reaches ceil(t n) are opened, and their members that share a leading shingle are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import buckets_for, discard, mix64, pack, partitions_for, place, plain, unpack, with_row_ids, written
from .components import components
from .shingles import shingle_hashes

BATCH = 1 << 20
_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("data", pa.binary())])
TOKENS, DOCS, COPIES, LOCAL, ANSWERS = 0, 1, 2, 3, 4


def _bits(buckets: int) -> int:
    return max(7, (buckets - 1).bit_length())


def _narrow(tok: np.ndarray, bits: int) -> np.ndarray:
    """The low 63 - bits bits of each token as bytes."""
    low = tok & np.uint64((1 << (63 - bits)) - 1)
    return np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8)[:, : (63 - bits + 7) // 8]).ravel()


def _widen(body: np.ndarray, bucket: int, bits: int) -> np.ndarray:
    width = (63 - bits + 7) // 8
    out = np.zeros((body.size // width, 8), np.uint8)
    out[:, :width] = body.reshape(-1, width)
    return out.view(np.uint64).ravel() | np.uint64(bucket << (63 - bits))


def _emit(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int8()), pa.array([r[2] for r in rows], pa.binary())], schema=_SCHEMA
    )


def _cuts(sorted_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if sorted_key.size else np.zeros(0, np.int64)
    return first, np.append(first[1:], sorted_key.size)


def set_sums(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent order-free 64-bit sums of each run of values."""
    a = mix64(value ^ np.uint64(0x243F6A8885A308D3))
    b = mix64(value + np.uint64(0x13198A2E03707344))
    return np.add.reduceat(a, first), np.add.reduceat(b, first)


def _part(rids: list[int], texts: list[bytes], k: int, bits: int) -> pa.RecordBatch:
    """What a part ships: its documents and equal copies, and the shingles that several of them share, to the bucket of its
    address, where the answers return; its shingles to their token buckets."""
    rid = np.array(rids, np.int64)
    home = int(mix64(rid[:1].view(np.uint64))[0] >> np.uint64(64 - bits))
    doc, _, tok, _ = shingle_hashes(texts, k)
    by = np.lexsort((tok, doc))
    doc, tok = doc[by], tok[by]
    keep = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tok[1:] != tok[:-1])]) if doc.size else np.zeros(0, bool)
    doc, tok = doc[keep], tok[keep]
    n = np.bincount(doc, minlength=rid.size)
    rows: list[tuple[int, int, bytes]] = []
    rep = np.arange(rid.size)
    full = np.flatnonzero(n > 0)
    if full.size:
        first = (np.cumsum(n) - n)[full]
        a, b = set_sums(tok, first)
        order = np.lexsort((rid[full], n[full], b, a))
        same = np.concatenate([[False], (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1]) & (n[full][order][1:] == n[full][order][:-1])])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(order.size)))
        rep[full[order]] = full[order[head]]
    own = rep == np.arange(rid.size)
    rows.append((home, DOCS, pack(rid[own], n[own].astype(np.int64))))
    if not own.all():
        rows.append((home, COPIES, pack(rid[~own], rid[rep[~own]], n[~own].astype(np.int64))))
    mine = own[doc]
    doc, tok = doc[mine], tok[mine]
    by = np.argsort(tok, kind="stable")
    doc, tok = doc[by], tok[by]
    first, last = _cuts(tok)
    many = last - first
    shared = np.repeat(many > 1, many)
    if shared.any():
        rows.append((home, LOCAL, pack(tok[first[many > 1]], many[many > 1].astype(np.uint32), rid[doc[shared]])))
    # One entry for each shingle: the document that has it, or the number of those that do.
    doc, tok = np.where(many > 1, -1, doc[first]) if first.size else doc, tok[first]
    bucket = (tok >> np.uint64(63 - bits)).astype(np.int32)
    by = np.lexsort((doc, bucket))
    doc, tok, many = doc[by], tok[by], many[by]
    for s, e in zip(*_cuts(bucket[by])):
        t = s + int(np.searchsorted(doc[s:e], 0))
        f, z = _cuts(doc[t:e])
        body = pack(
            np.array([home], np.int32), rid[doc[t:e][f]], (z - f).astype(np.uint32), _narrow(tok[t:e], bits), _narrow(tok[s:t], bits), many[s:t].astype(np.uint32)
        )
        rows.append((int(tok[s] >> np.uint64(63 - bits)), TOKENS, body))
    return _emit(rows)


def _ship(k: int, bits: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, texts, held = [], [], 0
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = text.as_buffer().to_pybytes().lower() if text.is_valid else b""
                if held and held + len(body) > batch_bytes:
                    yield _part(rids, texts, k, bits)
                    rids, texts, held = [], [], 0
                rids.append(rid)
                texts.append(body)
                held += len(body) + 1
        if rids:
            yield _part(rids, texts, k, bits)

    return run


def _grouped(batches: Iterator[pa.RecordBatch]):
    """Rows ordered by bucket as (bucket, [(kind, data)]), one bucket at a time."""
    current, held = None, []
    for batch in batches:
        for b, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if b != current and held:
                yield current, held
                held = []
            current = b
            held.append((kind, data.as_py()))
    if held:
        yield current, held


def _count_tokens(bits: int):
    """Token buckets: to each address, its shingles that two or more documents have, with that number."""

    def back(home: np.ndarray, kind: int, *cols: np.ndarray) -> list[tuple[int, int, bytes]]:
        by = np.argsort(home, kind="stable")
        return [(int(home[by[a]]), kind, pack(*(c[by[a:z]] for c in cols))) for a, z in zip(*_cuts(home[by]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in _grouped(batches):
            passed = [(bucket, kind, data) for kind, data in held if kind != TOKENS]
            if passed:
                yield _emit(passed)
            blocks = [unpack(data) for kind, data in held if kind == TOKENS]
            if not blocks:
                continue
            rid = np.concatenate([np.repeat(r, c) for _, r, c, _, _, _ in blocks])
            one = [_widen(t, bucket, bits) for _, _, _, t, _, _ in blocks]
            some = [_widen(t, bucket, bits) for _, _, _, _, t, _ in blocks]
            home = np.array([h[0] for h, *_ in blocks], np.int32)
            home_one, home_some = np.repeat(home, [t.size for t in one]), np.repeat(home, [t.size for t in some])
            tok = np.concatenate([*one, *some])
            number = np.concatenate([np.ones(rid.size, np.int64), *(c.astype(np.int64) for *_, c in blocks)])
            by = np.argsort(tok)
            first, last = _cuts(tok[by])
            df = np.empty(tok.size, np.int64)
            df[by] = np.repeat(np.add.reduceat(number[by], first), last - first)
            df = np.minimum(df, 0xFFFFFFFF).astype(np.uint32)
            many = np.flatnonzero(df[: rid.size] > 1)
            out = back(home_one[many], TOKENS, rid[many], tok[many], df[many]) + back(home_some, ANSWERS, tok[rid.size :], df[rid.size :])
            if out:
                yield _emit(out)

    return run


_SETS = "rid long, n long, rep long, r long, a long, b long, lead int, toks array<long>"


def _sets(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _grouped(batches):
            by_kind: dict[int, list] = {TOKENS: [], DOCS: [], COPIES: [], LOCAL: [], ANSWERS: []}
            for kind, data in held:
                by_kind[kind].append(unpack(data))
            rows: dict[str, list] = {c.split()[0]: [] for c in _SETS.split(", ")}

            def put(rid, n, rep=None, r=0, a=None, b=None, lead=0, toks=None):
                for name, v in zip(rows, (rid, n, rep, r, a, b, lead, toks)):
                    rows[name].append(v)

            for rid, rep, n in by_kind[COPIES]:
                for x, y, z in zip(rid.tolist(), rep.tolist(), n.tolist()):
                    put(x, z, y)
            size = {}
            for rid, n in by_kind[DOCS]:
                size.update(zip(rid.tolist(), n.tolist()))
            seen = set()
            if by_kind[LOCAL]:  # the documents that share a shingle take its answer
                known, number = (np.concatenate(c) for c in zip(*by_kind[ANSWERS]))
                order = np.argsort(known)
                known, number = known[order], number[order]
                for tok, count, rid in by_kind[LOCAL]:
                    df = number[np.searchsorted(known, tok)]
                    by_kind[TOKENS].append((rid, np.repeat(tok, count), np.repeat(df, count)))
            if by_kind[TOKENS]:
                rid, tok, df = (np.concatenate(c) for c in zip(*by_kind[TOKENS]))
                by = np.lexsort((tok, df, rid))
                rid, tok = rid[by], tok[by]
                first, last = _cuts(rid)
                a, b = set_sums(tok, first)
                for i, (s, e) in enumerate(zip(first.tolist(), last.tolist())):
                    d, r = int(rid[s]), e - s
                    need = -(-num * size[d] // den)
                    if r >= need:
                        seen.add(d)
                        put(d, size[d], None, r, int(a[i].astype(np.int64)), int(b[i].astype(np.int64)), r - need + 1, tok[s:e].astype(np.int64))
            for d, n in size.items():
                if d not in seen:
                    put(d, n)
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))

    return run


def shingle_sets(docs: DataFrame, rid: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """One row a document: set size n, rep (an equal set met in the same part, else null) and, where it may have a
    partner, its repeated shingles rarest first, their order-free sums and how many of them lead."""
    buckets = 1 << _bits(buckets_for(docs))
    bits = _bits(buckets)
    parts = partitions_for(docs.sparkSession, buckets)
    schema = "bucket int, kind byte, data binary"
    # In an order of their own, rows make up the same parts when a lost task runs again: a part's address is its first row's.
    shipped = docs.select(F.col(rid), F.col(text).cast("binary")).sortWithinPartitions(rid).mapInArrow(_ship(k, bits, BATCH), schema)
    counted = shipped.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_count_tokens(bits), schema)
    return counted.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_sets(num, den), _SETS)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y) whose Jaccard similarity reaches num / den."""
    x = sets.select(F.col("rid").alias("x"), F.col("n").alias("xn"), F.col("toks").alias("xt"))
    y = sets.select(F.col("rid").alias("y"), F.col("n").alias("yn"), F.col("toks").alias("yt"))
    both = F.size(F.array_intersect("xt", "yt"))
    return (
        pairs.select("x", "y").join(x, "x").join(y, "y")
        .withColumn("o", both)
        .filter(den * F.col("o") >= num * (F.col("xn") + F.col("yn") - F.col("o")))
        .select("x", "y")
    )


def jaccard_links(sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(v, component) of linked classes and (rid, cls, inner, n) of all documents that may have partners."""
    scratch: list[str] = []
    near = sets.filter("toks is not null")
    key = ["a", "b", "n", "r"]
    cls = near.groupBy(*key).agg(F.min("rid").alias("cls"), F.count("*").alias("members"))
    member = near.select("rid", *key).join(cls, key).select(
        "rid", "cls", "n", ((F.col("members") > 1) & (den * F.col("r") >= num * (2 * F.col("n") - F.col("r")))).alias("inner")
    )
    reps = written(near.join(member.filter("rid = cls").select("rid"), "rid", "left_semi").select("rid", "n", "r", "toks", "lead"), "classes", scratch)
    # `left`: shingles from this place on. The smaller of two linked sets shares one of its first
    # r - ceil(2 t n / (1 + t)) + 1 shingles, so only those (`index`) need to be met by the larger one's.
    head = reps.select("rid", "n", "r", F.posexplode(F.slice("toks", 1, F.col("lead"))).alias("p", "tok"))
    head = written(
        head.select("rid", "n", "tok", (F.col("r") - F.col("p")).alias("left"), (F.col("p") <= F.col("r") - F.ceil(2 * num * F.col("n") / (num + den))).alias("index")), "heads", scratch
    )
    fits = lambda p, q: (den * F.col(p) >= num * F.col(q)) & (den * F.col(q) >= num * F.col(p))
    # The first shingle that a linked pair shares has at least the needed overlap from its place on in both sets.
    reach = lambda a, b, m, n: F.least(a, b) * (num + den) >= num * (F.col(m) + n)
    # Leaders: the least class of each leading shingle; a class tries the one it shares most of them with.
    lead = head.groupBy("tok").agg(F.min(F.struct("rid", "n")).alias("l"), F.count("*").alias("c")).filter("c > 1")
    star = (
        head.join(lead.select("tok", F.col("l.rid").alias("y"), F.col("l.n").alias("yn")), "tok")
        .filter(F.col("rid") != F.col("y")).filter(fits("n", "yn"))
        .groupBy(F.col("rid").alias("x"), "y").agg(F.count("*").alias("c"))
        .groupBy("x").agg(F.max(F.struct("c", F.negative("y").alias("m"))).alias("best"))
        .select("x", F.negative("best.m").alias("y"))
    )
    links = written(_verified(star, reps, num, den), "links", scratch)
    group = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    placed = written(
        head.join(group, head.rid == group.v, "left").select("tok", "rid", "n", "left", "index", F.coalesce("component", "rid").alias("g")), "placed", scratch
    )
    # Cells of the matrix: the groups of a shingle with the sizes and the most that is left of their members there.
    cell = placed.filter("index").groupBy("tok", F.col("g").alias("h")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("rest"))
    query = written(
        placed.join(
            cell, (placed.tok == cell.tok) & (F.col("g") != F.col("h")) & (F.col("least") <= F.col("n")) & (den * F.col("most") >= num * F.col("n"))
            & reach("left", "rest", "n", F.greatest(F.col("least"), F.ceil(num * F.col("n") / den))),
        ).select(F.col("rid").alias("x"), "h").distinct(),
        "queries",
        scratch,
    )
    if not query.head(1):
        discard(reps.sparkSession, scratch)
        return group, member
    # Bound: shingles of the query inside the union of the group's shingles.
    grouped = reps.join(group, reps.rid == group.v, "left").select("rid", "toks", F.coalesce("component", "rid").alias("h"))
    union = grouped.join(query.select("h").distinct(), "h").select("h", F.explode("toks").alias("tok")).distinct()
    bound = (
        query.join(reps.select(F.col("rid").alias("x"), "n", F.explode("toks").alias("tok")), "x")
        .join(union, ["h", "tok"]).groupBy("x", "h", "n").agg(F.count("*").alias("o"))
        .filter(den * F.col("o") >= num * F.col("n")).select("x", "h")
    )
    opened = written(bound, "opened", scratch)
    # Members of opened groups that share a leading shingle with the query and may reach the overlap from there.
    asking = placed.select(F.col("rid").alias("x"), F.col("n").alias("xn"), F.col("left").alias("xl"), "tok").join(opened, "x")
    inside = placed.filter("index").select(F.col("rid").alias("y"), F.col("n").alias("yn"), F.col("left").alias("yl"), F.col("g").alias("gh"), F.col("tok").alias("yt"))
    pairs = asking.join(
        inside, (F.col("h") == F.col("gh")) & (F.col("tok") == F.col("yt")) & (F.col("yn") <= F.col("xn")) & (den * F.col("yn") >= num * F.col("xn")) & reach("xl", "yl", "xn", F.col("yn"))
    ).select("x", "y").distinct()
    more = _verified(pairs, reps, num, den)
    final = components(links.unionByName(more).select(F.col("x").alias("a"), F.col("y").alias("b")))
    discard(reps.sparkSession, scratch)  # what is returned reads the sets and the last labels only
    return final, member


def component_rows(base: DataFrame, k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(rid, n, top) for rows with _rid and _text: set size and the least row of the component."""
    sets = written(shingle_sets(base, "_rid", "_text", k, num, den), "sets")
    linked, member = jaccard_links(sets, num, den)
    return (
        sets.select("rid", "n", F.coalesce("rep", "rid").alias("r"))
        .join(member.select(F.col("rid").alias("r"), "cls", "inner"), "r", "left")
        .join(linked, F.col("cls") == F.col("v"), "left")
        .select("rid", "n", F.when(F.col("component").isNotNull(), F.col("component")).when(F.col("inner"), F.col("cls")).otherwise(F.col("r")).alias("top"))
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One row for each input row: id, n_shingles, component_id (the least id reachable by links, itself included).

    Two rows link when the Jaccard similarity of their sets of k-word shingles is at least num / den. Words are runs
    of anything but U+0020 and U+0009-000D, with A-Z in lower case; a text of fewer than k words has one shingle, and
    null texts and texts without a word have none and link with nothing. Shingles are told apart by 63 bits of a hash; all
    else is exact. Ids may be of any type that sorts; rows that repeat an id are separate rows;
    rows with a null id come before all others, and a component that holds one has a null id. An empty table gives an
    empty result; other columns, whatever their names, are not looked at. All links count, in groups of any size.
    """
    base = plain(docs).select(F.col(place(docs, id_col)).alias("_id"), F.col(place(docs, text_col)).alias("_text"))
    base = with_row_ids(base, "_id", "_text")
    ids = base.select("_rid", "_id")
    return (
        component_rows(base, k, num, den).join(ids.select(F.col("_rid").alias("rid"), F.col("_id").alias(id_col)), "rid")
        .join(ids.select(F.col("_rid").alias("top"), F.col("_id").alias("component_id")), "top")
        .select(id_col, F.col("n").alias("n_shingles"), "component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """The rows of docs, all columns, of which each component has one left: that of the least id (and text)."""
    base = with_row_ids(plain(docs), place(docs, id_col), place(docs, text_col))
    rows = component_rows(base.select("_rid", F.col(place(docs, text_col)).alias("_text")), k, num, den)
    kept = base.join(rows.filter("rid = top").select(F.col("rid").alias("_rid")), "_rid", "left_semi")
    return kept.drop("_rid").toDF(*docs.columns)
