"""Remove byte strings of a fixed length that also start in an earlier document.

Windows of 50 bytes are grouped in passes in which equal groups alone go on; no suffix is put into
order. To keep a pass smaller than the text, windows that share an anchor travel together: the
anchor of a window is the least-hashed of its 12-byte strings, so equal windows have equal
anchors, and a run of windows with one anchor is a region.

1. By the anchor's 12 bytes. Groups held by one document end here.
2. By the whole region. A region that a smaller document has too goes entirely. Of the
   rest, those go on that share the 19 bytes to one side of the anchor with another document, as
   any two equal windows do.
3. By the 50-byte windows of these regions, whose bytes are compared.

A task first drops what it finds repeated in its own input, so a passage that many documents
share leaves each task once. Passes group by hashes: 40 bits for anchors and 16 for the sides, which
only select, 48 more for regions (88 with the anchor's), 64 for windows, which are then compared. They travel
as packed arrays, one row for each bucket of anchors.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from msgledger.llm.common import small_batches, stage_table, utf8

LENGTH = 50
GRAM = 12  # the shorter, the fewer regions
SIDE = (LENGTH - GRAM) // 2
PIECE = 1 << 19  # bytes hashed at a time
HELD = 500_000  # regions a task collects before it sends them
BUCKET = 1_000_000  # regions of a bucket, about
FINER = 3  # bits by which the buckets of open regions, whose every window is held, are smaller
REMOVED, OPEN = 1, 2
REGION_BITS = 48
U = np.uint64
_NONE = np.zeros(0, np.int64)
FACTOR = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Hasher:
    """Hashes of any stretch of a piece of text from one running sum."""

    def __init__(self, size: int = PIECE):
        def powers(base: int) -> np.ndarray:
            out = np.full(size + 1, base, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.up = powers(FACTOR)
        self.down = powers(pow(FACTOR, -1, 1 << 64))
        self.of_byte = _mix(np.arange(1, 257, dtype=np.uint64) * U(FACTOR))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.up[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64) * U(FACTOR))

    def fixed(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes at each place."""
        n = len(sums) - size
        return _mix((sums[size:] - sums[:n]) * self.down[:n])


class Regions(NamedTuple):
    """First window, last window, anchor, hash of the anchor's bytes and of all bytes."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    k: np.ndarray
    r: np.ndarray


NOTHING = Regions(_NONE, _NONE, _NONE, _NONE.astype(np.uint64), _NONE.astype(np.uint64))


def regions(hasher: Hasher, data: np.ndarray, ends: np.ndarray) -> tuple[Regions, np.ndarray]:
    """The regions of a piece that holds texts ending at ``ends``, and the running sums."""
    sums = hasher.sums(data)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return NOTHING, sums
    grams = hasher.fixed(sums, GRAM)
    least, at, width, wanted = grams, np.arange(len(grams), dtype=np.int32), 1, LENGTH - GRAM + 1
    while width < wanted:
        step = min(width, wanted - width)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.where(right, least[step:], least[:-step])
        width += step
    sizes = np.diff(np.concatenate(([0], ends)))
    inside = np.arange(n) + LENGTH <= np.repeat(ends, sizes)[:n]
    windows = np.flatnonzero(inside)
    if not len(windows):
        return NOTHING, sums
    anchor = at[windows]
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    first, last = windows[new], windows[np.append(new[1:], len(windows)) - 1]
    whole = hasher.of(sums, first, last + LENGTH) >> U(64 - REGION_BITS)
    return Regions(first, last, anchor[new], grams[anchor[new]], whole), sums


def sides(hasher: Hasher, sums: np.ndarray, found: Regions, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits for the bytes before and behind each anchor; 0 where the text ends before."""
    place = np.searchsorted(ends, found.first, "right")
    start, end = np.concatenate(([0], ends))[place], ends[place]

    def bits(ok: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ok), "<u2")
        out[ok] = (hasher.of(sums, a[ok], b[ok]) >> U(48)) | U(1)
        return out

    left, right = found.anchor.astype(np.int64) - SIDE, found.anchor.astype(np.int64) + GRAM + SIDE
    return bits(left >= start, left, left + SIDE), bits(right <= end, right - SIDE, right)


def _six(r: np.ndarray) -> bytes:
    return np.ascontiguousarray(r.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :REGION_BITS // 8]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def pieces_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, ends and text numbers of pieces of at most PIECE bytes, and where the first text goes
    on. Long texts are cut with an overlap, so that every window is in one piece."""
    held, names, size = [], [], 0
    for k, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, PIECE - LENGTH + 1):
            part = text[at:at + PIECE]
            if held and (at or size + len(part) > PIECE):
                yield _piece(held, names, 0)
                held, names, size = [], [], 0
            if len(text) > PIECE:
                yield _piece([part], [k], at)
                continue
            held.append(part)
            names.append(k)
            size += len(part)
    if held:
        yield _piece(held, names, 0)


def _piece(parts: list[bytes], names: list[int], at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]), np.array(names), at


def _by_doc(docs: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[int, bytes]]:
    if not len(docs):
        return
    order = np.argsort(docs, kind="stable")
    docs, hashes = docs[order], hashes[order]
    starts = np.concatenate(([0], np.flatnonzero(docs[1:] != docs[:-1]) + 1))
    for a, b in zip(starts, np.append(starts[1:], len(docs)), strict=True):
        yield int(docs[a]), hashes[a:b].tobytes()


def _pack(docs: np.ndarray) -> tuple[int, bytes]:
    """Numbers as differences from the least, in as few bytes as they need."""
    base = int(docs.min())
    off = (docs - base).astype(np.uint64)
    kind = next(t for t in ("<u2", "<u4", "<u8") if int(off.max()) <= np.iinfo(t).max)
    return base, off.astype(kind).tobytes()


def _unpack(base: int, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) + base


MAPPED = "bucket long, kind int, doc long, low binary, region binary, sides binary, docs binary"
FOUND = "doc long, kind int, regions binary"
TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Tuples as a batch with the columns of a schema string."""
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[j] for r in rows], TYPES[kind]) for j, (_, kind) in enumerate(columns)], [name for name, _ in columns])


def first_digits(docs: DataFrame, bits: int) -> DataFrame:
    """Regions by bucket of their anchor; those repeated within the task as removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            doc, k, r, side = (np.concatenate([h[j] for h in held]) for j in range(4))
            order = np.argsort(doc, kind="stable")
            order = order[np.argsort((r ^ (k * U(FACTOR)))[order], kind="stable")]
            doc, k, r, side = doc[order], k[order], r[order], side[order]
            new = np.concatenate(([True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])))
            least = doc[new][np.cumsum(new) - 1]
            rows = [(d % (1 << bits), REMOVED, d, None, x, None, None) for d, x in _by_doc(doc[doc > least], r[doc > least])]
            doc, k, r, side = doc[new], k[new], r[new], side[new]
            bucket = (k >> U(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            doc, r, bucket, side = doc[order], r[order], bucket[order], side[order]
            low = ((k[order] >> U(32 - bits)) & U(0xFFFFFFFF)).astype("<u4")
            starts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1))
            for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
                base, packed = _pack(doc[a:b])
                rows.append((int(bucket[a]), 0, base, low[a:b].tobytes(), _six(r[a:b]), side[a:b].tobytes(), packed))
            for a in range(0, len(rows), 1000):
                yield _batch(rows[a:a + 1000], MAPPED)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for data, ends, names, _ in pieces_of(batch.column(1).to_pylist()):
                found, sums = regions(hasher, data, ends)
                both = np.stack(sides(hasher, sums, found, ends), axis=1)
                held.append((ids[names[np.searchsorted(ends, found.first, "right")]], found.k, found.r, both))
                size += len(found.first)
            if size > HELD:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return docs.mapInArrow(run, MAPPED)


def second_digits(mapped: DataFrame, bits: int) -> DataFrame:
    """(doc, kind, regions): regions to remove, and those whose anchor and one side of it another
    document shares; of equal regions only the smallest document's is opened."""

    def run(table: pa.Table) -> pa.Table:
        rows = [(d, REMOVED, x) for kind, d, x in zip(*(table.column(c).to_pylist() for c in ("kind", "doc", "region")), strict=True)
                if kind == REMOVED]
        entries = table.filter(pa.compute.equal(table.column("kind"), 0))
        if entries.num_rows:
            k = np.concatenate([np.frombuffer(x, "<u4") for x in entries.column("low").to_pylist()])
            region = entries.column("region").to_pylist()
            r = np.concatenate([_from_six(x) for x in region])
            side = np.concatenate([np.frombuffer(x, "<u2").reshape(-1, 2) for x in entries.column("sides").to_pylist()])
            doc = np.concatenate([_unpack(base, x, len(g) // 6) for base, x, g in zip(
                entries.column("doc").to_pylist(), entries.column("docs").to_pylist(), region, strict=True)])
            order = np.lexsort((doc, r, k))
            k, r, doc, side = k[order], r[order], doc[order], side[order]
            newk = np.concatenate(([True], k[1:] != k[:-1]))
            new = newk | np.concatenate(([True], r[1:] != r[:-1]))
            gone = doc > doc[new][np.cumsum(new) - 1]
            rows += [(d, REMOVED, x) for d, x in _by_doc(doc[gone], r[gone])]
            k, r, doc, side = k[new], r[new], doc[new], side[new]
            shared = _shared(k, side[:, 0], doc) | _shared(k, side[:, 1], doc)
            rows += [(d, OPEN, x) for d, x in _by_doc(doc[shared], r[shared])]
        return pa.Table.from_batches([_batch(rows, FOUND)])

    return mapped.groupBy("bucket").applyInArrow(run, FOUND)


def _shared(k: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where another document has the same anchor and side."""
    key = (k.astype(np.uint64) << U(16)) | side
    order = np.argsort(key, kind="stable")
    key, doc, known = key[order], doc[order], side[order] != 0
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    many = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    out = np.zeros(len(k), bool)
    out[order] = np.repeat(many, np.diff(np.append(starts, len(k)))) & known
    return out


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    marks = np.zeros(size + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    return np.cumsum(marks[:-1]) > 0


def result_of(data: bytes, gone: np.ndarray, keep_bytes: bool) -> tuple[int, int, list[tuple[int, int]], bytes | str]:
    """Removed bytes, their number of runs, the runs, and what is left or its digest."""
    edges = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
    runs = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))
    left = np.frombuffer(data, np.uint8)[~gone].tobytes() if runs else data
    return int(gone.sum()), len(runs), runs, left if keep_bytes else hashlib.sha256(left).hexdigest()


def _spans(runs: list[tuple[int, int]]) -> bytes:
    return np.array(runs, "<i8").tobytes()


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans binary, left {}"


def decided(joined: DataFrame, keep_bytes: bool) -> DataFrame:
    """Results of texts that have no open regions; of the others the text, the spans so far and the
    open regions (hash of the anchor, first window, number of windows)."""
    schema = RESULT.format("binary" if keep_bytes else "string") + ", text binary, k binary, first binary, size binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            rows = []
            for doc, data, removed, open_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                gone, wanted = (np.frombuffer(b"".join(x or []), np.uint64) for x in (removed, open_))
                none = np.zeros(0, np.int64)
                starts, ends, k, first, size = [none], [none], [], [], []
                for part, stops, _, offset in pieces_of([data]) if len(gone) or len(wanted) else ():
                    found, _ = regions(hasher, part, stops)
                    out = np.isin(found.r, gone)
                    starts.append(found.first[out] + offset)
                    ends.append(found.last[out] + LENGTH + offset)
                    ask = np.isin(found.r, wanted) & ~out
                    if ask.any():
                        k.append(found.k[ask])
                        first.append(found.first[ask] + offset)
                        size.append(found.last[ask] - found.first[ask] + 1)
                mask = covered(len(data), np.concatenate(starts), np.concatenate(ends))
                n, m, runs, left = result_of(data, mask, keep_bytes)
                row = (doc, len(data), n, m, _spans(runs))
                if k:
                    packed = (np.concatenate(x).astype(kind).tobytes() for x, kind in ((k, "<u8"), (first, "<i8"), (size, "<i4")))
                    rows.append((*row, None, data, *packed))
                else:
                    rows.append((*row, left, None, None, None, None))
            yield _batch(rows, schema)

    return joined.mapInArrow(run, schema)


OPENED = "bucket long, doc long, first binary, size binary, bytes binary"


def opened(open_: DataFrame, bits: int) -> DataFrame:
    """The bytes of the open regions, by bucket of their anchor: a row for each text and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, data, k, first, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k, first, size = np.frombuffer(k, "<u8"), np.frombuffer(first, "<i8"), np.frombuffer(size, "<i4")
                bucket = (k >> U(64 - bits)).astype(np.int64)
                rows = []
                for b in np.unique(bucket):
                    here = np.flatnonzero(bucket == b)
                    parts = b"".join(data[f:f + n + LENGTH - 1] for f, n in zip(first[here].tolist(), size[here].tolist(), strict=True))
                    rows.append((int(b), doc, first[here].tobytes(), size[here].tobytes(), parts))
                yield _batch(rows, OPENED)

    return open_.select("doc_id", "text", "k", "first", "size").mapInArrow(run, OPENED)


def _unlike(data: np.ndarray, begin: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Whether windows that were grouped as equal are not: their order by group and bytes, and the groups."""
    first = begin[new][np.cumsum(new) - 1]
    twin, steps = np.flatnonzero(first != begin), np.arange(LENGTH)
    if all((data[begin[part][:, None] + steps] == data[first[part][:, None] + steps]).all()
           for part in np.array_split(twin, len(twin) // 20_000 + 1)):
        return None
    words = [data[a:a + LENGTH].tobytes() for a in begin.tolist()]
    group = np.cumsum(new).tolist()
    order = sorted(range(len(begin)), key=lambda k: (group[k], words[k]))
    return np.array(order), np.array([k == 0 or (group[i], words[i]) != (group[order[k - 1]], words[order[k - 1]]) for k, i in enumerate(order)])


def last_digits(rows: DataFrame) -> DataFrame:
    """(doc, starts): the windows of open regions that a smaller document has, too."""

    def run(table: pa.Table) -> pa.Table:
        ids, first, size, data = (table.column(c).to_pylist() for c in ("doc", "first", "size", "bytes"))
        first = [np.frombuffer(x, "<i8") for x in first]
        size = [np.frombuffer(x, "<i4").astype(np.int64) for x in size]
        hashes, places, begins, before = [], [], [], 0
        hasher = Hasher(max(map(len, data)))
        for part, starts, sizes in zip(data, first, size, strict=True):
            every = hasher.fixed(hasher.sums(np.frombuffer(part, np.uint8)), LENGTH)
            begin = np.cumsum(sizes + LENGTH - 1) - (sizes + LENGTH - 1)
            step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hashes.append(every[np.repeat(begin, sizes) + step])
            places.append(np.repeat(starts, sizes) + step)
            begins.append(np.repeat(begin, sizes) + step + before)
            before += len(part)
        doc = np.repeat(np.array(ids), [len(h) for h in hashes])
        h, at, begin = np.concatenate(hashes), np.concatenate(places), np.concatenate(begins)
        order = np.lexsort((doc, h))
        h, doc, at, begin = h[order], doc[order], at[order], begin[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        # Equal hashes are equal bytes but for a chance of 2^-64; then the bytes put them in order.
        if (unlike := _unlike(np.frombuffer(b"".join(data), np.uint8), begin, new)) is not None:
            order, new = unlike
            doc, at = doc[order], at[order]
        later = doc > doc[new][np.cumsum(new) - 1]
        return pa.Table.from_batches([_batch(list(_by_doc(doc[later], at[later])), "doc long, starts binary")])

    return rows.groupBy("bucket").applyInArrow(run, "doc long, starts binary")


def _finish(rows: DataFrame, keep_bytes: bool) -> DataFrame:
    """Open texts with the windows found in smaller documents."""
    schema = RESULT.format("binary" if keep_bytes else "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, data, spans, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = np.frombuffer(spans, "<i8").reshape(-1, 2)
                more = np.unique(np.frombuffer(b"".join(at or []), "<i8"))
                mask = covered(len(data), np.concatenate((known[:, 0], more)), np.concatenate((known[:, 1], more + LENGTH)))
                n, m, runs, left = result_of(data, mask, keep_bytes)
                out.append((doc, len(data), n, m, _spans(runs), left))
            yield _batch(out, schema)

    return rows.mapInArrow(run, schema)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))
def _span_list(spans: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"start": a, "end": b} for a, b in np.frombuffer(x, "<i8").reshape(-1, 2).tolist()] for x in spans.to_pylist()], kind)


def remove_repeats(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start and end of what goes) and ``left``, the bytes
    that stay (their SHA-256 with ``keep_bytes=False``), for every row of ``docs``.

    A byte goes if a 50-byte string that covers it starts in a document with a smaller doc_id, too.
    Texts are whole UTF-8 bytes; null and empty ones have none. Rows that share a doc_id do not
    remove each other; rows with a null doc_id neither remove nor lose anything. Needs doc_id and
    text, ignores other columns; an empty table gives no rows.
    """
    small_batches(docs.sparkSession, 500)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(utf8("text"), F.lit(b"")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(8, int(size / 16 / BUCKET).bit_length()), 24)
    mapped = first_digits(rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)), bits)
    found = stage_table(second_digits(mapped, bits), "repeats-found")
    lists = found.groupBy(F.col("doc").alias("d")).agg(*[
        F.collect_list(F.when(F.col("kind") == kind, F.col("regions"))).alias(name) for kind, name in ((REMOVED, "gone"), (OPEN, "wanted"))])
    joined = rows.join(lists, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "gone", "wanted")
    part = stage_table(decided(joined, keep_bytes), "repeats-part")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "left"]
    open_ = part.where("text IS NOT NULL")
    later = stage_table(last_digits(opened(open_, bits + FINER)), "repeats-windows")
    later = later.groupBy(F.col("doc").alias("d")).agg(F.collect_list("starts").alias("more"))
    ended = _finish(open_.join(later, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "spans", "more"), keep_bytes)
    every = part.where("text IS NULL").select(*columns).unionByName(ended)
    return every.select("doc_id", "n_bytes", "n_removed", "n_spans", _span_list("spans").alias("spans"), "left")
