"""Removal of repeated byte strings by bucket-pointer refinement.

Every string of LENGTH bytes holds a q-gram whose hash is least among its q-grams, and equal strings hold it at the same
offset; these q-grams are the initial buckets, and only places of buckets with two or more members are refined.
A place's strings lie in its context, the bytes that they can reach to either side. Members with equal contexts, by
bucket and context identifier, differ in no string: all but the first are repeated wholly. First members of different
contexts are refined within the bucket: sorting on the identifiers of the 8-byte blocks at later offsets to the right,
and likewise to the left, each refinement working on the identifiers that the one before updated, gives the order of the
contexts and so the classes of every prefix length. A string's class is the pair of its left and right class, and all
but the class's first member are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import RangeHash, chunks, lean, mix
from .work import stored

LENGTH, Q = 100, 32
CHUNK = (1 << 20) - 1
#: Places whose contexts one task refines at once, or one bucket if that is larger; buckets beyond HOT places are not
#: gathered: their strings are dealt one by one, by bucket, offset and bytes.
REFINE, HOT = 20_000, 40_000


def _least(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every window of `width` values, in doubling steps."""
    step = 1
    while step < width:
        jump = min(step, width - step)
        values = pick(values[:-jump], values[jump:])
        step += jump
    return values


def anchors(data: np.ndarray, at: np.ndarray, hashes: RangeHash, length: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all q-grams that are least in some string of `length` bytes of a row."""
    n, wide = len(data), length - q + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.arange(n - q + 1)
    code = hashes(start, start + q)
    code[code == np.uint64(0xFFFFFFFFFFFFFFFF)] -= np.uint64(1)
    low = _least(code, wide, np.minimum)  # of the string at i
    top = np.concatenate([np.zeros(wide - 1, np.uint64), low, np.zeros(wide - 1, np.uint64)])
    own = code == _least(top, wide, np.maximum)
    place = np.flatnonzero(own)
    row = np.searchsorted(at, place, "right") - 1
    place = place[(place + q <= at[row + 1]) & (at[row + 1] - at[row] >= length)]
    return place, code[place]


ANCHOR_DDL = "bucket long, context long, doc_id long, twin long, place int"


def _anchors(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in chunks(batch, "text", CHUNK):
                hashes = RangeHash(data)
                place, code = anchors(data, at, hashes, length, q)
                row = np.searchsorted(at, place, "right") - 1
                left, right = np.minimum(place - at[row], length - q), np.minimum(at[row + 1] - place, length)
                context = hashes(place - left, place + right) + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                ids, twins = part.column("doc_id"), part.column("twin")
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(context.view(np.int64)), ids.take(take), twins.take(take), pa.array((place - at[row]).astype(np.int32))], names=["bucket", "context", "doc_id", "twin", "place"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (bucket, context, doc_id, place): whole repeats, and first members of buckets with more contexts.

    The first row of a bucket waits until a second context shows up. Rows at one place of one doc_id don't repeat each other.
    """
    wait, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, context = batch.column("bucket").to_numpy(), batch.column("context").to_numpy()
        ids, place = batch.column("doc_id").to_numpy(), batch.column("place").to_numpy()
        lead = last or (None, None, None, None)
        new_bucket = np.append(bucket[0] != lead[0], bucket[1:] != bucket[:-1])
        new = new_bucket | np.append(context[0] != lead[1], context[1:] != context[:-1])
        n = len(bucket)
        #: The place of each class's first member, possibly of an earlier batch.
        head = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        first_id = np.where(head >= 0, ids[head], lead[2] if last else 0)
        first_place = np.where(head >= 0, place[head], lead[3] if last else 0)
        whole = ~new & ((ids != first_id) | (place != first_place))
        #: A class's first member goes on if its bucket has another context before or after.
        opens = np.flatnonzero(new_bucket)
        more = np.flatnonzero(new & ~new_bucket)
        opener = np.searchsorted(opens, more, "right") - 1
        part = np.zeros(n, bool)
        part[more] = True
        part[opens[opener[opener >= 0]]] = True
        if wait is not None and (opener < 0).any():
            yield wait
            wait = None
        if len(opens):
            end = int(opens[-1])
            wait = None if part[end] else pa.RecordBatch.from_arrays([pa.array([False]), *(batch.column(c).slice(end, 1) for c in ("bucket", "doc_id", "twin", "place"))], names=["whole", "bucket", "doc_id", "twin", "place"])
        take = pa.array(np.flatnonzero(whole | part))
        yield pa.RecordBatch.from_arrays([pa.array(whole).take(take), *(batch.column(c).take(take) for c in ("bucket", "doc_id", "twin", "place"))], names=["whole", "bucket", "doc_id", "twin", "place"])
        last = (bucket[-1], context[-1], first_id[-1], first_place[-1])


def _prefix_classes(bucket: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Refines buckets by rows of bytes, 8 a step: the order, and for each row in that order the bytes it shares with the row before (-1 at a new bucket)."""
    n, width = blocks.shape
    pointer = bucket
    order = np.argsort(pointer, kind="stable")
    words = np.ascontiguousarray(np.pad(blocks, ((0, 0), (0, -width % 8)))).view(">u8")
    for k in range(words.shape[1]):
        #: Only members of buckets with company are sorted on, by their bucket's pointer and the block at the next offset.
        ranked = pointer[order]
        same = ranked[1:] == ranked[:-1]
        tied = np.append(same, False) | np.append(False, same)
        active = order[tied]
        if not len(active):
            break
        by = np.lexsort((words[active, k], pointer[active]))
        active = active[by]
        order[tied] = active
        fresh = np.append(True, ~same)
        at = np.flatnonzero(tied)
        block = words[active, k]
        fresh[at[1:]] |= block[1:] != block[:-1]
        pointer = np.empty(n, np.int64)
        pointer[order] = np.cumsum(fresh)
    sorted_blocks = blocks[order]
    equal = sorted_blocks[1:] == sorted_blocks[:-1]
    shared = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1)) if width else np.zeros(n - 1, np.int64)
    shared[bucket[order][1:] != bucket[order][:-1]] = -1
    return order, np.append(-1, shared)


def refine(bucket: np.ndarray, left: np.ndarray, right: np.ndarray, left_n: np.ndarray, right_n: np.ndarray, twin_of: np.ndarray, length: int, q: int) -> np.ndarray:
    """For members sorted by (bucket, doc_id, place): flags (members, length - q + 1), whether the string that starts so many bytes before the place is repeated.

    left: bytes before the place, nearest first; right: bytes from the end of the q-gram; both padded, with their true
    lengths. twin_of: the first member at the same place of the same doc_id.
    """
    n, wide = len(bucket), length - q + 1
    left_order, left_shared = _prefix_classes(bucket, left)
    right_order, right_shared = _prefix_classes(bucket, right)
    out = np.zeros((n, wide), bool)
    classes = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(wide):
        able = (left_n >= d) & (right_n >= wide - 1 - d)
        classes[0][left_order] = np.cumsum(left_shared < d)
        classes[1][right_order] = np.cumsum(right_shared < wide - 1 - d)
        key = (classes[0] * (n + 1) + classes[1])[able]
        place = np.flatnonzero(able)
        order = np.argsort(key, kind="stable")
        if not len(order):
            continue
        heads = np.append(True, key[order][1:] != key[order][:-1])
        first = place[order[np.maximum.accumulate(np.where(heads, np.arange(len(order)), 0))]]
        again = twin_of[place[order]] != twin_of[first]
        out[place[order[again]], d] = True
    return out


def _contexts(length: int, q: int):
    """Rows (doc_id, twin, marks, text): a row for each place with the bytes around it, or for places of hot buckets a row for each string."""
    wide = length - q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in chunks(batch, "text", CHUNK):
                pieces = part.column("marks")
                counts = np.array([len(x) for x in pieces], np.int64)
                bucket, place, hot = (x.to_numpy(zero_copy_only=False) for x in pieces.flatten().flatten())
                row = np.repeat(np.arange(len(counts)), counts)
                padded = np.concatenate([np.zeros(wide, np.uint8), data, np.zeros(length, np.uint8)])
                around = np.lib.stride_tricks.sliding_window_view(padded, 2 * wide + q)[at[row] + place]
                around = np.concatenate([around[:, :wide], around[:, wide + q :]], axis=1)
                left_n, right_n = np.minimum(place, wide), np.minimum(at[row + 1] - at[row] - place - q, wide)

                def rows(take: np.ndarray, key: np.ndarray, offset: np.ndarray, blob: np.ndarray, part=part, row=row, place=place, left_n=left_n, right_n=right_n) -> pa.RecordBatch:
                    ends = pa.py_buffer((np.arange(len(take) + 1) * blob.shape[1]).astype(np.int32))
                    docs = pa.array(row[take])
                    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(offset.astype(np.int32)), part.column("doc_id").take(docs), part.column("twin").take(docs), *(pa.array(x[take].astype(np.int32)) for x in (place, left_n, right_n)), pa.Array.from_buffers(pa.binary(), len(take), [None, ends, pa.py_buffer(np.ascontiguousarray(blob))])], names=[x.split()[0] for x in CONTEXT_DDL.split(", ")])

                cool, warm = np.flatnonzero(~hot), np.flatnonzero(hot)
                yield rows(cool, bucket[cool], np.full(len(cool), -1), around[cool])
                if len(warm):
                    hashes = RangeHash(data)
                    for d in range(wide + 1):
                        own = warm[(left_n[warm] >= d) & (right_n[warm] >= wide - d)]
                        start = at[row[own]] + place[own] - d
                        key = hashes(start, start + length) + bucket[own].astype(np.uint64) + np.uint64(d)
                        yield rows(own, mix(key).view(np.int64), np.full(len(own), d), np.zeros((len(own), 0), np.uint8))

    return run


CONTEXT_DDL = "bucket long, offset int, doc_id long, twin long, place int, left_n int, right_n int, around binary"
SPAN_DDL = "doc_id long, twin long, spans binary"


def _spans_of(place: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """(start of the first string, start of the last) as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer((np.arange(len(place) + 1) * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(np.stack([place - high, place - low], axis=1).astype(np.int32)))])


def _refined(length: int, q: int):
    def resolve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        bucket, ids, place, left_n, right_n = (table.column(c).to_numpy() for c in ("bucket", "doc_id", "place", "left_n", "right_n"))
        column = table.column("around").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        wide = length - q
        _, offsets, raw = column.buffers()
        base = np.frombuffer(offsets, np.int32)[column.offset]
        around = np.frombuffer(raw, np.uint8)[base : base + len(bucket) * 2 * wide].reshape(-1, 2 * wide)
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1]) | (place[1:] != place[:-1]))
        twin_of = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        number = np.cumsum(np.append(True, bucket[1:] != bucket[:-1]))
        flags = refine(number, around[:, :wide][:, ::-1], around[:, wide:], left_n, right_n, twin_of, length, q)
        edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        who, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        take = pa.array(who)
        return pa.RecordBatch.from_arrays([table.column("doc_id").take(take).combine_chunks(), table.column("twin").take(take).combine_chunks(), _spans_of(place[who], low, high - 1)], names=["doc_id", "twin", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (bucket, offset, doc_id, place): whole buckets together; single strings as they come."""
        held: list[pa.RecordBatch] = []
        rows, last = 0, None
        for batch in batches:
            offset = batch.column("offset").to_numpy()
            single = batch.filter(pa.array(offset >= 0))
            if single.num_rows:
                key, d, ids, place = (single.column(c).to_numpy() for c in ("bucket", "offset", "doc_id", "place"))
                lead = last or (None, None, 0, 0)
                new = np.append((key[0], d[0]) != lead[:2], (key[1:] != key[:-1]) | (d[1:] != d[:-1]))
                head = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
                first = np.where(head >= 0, ids[head], lead[2]), np.where(head >= 0, place[head], lead[3])
                again = np.flatnonzero(~new & ((ids != first[0]) | (place != first[1])))
                yield pa.RecordBatch.from_arrays([single.column("doc_id").take(pa.array(again)), single.column("twin").take(pa.array(again)), _spans_of(place[again], d[again], d[again])], names=["doc_id", "twin", "spans"])
                last = (key[-1], d[-1], first[0][-1], first[1][-1])
            batch = batch.filter(pa.array(offset < 0))
            held.append(batch)
            rows += batch.num_rows
            if rows < REFINE:
                continue
            table = pa.Table.from_batches(held)
            bucket = table.column("bucket").to_numpy()
            end = int(np.searchsorted(bucket, bucket[-1]))
            if end:
                yield resolve(table.slice(0, end))
            held, rows = table.slice(end).to_batches(), len(bucket) - end
        if rows:
            yield resolve(pa.Table.from_batches(held))

    return run


def removed_runs(spans: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in the ranges cover."""
    spans = spans.reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")].astype(np.int64)
    if not len(spans):
        return []
    end = np.maximum.accumulate(spans[:, 1] + length)
    new = np.flatnonzero(np.append(True, spans[1:, 0] > end[:-1]))
    return list(zip(spans[new, 0].tolist(), end[np.append(new[1:] - 1, len(spans) - 1)].tolist(), strict=True))


def repeats(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """doc_id, text, runs: an array of (start, end) in UTF-8 bytes to remove, for each row of docs.

    A null text is empty. Rows with one doc_id count as one document: equal places of theirs don't repeat each other.
    Rows with a null doc_id are taken as one document before all others.
    """
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    low = -(1 << 63)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("twin", F.xxhash64("text"))
    found = texts.mapInArrow(lean(_anchors(length, q)), ANCHOR_DDL)
    kinds = stored(found.repartition(n, "bucket").sortWithinPartitions("bucket", "context", "doc_id", "place").mapInArrow(lean(_repeated), "whole boolean, bucket long, doc_id long, twin long, place int"), "kinds")
    part = kinds.where("NOT whole")
    hot = part.groupBy("bucket").count().where(F.col("count") > HOT).select("bucket", F.lit(True).alias("hot"))
    marks = part.join(hot, "bucket", "left").groupBy("doc_id", "twin").agg(F.collect_list(F.struct("bucket", "place", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("marks"))
    contexts = texts.join(marks, ["doc_id", "twin"]).mapInArrow(lean(_contexts(length, q)), CONTEXT_DDL)
    partial = stored(contexts.repartition(n, "bucket").sortWithinPartitions("bucket", "offset", "doc_id", "place").mapInArrow(lean(_refined(length, q)), SPAN_DDL), "spans")
    whole = kinds.where("whole").select("doc_id", "twin", "place")

    spans = whole.groupBy("doc_id", "twin").agg(F.collect_list("place").alias("places"))
    more = partial.groupBy("doc_id", "twin").agg(F.collect_list("spans").alias("spans"))
    joined = texts.join(spans, ["doc_id", "twin"], "left").join(more, ["doc_id", "twin"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for k, text in enumerate(batch.column("text")):
                size = text.as_buffer().size
                places = np.array(batch.column("places")[k].as_py() or [], np.int64)
                ranges = np.stack([np.maximum(places - (length - q), 0), np.minimum(places, size - length)], axis=1)
                blob = np.frombuffer(b"".join(batch.column("spans")[k].as_py() or []), np.int32).reshape(-1, 2)
                runs.append([{"start": a, "end": b} for a, b in removed_runs(np.concatenate([ranges, blob]), length)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["doc_id", "text", "runs"])

    out = joined.mapInArrow(lean(run), "doc_id long, text string, runs array<struct<start:int,end:int>>")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != low, F.col("doc_id")))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of repeats()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, shas = [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                kept, at = [], 0
                for r in runs:
                    kept.append(raw[at : r["start"]])
                    at = r["end"]
                kept = b"".join([*kept, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                shas.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(r) for r in batch.column("runs").to_pylist()], pa.int64()), pa.array(shas)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
