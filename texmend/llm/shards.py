"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed-stride records.

Texts become token ids, cut into sequences. A sequence's ordinal is its place in the stored table (rows of the files
before and its row in the file), and a keyed Feistel permutation of the ordinals, walked until it falls below their
number, is its slot. Python workers make the records and the slots; the slots come from ordinals alone, so that records
stay in the JVM from then on. Partitions hold ranges of slots and write them in order, several shards each, a file a
shard. Spark's text sink writes the records: their last bytes are the sink's separator, so any store will do and a lost
task leaves nothing behind.

A record: sequence length ids of 2 or 4 bytes (filled up with the end id), doc_id (8 bytes, -2**63 for null), number of
the sequence in the text (4), ids that count (4), the bytes 0D 0A 0D 0A; all little-endian. Slot s is record s mod
SHARD_ROWS of shard s div SHARD_ROWS.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import lean, mix
from .work import bounded, discard, free_shuffles, new_path, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the word pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, SHARD_ROWS = 512, 4096
KEY = 0x1F3D5B79
ROUNDS = 6
#: Ranges of slots that are dealt out one after the other, each with its own shuffle, so that little of the data lies in shuffle files at a time.
PASSES = 4
#: Shards that a task writes, at most, and records that a worker returns in a batch, about.
TASK_SHARDS, ROWS_OUT = 32, 1024
#: Runs of white space that are cut off before the word pattern sees them.
LONG_BLANK = re.compile(r"\s{4096,}")
SEPARATOR = "\r\n\r\n"
NULL_ID = -(1 << 63)


def tokenizer(path: str):
    """A byte-pair encoder from a file of ranks; the id after the last ends a text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def width_of(end: int) -> int:
    return 2 if end < 1 << 16 else 4


def _pieces(encoder, text: str) -> Iterator[list[int]]:
    """The ids of text, by parts. A long run of white space is one part, but for its last character before a word.

    The word pattern takes such a run by itself in the same way, but its matcher keeps a state a character and gives up
    on runs of a million.
    """
    done = 0
    for run in LONG_BLANK.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > done:
            yield encoder.encode_ordinary(text[done : run.start()])
        yield encoder._encode_single_piece(text[run.start() : stop])
        done = stop
    yield encoder.encode_ordinary(text[done:])


def _encode(encoder, text: str) -> np.ndarray:
    return np.concatenate([np.array(ids, np.int64) for ids in _pieces(encoder, text)])


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """record (bytes): each text and its end id, cut every `length` ids, as records without their mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokenizer(vocabulary)
        kind = np.dtype(f"<u{width_of(end)}")
        for batch in batches:
            records, held = [], 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                tokens = np.append(_encode(encoder, text.as_py() or ""), end)
                n = -(-len(tokens) // length)
                rows = np.zeros((n, length * kind.itemsize + 16), np.uint8)
                ids = np.full(n * length, end, kind)
                ids[: len(tokens)] = tokens
                rows[:, :-16] = ids.view(np.uint8).reshape(n, -1)
                rows[:, -16:-8] = np.array([NULL_ID if doc.as_py() is None else doc.as_py()], "<i8").view(np.uint8)
                rows[:, -8:-4] = np.arange(n, dtype="<i4").view(np.uint8).reshape(n, 4)
                rows[:, -4:] = np.minimum(len(tokens) - np.arange(n) * length, length).astype("<i4").view(np.uint8).reshape(n, 4)
                records.append(rows)
                held += n
                if held >= ROWS_OUT:
                    yield from _blobs(records)
                    records, held = [], 0
            if held:
                yield from _blobs(records)

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(lean(run), "record binary")


def _blobs(records: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate(records)
    for k in range(0, len(rows), 2 * ROWS_OUT):
        part = rows[k : k + 2 * ROWS_OUT]
        at = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
        yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(part))])], names=["record"])


def permute(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0..n-1: a balanced Feistel network on the next even number of bits, walked along its cycle until it falls below n."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(rounds, dtype=np.uint64) + np.uint64(key))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, length: int = LENGTH, shard_rows: int = SHARD_ROWS, key: int = KEY) -> int:
    """Writes all texts' sequences to path, and returns their number.

    A null or empty text is one sequence with the end id alone; rows with one doc_id are each written. The order depends
    on the key, and on how the stored table of sequences came out of the input's files; it is the same for the same
    input layout.
    """
    spark = docs.sparkSession
    _, end = tokenizer(vocabulary)
    width = width_of(end)
    table = stored(sequences(docs, vocabulary, length), "sequences")
    where = table.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = stored(where.groupBy("file").agg(F.count("*").alias("rows")), "files")
    before = F.coalesce(F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = files.agg(F.sum("rows")).first()[0] or 0

    @F.arrow_udf("long")
    def slot(ordinals: pa.Array) -> pa.Array:
        return pa.array(permute(ordinals.to_numpy(zero_copy_only=False), total, key))

    placed = where.join(files.select("file", before.alias("before")), "file").select(slot(F.col("before") + F.col("row")).alias("slot"), "record")
    #: A task's shards: several where the table has many, fewer where cores would stay idle.
    shards = max(1, -(-total // shard_rows))
    each = -(-shards // PASSES)
    group = max(1, min(TASK_SHARDS, each // (2 * spark.sparkContext.defaultParallelism)))
    for first in range(0, shards, each):
        last = min(shards, first + each)
        dealt = placed.where((F.col("slot") >= first * shard_rows) & (F.col("slot") < last * shard_rows)).withColumn("shard", F.floor(F.col("slot") / shard_rows).cast("int"))
        dealt = dealt.repartitionById(-(-(last - first) // group), F.floor((F.col("shard") - first) / group).cast("int")).sortWithinPartitions("shard", "slot")
        dealt.select("shard", F.col("record").cast("string").alias("value")).write.mode("append").partitionBy("shard").option("lineSep", SEPARATOR).text(path)
        free_shuffles(spark)
    discard(table, files)
    return total


def stride(width: int, length: int = LENGTH) -> int:
    return width * length + 16 + len(SEPARATOR)


def read_shards(spark: SparkSession, path: str, start: int = 0, stop: int | None = None, width: int = 2, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """slot, shard, offset, doc_id, seq, n, ids (bytes) of slots start..stop, so a reader can resume at any slot.

    A shard is one file of at most shard_rows records; only shards that hold slots of the range are read.
    """
    step = stride(width, length)
    bounded(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content"), strict=True):
                rows = np.frombuffer(content.as_buffer(), np.uint8)
                if len(rows) % step:
                    raise ValueError(f"shard {shard} has {len(rows)} bytes, no multiple of {step}")
                rows = rows.reshape(-1, step)
                tail = np.ascontiguousarray(rows[:, width * length :])
                if (tail[:, 16:] != np.frombuffer(SEPARATOR.encode(), np.uint8)).any():
                    raise ValueError(f"shard {shard}: a record doesn't end with the mark")
                ids = np.ascontiguousarray(tail[:, :8]).view("<i8")[:, 0]
                seq, n = np.ascontiguousarray(tail[:, 8:16]).view("<i4").T
                number = np.arange(len(rows))
                tokens = pa.array([r[: width * k].tobytes() for r, k in zip(rows, n, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(number + shard * shard_rows), pa.array(np.full(len(rows), shard, np.int32)), pa.array(number * step), pa.array(ids, mask=ids == NULL_ID), pa.array(seq.copy()), pa.array(n.copy()), tokens], names=["slot", "shard", "offset", "doc_id", "seq", "n", "ids"])

    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:  # no shard was written
        files = files.withColumn("shard", F.lit(0))
    files = files.where(F.col("shard") >= start // shard_rows)
    out = files if stop is None else files.where(F.col("shard") <= (stop - 1) // shard_rows)
    out = out.select("shard", "content").mapInArrow(lean(cut), "slot long, shard int, offset long, doc_id long, seq int, n int, ids binary").where(F.col("slot") >= start)
    return out if stop is None else out.where(F.col("slot") < stop)


def materialised(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Writes docs' shards to the shared folder and reads them back: slot, shard, offset, doc_id, seq, n_tokens, ids_sha256."""
    spark = docs.sparkSession
    path = new_path(spark, "shards")
    write_shards(docs, path, vocabulary)
    width = width_of(tokenizer(vocabulary)[1])
    return read_shards(spark, path, width=width).select("slot", "shard", "offset", "doc_id", "seq", F.col("n").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))


def expected(texts: list[tuple[int, str]], vocabulary: str = VOCABULARY, length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(doc_id, seq, n_tokens, ids_sha256) by plain means, for tests."""
    encoder, end = tokenizer(vocabulary)
    out = []
    for doc, text in texts:
        tokens = [*encoder.encode_ordinary(text or ""), end]
        for k in range(0, len(tokens), length):
            own = np.array(tokens[k : k + length], f"<u{width_of(end)}")
            out.append((doc, k // length, len(own), hashlib.sha256(own.tobytes()).hexdigest()))
    return out
