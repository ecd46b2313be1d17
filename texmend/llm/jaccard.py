"""N-gram Jaccard join by parity sketches.

A text's set is its distinct word shingles. Sets of like size share a band; in a band the shingles are dealt over M
chunks, and a chunk's sketch is the XOR of one bit a shingle among 2**16. The bits in which two sketches differ are at
most the shingles in which the sets differ, so two linked sets differ in at most D chunks, and with M > D some chunk
is equal: sketches are joined on (band, chunk, sketch). A sketch is kept as the XOR of 64-bit codes of its bits.
A sketch of the whole set, 1,024 bits, bounds the difference of a candidate pair once more, and for larger sets another
one with a bit or two a shingle; what passes is verified on the whole sets. Chunks of one shingle or none, in which texts
meet that share no more than a passage, are left out where chunks enough remain.

Equal sets become one class at the start, and a task sends the keys of a class once. In a bucket every class is held against the smallest one only, then, where a bucket
still holds several components, against a few more members; what is left in different components afterwards is held
against the bucket's members outside its own component, so no link between components is lost and a group of near
copies doesn't become all its pairs. The last bit of keys and codes is that of the band, of a set's own one in its code.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import LOWER, RangeHash, chunks, expand, lean, mix, windows_hash, word_bounds
from .work import discard, stored, unused

WORDS, PERCENT = 4, 85
CHUNK = (1 << 20) - 1
#: Members of one representative that one task verifies in a row.
GROUP = 1000
#: Rounds of further stars.
STARS = 4
#: Chunks beyond D + 1, a fixed number and a share of D: linked sets have one more equal chunks than that. A set with no more
#: chunks of `weak` or fewer shingles leaves these out. Equal chunks have equal numbers of shingles, so linked sets leave out no more
#: than that of their equal chunks, and one at least remains.
SLACK, SLACK_SHARE, WEAK = 3, 0.12, 1
#: Sets beyond so many shingles have a second sketch, with a power of two bits of at least their size.
WIDE = 1024


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and the n + 1 offsets."""
    data = LOWER[data]
    starts, ends, words_at = word_bounds(data, at)
    words = RangeHash(data)(starts, ends)
    n = np.diff(words_at)
    count = np.where(n >= k, n - k + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    every = windows_hash(words, k)
    every = every[expand(words_at[:-1], count)] if len(every) else every
    for r in np.flatnonzero((n > 0) & (n < k)):
        every = np.append(every, windows_hash(words[words_at[r] : words_at[r + 1]], n[r]) ^ np.uint64(n[r]))
        row = np.append(row, r)
    order = np.lexsort((every, row))
    every, row = every[order], row[order]
    new = np.append(True, (every[1:] != every[:-1]) | (row[1:] != row[:-1]))[: len(every)]
    every, row = every[new], row[new]
    return every, np.searchsorted(row, np.arange(len(n) + 1))


def set_codes(every: np.ndarray, offsets: np.ndarray, percent: int) -> np.ndarray:
    """One 64-bit code for each set, from two sums over its members and its size; the last bit is that of its band."""
    sums = []
    for salt in (0, 0x5DEECE66D):
        total = np.zeros(len(every) + 1, np.uint64)
        np.cumsum(mix(every ^ np.uint64(salt)), out=total[1:])
        sums.append(total[offsets[1:]] - total[offsets[:-1]])
    n = np.diff(offsets)
    return _marked(mix(mix(sums[0]) + sums[1] + n.astype(np.uint64)), _band(n, percent)).view(np.int64)


def _band(n: np.ndarray, percent: int) -> np.ndarray:
    """Bands with ratio 100 / percent: linked sizes lie in one band or in neighbours."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent) + 1e-9).astype(np.int64)


def _marked(codes: np.ndarray, band: np.ndarray) -> np.ndarray:
    """codes with the last bit of band as theirs."""
    return codes & ~np.uint64(1) | band.astype(np.uint64) & np.uint64(1)


def sketch_keys(every: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of each set, in its band and the next one, and the set's number for each."""
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    keys, whose = [], []
    for step in (0, 1):
        band = _band(n, percent) + step
        #: Sizes in this band or the one below reach the upper edge of the band; the bound holds for the larger set too.
        largest = np.floor((100 / percent) ** (band + 1) * (1 + 1e-9))
        differ = np.floor(2 * largest * (100 - percent) / (100 + percent) + 1e-9)
        slack = np.where(differ > 0, SLACK + np.ceil(SLACK_SHARE * differ), 0)
        m = np.where(n > 0, differ + 1 + slack, 0).astype(np.int64)
        first = np.cumsum(m) - m
        salted = mix(every + (band[row].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        chunk = first[row] + ((salted >> np.uint64(32)) * m[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        bit = mix((salted & np.uint64(0xFFFF)) + np.uint64(1))
        total = int(m.sum())
        #: Chunks of a set lie together, so a sort by chunk allows XOR over runs.
        order = np.argsort(chunk, kind="stable")
        at = chunk[order]
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
        sketch = np.zeros(total, np.uint64)
        if len(heads):
            sketch[at[heads]] = np.bitwise_xor.reduceat(bit[order], heads)
        owner = np.repeat(np.arange(len(n)), m)
        held = np.bincount(chunk, minlength=total)
        out = np.ones(total, bool)
        for weak in range(WEAK + 1):
            few = held <= weak
            leave = (np.bincount(owner[few], minlength=len(n)) <= slack) & (differ > 0)
            out[few & leave[owner]] = False
        number = (np.arange(total) - first[owner]).astype(np.uint64)
        key = _marked(mix(mix(number + (band[owner].astype(np.uint64) << np.uint64(32))) + sketch + np.minimum(held, 3).astype(np.uint64)), band[owner])
        keys.append(key[out])
        whose.append(owner[out])
    return np.concatenate(keys).view(np.int64), np.concatenate(whose)


def _texts(docs: DataFrame) -> DataFrame:
    """Texts keyed by doc_id and a hash of the text, for rows that share a doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("twin", F.xxhash64("text"))


#: Words of the whole set's sketch. Sets that differ in d shingles differ in about 512 (1 - exp(-d / 512)) of its bits.
SHORT = tuple(f"s{k}" for k in range(16))


def short_sketches(every: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The parity sketch of each whole set over 1,024 bits, as 16 words."""
    n, words = len(offsets) - 1, len(SHORT)
    bit = mix(every ^ np.uint64(0xA5A5A5A5))
    at = np.repeat(np.arange(n), np.diff(offsets)) * (64 * words) + (bit % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(at, minlength=n * 64 * words) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").view("<i8").reshape(n, words)
    return [np.ascontiguousarray(packed[:, k]) for k in range(words)]


def wide_sketches(every: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    """The parity sketch of each set of more than WIDE shingles, as bytes."""
    out: list[bytes | None] = [None] * (len(offsets) - 1)
    for r in np.flatnonzero(np.diff(offsets) > WIDE):
        own = every[offsets[r] : offsets[r + 1]]
        bits = 1 << (len(own) - 1).bit_length()
        odd = np.bincount((mix(own ^ np.uint64(0x3C3C3C3C)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out[r] = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return out


def _wide_bits(a: pa.Array, b: pa.Array) -> pa.Array:
    """Bits in which two wide sketches differ, the longer one folded to the length of the other; null without both."""
    out = []
    for x, y in zip(a, b, strict=True):
        if not x.is_valid or not y.is_valid:
            out.append(None)
            continue
        x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
        while len(x) != len(y):
            x, y = (x, y) if len(x) > len(y) else (y, x)
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out.append(int(np.bitwise_count(x ^ y).sum()))
    return pa.array(out, pa.int32())


def _wide_near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose wide sketches, if both have one, allow a link."""
    side = lambda c: classes.select(F.col("code").alias(c), F.col("n").alias(f"{c}n"), F.col("wide").alias(f"{c}w"))
    bits = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("bits", F.arrow_udf(_wide_bits, "int")("aw", "bw"))
    return bits.where(F.col("bits").isNull() | (F.col("bits") * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent))).select("a", "b")


def _near(a: str, b: str, percent: int) -> Column:
    """Whether sizes and short sketches of two sets allow a link: sketches differ in no more bits than linked sets in shingles."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    bits = reduce(Column.__add__, [F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in SHORT])
    return (bits * (100 + percent) <= (n + m) * (100 - percent)) & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def _sizes(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in chunks(batch, "text", CHUNK):
                every, offsets = shingle_sets(data, at, k)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("twin"), pa.array(np.diff(offsets)), pa.array(set_codes(every, offsets, percent)), pa.array(wide_sketches(every, offsets), pa.binary()), *map(pa.array, short_sketches(every, offsets))], names=["doc_id", "twin", "n", "code", "wide", *SHORT])

    return run


def _keys(k: int, percent: int):
    """Keys of each set, once for all copies that a task reads: of a large group of copies a bucket gets a row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for _, data, at in chunks(batch, "text", CHUNK):
                every, offsets = shingle_sets(data, at, k)
                codes = set_codes(every, offsets, percent)
                new = np.zeros(len(codes), bool)
                new[np.unique(codes, return_index=True)[1]] = True
                new &= [c not in sent for c in codes.tolist()]
                sent.update(codes[new].tolist())
                every = every[np.repeat(new, np.diff(offsets))]
                codes, offsets = codes[new], np.append(0, np.cumsum(np.diff(offsets)[new]))
                key, whose = sketch_keys(every, offsets, percent)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(codes[whose])], names=["key", "code"])

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, code): for each later distinct code of a key, the key's first code."""
    last = (None, None, None)  # key, its first code, the code before
    for batch in batches:
        key, code = batch.column("key").to_numpy(), batch.column("code").to_numpy()
        if not len(key):
            continue
        head = np.append(key[0] != last[0], key[1:] != key[:-1])
        at = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
        first = np.where(at >= 0, code[at], last[1] if last[1] is not None else 0)
        before = np.append(last[2] if last[2] is not None else 0, code[:-1])
        other = ~head & (code != before)
        yield pa.RecordBatch.from_arrays([pa.array(key[other]), pa.array(first[other]), pa.array(code[other])], names=["key", "a", "b"])
        last = (key[-1], first[-1], code[-1])


def _verify(k: int, percent: int):
    """Rows sorted by (a, part, kind): a representative (kind 0), then its members: links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_code, a_set = None, None
        for batch in batches:
            for part, data, at in chunks(batch, "text", CHUNK):
                every, offsets = shingle_sets(data, at, k)
                kind, a, b = (part.column(c).to_numpy() for c in ("kind", "a", "b"))
                ok = np.zeros(len(kind), bool)
                for r in range(len(kind)):
                    own = every[offsets[r] : offsets[r + 1]]
                    if kind[r] == 0:
                        a_code, a_set = a[r], own
                    elif a[r] == a_code and len(own):
                        place = np.minimum(np.searchsorted(a_set, own), len(a_set) - 1)
                        both = int((a_set[place] == own).sum())
                        ok[r] = 100 * both >= percent * (len(own) + len(a_set) - both)
                yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    return run


def links_of(pairs: DataFrame, texts: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class codes whose sets are similar, by their representatives' texts; a stored() table."""
    need = pairs.select(F.col("a").alias("code")).unionByName(pairs.select(F.col("b").alias("code"))).distinct().join(classes, "code").select("code", F.col("doc_id").alias("_id"), F.col("twin").alias("_twin"))
    found = stored(texts.join(need, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin"))).select("code", "text"), "texts")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    members = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).join(found.withColumnRenamed("code", "b"), "b").select("a", "b", "part", F.lit(1).alias("kind"), "text")
    heads = parts.join(found.withColumnRenamed("code", "a"), "a").select("a", F.lit(0).cast("long").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "text")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = stored(heads.unionByName(members).repartition(n, "a", "part").sortWithinPartitions("a", "part", "kind").mapInArrow(lean(_verify(k, percent)), "a long, b long"), "links")
    discard(found)
    return links


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs.

    A text without words has no shingles and is a component by itself. Rows with one doc_id are one or more texts with
    one id, each in its own component. A null doc_id counts as larger than all others, and names a component only
    if no other id is in it (component_id null).
    """
    texts = _texts(docs)
    sized = stored(texts.mapInArrow(lean(_sizes(words, percent)), "doc_id long, twin long, n long, code long, wide binary, " + ", ".join(f"{c} long" for c in SHORT)), "sizes")
    lowest: Column = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "twin"))
    classes = stored(sized.where("n > 0").groupBy("code").agg(lowest.alias("low"), *(F.min(c).alias(c) for c in ("n", "wide", *SHORT))).select("code", F.col("low.doc_id").alias("doc_id"), F.col("low.twin").alias("twin"), "n", "wide", *SHORT), "classes")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.where(F.length("text") > 0).select("text").mapInArrow(lean(_keys(words, percent)), "key long, code long")
    buckets = stored(rows.repartition(max(n, 1), "key").sortWithinPartitions("key", "code").mapInArrow(lean(_buckets), "key long, a long, b long"), "buckets")
    short = lambda c: classes.select(F.col("code").alias(c), *(F.col(x).alias(c + x) for x in ("n", *SHORT)))
    likely = lambda df: _wide_near(df.join(short("a"), "a").join(short("b"), "b").where(_near("a", "b", percent)).select("a", "b"), classes, percent)
    star = stored(likely(buckets.select("a", "b").distinct()), "pairs")
    links = links_of(star, texts, classes, words, percent)
    of = components(links)
    #: Buckets that still hold more than one component. For a few rounds another member, drawn by a hash of it and the round,
    #: is the centre of a new star, so that groups of near copies grow together; a round's pairs are no more than the members.
    label = lambda df, c: df.join(of.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of")), c, "left").withColumn(f"{c}_of", F.coalesce(f"{c}_of", c))

    def split(rows: DataFrame) -> DataFrame:
        rows = label(label(rows, "a"), "b")
        return stored(rows.join(rows.where("a_of <> b_of").select("key").distinct(), "key", "left_semi"), "left")

    left = split(buckets)
    discard(buckets)
    for k in range(STARS):
        centres = left.groupBy("key").agg(F.min(F.struct(F.xxhash64("b", F.lit(k)), "b", "b_of")).alias("low")).select("key", F.col("low.b").alias("centre"), F.col("low.b_of").alias("centre_of"))
        again = left.select("key", "b", "b_of").join(centres, "key").where("centre_of <> b_of").select(F.least("centre", "b").alias("a"), F.greatest("centre", "b").alias("b")).distinct()
        again = stored(likely(again.join(star, ["a", "b"], "left_anti")), "pairs")
        if not again.limit(1).count():
            continue
        more = links_of(again, texts, classes, words, percent)
        if more.limit(1).count():
            before, links = links, stored(links.unionByName(more), "links")
            of = components(links)
            discard(before)
            before, left = left, split(left.select("key", "a", "b"))
            discard(before)
        discard(more)
        before, star = star, stored(star.unionByName(again), "pairs")
        discard(before, again)
    #: What still lies apart is held against all others of its bucket outside its component.
    own = left.where("a_of <> b_of").select("key", "b", "b_of")
    if own.limit(1).count():
        every = left.select("key", F.col("b").alias("c"), F.col("b_of").alias("c_of"), (F.col("a_of") == F.col("b_of")).alias("home"))
        #: Two sets of one band share a key of that band if they are linked; their keys of the next band would only repeat the pair.
        upper = lambda c: F.col("key").bitwiseXOR(F.col(c)).bitwiseAND(F.lit(1)) == 1
        own = own.withColumn("b_up", upper("b")).join(short("b"), "b")
        every = every.withColumn("c_up", upper("c")).join(short("c"), "c")
        once = (F.col("home") | (F.col("b") < F.col("c"))) & ~(F.col("b_up") & F.col("c_up"))
        crossed = own.join(every, (own["key"] == every["key"]) & (F.col("b_of") != F.col("c_of")) & once & _near("b", "c", percent)).select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct()
        crossed = stored(_wide_near(crossed.join(star, ["a", "b"], "left_anti"), classes, percent), "crossed")
        if crossed.limit(1).count():
            more = links_of(crossed, texts, classes, words, percent)
            if more.limit(1).count():
                of = components(links.unionByName(more))
            discard(more)
        discard(crossed)
    discard(left, star, links)
    named = classes.join(of, F.col("code") == F.col("node"), "left").withColumn("component", F.coalesce("component", "code"))
    low = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_code = named.select("code", "component").join(low, "component").select("code", "component_id")
    return sized.join(by_code, "code", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component, that with the smallest doc_id; of rows that share it, one of each text."""
    own = unused(docs, "_id")
    found = jaccard_components(docs, words, percent).where("doc_id <=> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(own)), "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)


#: DuckDB.
SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS to_id FROM words UNION SELECT r.doc_id, ways.b FROM reach r JOIN ways ON r.to_id = ways.a)
SELECT words.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM words LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""
