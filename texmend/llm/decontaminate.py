"""Benchmark decontamination by a positional inverted index.

Documents are cut into segments of whole texts. A segment's index has, for each term, the ascending places of its postings
(texts follow each other with a gap that no window spans), as bytes of 32-bit differences, and one directory row. The
index is a Parquet table in the shared folder. A query term set picks posting lists; in each segment the rarest term's
places, less the term's offset in the phrase, are candidates, and the lists of the other terms, from rare to common,
are intersected with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, NOT_ALNUM, RangeHash, chunks, covered, expand, lean, word_bounds
from .work import stored, unused

WINDOW = 13
#: Bytes of text in a segment, or one text if that is longer; the places between texts.
SEGMENT, GAP = (1 << 20) - 1, 64
#: Bytes of benchmark text that a search takes at once; a larger benchmark is searched in blocks.
BLOCK_BYTES = 16 << 20
INDEX_DDL = "segment long, head boolean, term long, n int, places binary"


def term_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of each row: lower-cased runs of letters, digits and non-ASCII; and words before each row."""
    data = LOWER[data]
    starts, ends, words_at = word_bounds(data, at, NOT_ALNUM)
    return RangeHash(data)(starts, ends).view(np.int64), words_at


def build_index(docs: DataFrame) -> DataFrame:
    """Posting rows (term, n, places) and a head row (the directory) for each segment: doc_ids, null flags, word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, data, at in chunks(batch, "text", SEGMENT):
                terms, words_at = term_hashes(data, at)
                n = np.diff(words_at)
                place = (np.arange(len(terms)) + np.repeat(np.arange(len(n)) * GAP, n)).astype(np.int32)
                order = np.argsort(terms, kind="stable")
                term, place = terms[order], place[order]
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
                steps = np.diff(place, prepend=np.int32(0))
                steps[first] = place[first]
                ids = part.column("doc_id")
                head = np.concatenate([ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), n.astype(np.int64)]).tobytes()
                edges = np.append(first, len(term))
                lists = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(steps.astype(np.int32))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first) + 1, number)), pa.array(np.arange(len(first) + 1) == 0), pa.array(np.append(0, term[first])), pa.array(np.append(len(n), np.diff(edges)).astype(np.int32)), pa.concat_arrays([pa.array([head], pa.binary()), lists])],
                    names=["segment", "head", "term", "n", "places"],
                )
                number += 1

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(lean(run), INDEX_DDL)


class Segment:
    """The posting lists of one segment that a query's terms pick."""

    def __init__(self, rows: pd.DataFrame):
        lists = rows[~rows["head"]].sort_values("term")
        head = np.frombuffer(rows[rows["head"]].places.iloc[0], np.int64).reshape(3, -1)
        self.ids, self.known, self.n_words = head
        self.starts = np.cumsum(self.n_words + GAP) - self.n_words - GAP
        self.terms = lists.term.to_numpy(np.int64)
        self.df = lists.n.to_numpy(np.int64)
        self.at = np.cumsum(self.df) - self.df
        steps = np.frombuffer(b"".join(lists.places), np.int32).astype(np.int64)
        total = np.cumsum(steps)
        self.places = total - np.repeat((total - steps)[self.at], self.df) if len(steps) else steps
        #: Postings as (list, place) in one ascending array, to intersect lists by binary search.
        self.postings = np.repeat(np.arange(len(self.terms)), self.df) << 32 | self.places

    def _holds(self, lists: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each place is in its list."""
        wanted = lists << 32 | places
        k = np.minimum(np.searchsorted(self.postings, wanted), len(self.postings) - 1)
        return self.postings[k] == wanted

    def list_of(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the terms' lists, -1 for none."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        k = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[k] == terms, k, -1)

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every exact occurrence of windows (one phrase a row): window number and place."""
        lists = self.list_of(windows)
        alive = np.flatnonzero((lists >= 0).all(axis=1))
        lists = lists[alive]
        df = self.df[lists]
        by_rarity = np.argsort(df, axis=1, kind="stable")
        rarest = by_rarity[:, 0]
        rows = np.arange(len(alive))
        counts = df[rows, rarest] if len(alive) else np.zeros(0, np.int64)
        which = np.repeat(rows, counts)
        start = self.places[expand(self.at[lists[rows, rarest]], counts)] - rarest[which]
        for k in range(1, windows.shape[1]):
            offset = by_rarity[which, k]
            place = start + offset
            ok = place >= 0
            ok[ok] = self._holds(lists[which[ok], offset[ok]], place[ok])
            which, start = which[ok], start[ok]
        good = start >= 0
        return alive[which[good]], start[good]

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Places of the rarest term with every other term at most slop words away in the same text."""
        lists = self.list_of(np.unique(terms))
        if (lists < 0).any() or not len(lists):
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(self.df[lists], kind="stable")]
        own = lambda k: self.places[self.at[k] : self.at[k] + self.df[k]]
        found = own(lists[0])
        for k in lists[1:]:
            other = own(k)
            #: Within slop, and within the text.
            text = np.searchsorted(self.starts, found, "right") - 1
            low = np.searchsorted(other, np.maximum(found - slop, self.starts[text]))
            high = np.searchsorted(other, np.minimum(found + slop, self.starts[text] + self.n_words[text] - 1), "right")
            found = found[high > low]
        return found


def _queries(items: pd.DataFrame, window: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], list[str]]:
    """By phrase length: each item's distinct windows and the item number of each; the items' ids as text."""
    names = [i if isinstance(i, str) else "null" for i in items.item_id]
    column = pa.array([t if isinstance(t, str) else "" for t in items.text], pa.string())
    found: dict[int, tuple[list, list]] = {}
    row = 0
    for _, data, at in chunks(pa.RecordBatch.from_arrays([column], names=["text"]), "text", SEGMENT):
        terms, words_at = term_hashes(data, at)
        for k in range(len(words_at) - 1):
            own = terms[words_at[k] : words_at[k + 1]]
            if len(own):
                size = min(window, len(own))
                rows, whose = found.setdefault(size, ([], []))
                windows = np.unique(np.lib.stride_tricks.sliding_window_view(own, size), axis=0)
                rows.append(windows)
                whose.append(np.full(len(windows), row + k))
        row += len(words_at) - 1
    return {size: (np.concatenate(rows), np.concatenate(whose)) for size, (rows, whose) in found.items()}, names


FOUND_DDL = "segment long, place int, doc_id long, n_words long, hits array<int>, items array<string>"


def search(index: DataFrame, items: pd.DataFrame, window: int = WINDOW) -> DataFrame:
    """For each text of the index: its place in the segment, hits as starts and ends by turns (word numbers), and items found."""
    queries, names = _queries(items, window)
    spark = index.sparkSession
    terms = np.unique(np.concatenate([w.ravel() for w, _ in queries.values()])) if queries else np.zeros(0, np.int64)
    #: Written first, so that Spark knows its size and broadcasts it only if small.
    wanted = stored(spark.createDataFrame(pd.DataFrame({"term": terms}), "term long"), "terms")
    picked = index.where("head").unionByName(index.where("NOT head").join(wanted, "term", "left_semi").select(index.columns))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = Segment(rows)
        starts, ends, whose = [], [], []
        for size, (windows, item) in queries.items():
            which, start = s.phrases(windows)
            starts.append(start)
            ends.append(start + size)
            whose.append(item[which])
        starts, ends, whose = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends, whose))
        n = len(s.ids)
        doc = np.searchsorted(s.starts, starts, "right") - 1
        hit = covered(starts, ends, int(ends.max()) if len(ends) else 0)
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        run_doc = np.searchsorted(s.starts, up, "right") - 1
        hits: list[list[int]] = [[] for _ in range(n)]
        for d, a, b in zip(run_doc, up - s.starts[run_doc], down - s.starts[run_doc], strict=True):
            hits[d] += [int(a), int(b)]
        found: list[set[str]] = [set() for _ in range(n)]
        for d, k in set(zip(doc.tolist(), whose.tolist(), strict=True)):
            found[d].add(names[k])
        ids = pd.Series(s.ids, dtype="Int64").mask(s.known == 0)
        return pd.DataFrame({"segment": rows.segment.iloc[0], "place": np.arange(n, dtype=np.int32), "doc_id": ids, "n_words": s.n_words, "hits": hits, "items": [sorted(x) for x in found]})

    return picked.groupBy("segment").applyInPandas(run, FOUND_DDL)


def near(index: DataFrame, phrase: str, slop: int) -> DataFrame:
    """doc_id and word number of proximity matches: all words of a phrase within slop words of its rarest one."""
    data = np.frombuffer(phrase.encode(), np.uint8)
    terms, _ = term_hashes(data, np.array([0, len(data)]))
    wanted = index.sparkSession.createDataFrame(pd.DataFrame({"term": np.unique(terms)}), "term long")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = Segment(rows)
        place = s.near(terms, slop)
        doc = np.searchsorted(s.starts, place, "right") - 1
        return pd.DataFrame({"doc_id": pd.Series(s.ids[doc], dtype="Int64").mask(s.known[doc] == 0), "word": place - s.starts[doc]})

    picked = index.where("head").unionByName(index.where("NOT head").join(wanted, "term", "left_semi").select(index.columns))
    return picked.groupBy("segment").applyInPandas(run, "doc_id long, word long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits (word ranges) for each row of docs.

    Null and empty texts have no words and are never contaminated; benchmark rows without words hold no window. Rows with
    one doc_id are each searched; a null item_id is named `null`, a null doc_id stays null. A benchmark of more than
    BLOCK_BYTES is searched in blocks of items over the one index.
    """
    index = stored(build_index(docs), "postings")
    items = benchmark.selectExpr("CAST(CAST(item_id AS LONG) AS STRING) AS item_id", "CAST(text AS STRING) AS text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    found = None
    for k in range(blocks):
        part = search(index, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toPandas(), window)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("segment", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hit = [int(covered(np.array(h[::2], int), np.array(h[1::2], int), n).sum()) if len(h) else 0 for h, n in zip(b.hits, b.n_words, strict=True)]
            n_hit = np.array(hit, np.int64)
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "n_words": b.n_words, "n_hit": n_hit, "n_items": [len(x) for x in b["items"]], "items_sha256": [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in b["items"]], "contaminated": (n_hit > 0) & (20 * n_hit >= b.n_words)})

    return found.mapInPandas(lean(digest), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without the contaminated ones. Rows with one doc_id go together if one of them is contaminated; rows with a null doc_id likewise."""
    own = unused(docs, "_id")
    bad = stored(contamination(docs, benchmark, window).where("contaminated").select(F.col("doc_id").alias(own)).distinct(), "bad")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(own)), "left_anti")


#: DuckDB.
SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i+12], ' ') AS gram FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM wins),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT doc_id, i, size, array_to_string(w[i:i+size-1], ' ') AS gram FROM spots, sizes WHERE i + size - 1 <= len(w)),
hits AS (SELECT g.doc_id, g.i, g.size, v.item FROM grams g JOIN wins v ON g.gram = v.gram AND g.size = v.size),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
