"""Quality rules, and repetition by a suffix array over the words of each text.

The suffix arrays of many texts are built at once: words are ranked within their text, ranks of runs of 1, 2, 4, ...
words are refined by the rank of what follows, and only suffixes still tied are sorted again. The same ranks give the
longest common prefix of neighbours. The longest prefix a suffix shares with a neighbour is the maximal repeat that
starts there; the union of these spans is the covered part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import SPACE, RangeHash, chunks, covered, lean, mix, row_sums, utf8, word_bounds

#: Bytes of text that one suffix array takes at most, or one text if that is longer.
CHUNK = (1 << 20) - 1
#: A repeat counts from so many words; a text is rejected if repeats cover more than this share, or one repeat is longer than LONGEST words.
LEAST, SHARE, LONGEST = 8, 0.25, 60
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the rows of keys; ties share one."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def longest_repeats(words: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest run from it that also starts elsewhere in its row.

    words: hashes; row_end: for each word, the index of the first word after its row.
    """
    n = len(words)
    rank = _dense(mix(words) + mix(row_end.astype(np.uint64)))
    levels, k = [np.append(rank, 0)], 1
    while True:
        order = np.argsort(rank, kind="stable")
        same = rank[order][1:] == rank[order][:-1]
        tied = np.zeros(n, bool)
        tied[:-1] |= same
        tied[1:] |= same
        active = order[tied]
        if not len(active):
            break
        after = np.where(active + k < row_end[active], levels[-1][np.minimum(active + k, n)], 0)
        #: Refined ranks stay apart from those of settled suffixes: a tied group takes the places behind its first.
        heads = np.flatnonzero(np.append(True, ~same))
        first = np.repeat(heads + 1, np.diff(np.append(heads, n)))
        place = np.empty(n, np.int64)
        place[order] = first
        by = np.lexsort((after, rank[active]))
        group, follow = rank[active][by], after[by]
        new = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        group_at = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(by)), 0))
        within = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0)) - group_at
        rank = place
        rank[active[by]] = rank[active[by]] + within
        levels.append(np.append(rank, 0))
        k *= 2
    #: Prefixes shared with the next suffix, by halving steps over the levels.
    left, right = order[:-1].copy(), order[1:].copy()
    shared, a_end, b_end = np.zeros(max(0, n - 1), np.int64), row_end[order[:-1]], row_end[order[1:]]
    for j in range(len(levels) - 1, -1, -1):
        a, b = left + shared, right + shared
        fits = (a + (1 << j) <= a_end) & (b + (1 << j) <= b_end) & (a_end == b_end)
        shared += np.where(fits & (levels[j][np.minimum(a, n)] == levels[j][np.minimum(b, n)]), 1 << j, 0)
    out = np.zeros(n, np.int64)
    out[order[:-1]] = shared
    out[order[1:]] = np.maximum(out[order[1:]], shared)
    return out


def measure(data: np.ndarray, at: np.ndarray, least: int = LEAST) -> dict[str, np.ndarray]:
    """Counts for each row of a chunk."""
    starts, ends, words_at = word_bounds(data, at)
    hashes = RangeHash(data)
    n_words = np.diff(words_at)
    row_end = np.repeat(words_at[1:], n_words)
    repeat = longest_repeats(hashes(starts, ends), row_end) if len(starts) else np.zeros(0, np.int64)
    place = np.arange(len(starts))
    inside = ~SPACE[data] & ((data & 0xC0) != 0x80)
    five, own = repeat >= 5, repeat >= least
    longest = np.zeros(len(starts) + 1, np.int64)
    longest[:-1] = repeat
    return {
        "n_words": n_words,
        "word_chars": row_sums(inside, at),
        "n_symbols": row_sums(SYMBOLS[data], at),
        "n_dup_lines": _dup_lines(data, at, hashes),
        "n_repeat_words": row_sums(covered(place[five], place[five] + 5, len(starts)), words_at),
        "n_covered_words": row_sums(covered(place[own], place[own] + repeat[own], len(starts)), words_at),
        "longest_repeat": np.where(n_words > 0, np.maximum.reduceat(longest, np.minimum(words_at[:-1], len(starts))), 0),
    }


def _dup_lines(data: np.ndarray, at: np.ndarray, hashes: RangeHash) -> np.ndarray:
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([at, breaks + 1]))
    starts, ends = edges[:-1], edges[1:]
    ends = ends - ((ends > starts) & (data[np.maximum(ends, 1) - 1] == 10))
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=worded[1:])
    own = worded[ends] > worded[starts]
    starts, ends = starts[own], ends[own]
    row = np.searchsorted(at, starts, "right") - 1
    line = hashes(starts, ends)
    order = np.lexsort((starts, line, row))
    again = np.zeros(len(order), bool)
    again[1:] = (line[order][1:] == line[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order][again], minlength=len(at) - 1).astype(np.int64)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DDL = "".join(f"{c} long, " for c in COUNTS) + "base_failed boolean, kept boolean, n_covered_words long, longest_repeat long"


def _judged(batch: pa.RecordBatch, least: int, share: float, longest: int) -> Iterator[tuple[pa.RecordBatch, dict[str, np.ndarray]]]:
    for part, data, at in chunks(batch, "text", CHUNK):
        m = measure(data, at, least)
        m["base_failed"] = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        m["kept"] = ~m["base_failed"] & (m["n_covered_words"] <= share * m["n_words"]) & (m["longest_repeat"] <= longest)
        yield part, m


def quality(docs: DataFrame, least: int = LEAST, share: float = SHARE, longest: int = LONGEST) -> DataFrame:
    """doc_id and the measures and verdicts of each row.

    A null text has no words, counts 0 and fails, as does an empty one. Rows with one doc_id are judged each by itself.
    """
    columns = [x.split()[0] for x in DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, m in _judged(batch, least, share, longest):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(m[c]) for c in columns)], names=["doc_id", *columns])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(lean(run), f"doc_id long, {DDL}")


def kept(docs: DataFrame, least: int = LEAST, share: float = SHARE, longest: int = LONGEST) -> DataFrame:
    """The rows of docs that the rules keep, with docs' columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, m in _judged(batch, least, share, longest):
                yield part.filter(pa.array(m["kept"]))

    return docs.mapInArrow(lean(run), docs.schema)


#: DuckDB: all but the method's verdict, for tests; `kept` stands for it where the base fails.
BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(0, 5) AS x(j) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(c.n, 0) > 20 * len(w) AS base_failed
FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
"""
