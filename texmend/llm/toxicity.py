"""Toxicity by compression distance.

zstandard trains one dictionary on the toxic texts of a bounded labelled sample and one on the ordinary ones. A window is
some neighbouring words of the running text, and the next one starts with its last word: every word and every two
neighbours of a text lie in a window, and every window is measured. Its gap is its compressed length with the ordinary
dictionary less that with both; the ordinary one is on top, so that what it has is written alike by both. Lengths come in
whole bytes and a window is short, so windows and dictionaries are written with three bytes a byte: what a match saves
then stands out from a frame's own bytes. Thresholds on gaps are calibrated on the ordinary rows, and the weights of the
shares of windows beyond them on all labelled rows, each time on rows that the dictionaries did not see.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, NOT_ALNUM, lean

#: Bound of the labelled sample, a class: the rows with the smallest hashes of doc_id.
SAMPLE_ROWS = 2500
#: Bytes of the two dictionaries; segment and substring lengths of their training.
TOXIC_BYTES, ORDINARY_BYTES, SEGMENT, SUBSTRING = 4096, 32768, 12, 6
#: Words of a window; bytes of a word beyond which its next bytes count as a further word, so that dictionaries stay within reach.
WINDOW, LONG = 6, 64
#: Shares of ordinary texts' windows that lie below the thresholds.
QUANTILES = (0.5, 0.8, 0.9, 0.95, 0.98, 0.99, 0.995, 0.999)
TABLE = bytes(32 if NOT_ALNUM[c] else int(LOWER[c]) for c in range(256))
TRIPLED = np.array([(c, 3 * c + 37 & 255, 5 * c + 74 & 255) for c in range(256)], np.uint8)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TABLE).split()


def tripled(data: bytes) -> bytes:
    return TRIPLED[np.frombuffer(data, np.uint8)].tobytes()


def train_dictionary(size: int, texts: list[str]) -> bytes:
    """A dictionary of `size` bytes trained on texts, or of less where they are too few for it."""
    samples = [b" " + b" ".join(words_of(t)) + b" " for t in texts]
    while size >= 256:
        try:
            return zstandard.train_dictionary(size, samples, k=SEGMENT, d=SUBSTRING).as_bytes()
        except zstandard.ZstdError:
            size //= 2
    return b"".join(samples)[: ORDINARY_BYTES] or b" " * 8


def train_dictionaries(texts: list[str], toxic: list[int]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary."""
    own = lambda label: [t for t, y in zip(texts, toxic, strict=True) if y == label]
    return train_dictionary(TOXIC_BYTES, own(1)), train_dictionary(ORDINARY_BYTES, own(0))


class Distance:
    """Gaps of windows, and the features of a text."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.raw = toxic, ordinary
        self.toxic, self.ordinary = self._compressor(toxic + ordinary), self._compressor(ordinary)

    @staticmethod
    def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
        # tables with room for every character of both dictionaries
        params = zstandard.ZstdCompressionParameters(min_match=7, strategy=zstandard.STRATEGY_DFAST, window_log=17, hash_log=17, chain_log=17, target_length=1, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        trained = zstandard.ZstdCompressionDict(tripled(raw), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        trained.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=trained, compression_params=params)

    def gap(self, window: bytes) -> int:
        """The gap of a window in three bytes a byte."""
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))

    def gaps(self, text: str | None) -> tuple[Counter, int]:
        """The gaps of all windows, and the number of words."""
        words = words_of(text)
        if not words:
            return Counter(), 0
        data = b" " + b" ".join(words) + b" "
        at = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        pieces = -((1 - np.diff(at)) // LONG)
        n = int(pieces.sum())
        at = np.append(np.repeat(at[:-1] - LONG * (np.cumsum(pieces) - pieces), pieces) + LONG * np.arange(n), at[-1])
        data, first = tripled(data), np.arange(0, max(1, n - 1), WINDOW - 1)
        starts, ends = 3 * at[first], 3 * at[np.minimum(first + WINDOW, n)] + 3
        return Counter([self.gap(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), n


def thresholds(gaps: list[Counter]) -> list[int]:
    """Gaps below which the QUANTILES of all windows lie, each once."""
    total = sum(gaps, Counter())
    if not total:
        return [1]
    values = np.array(sorted(total))
    below = np.cumsum([total[v] for v in values]) / total.total()
    return sorted({int(values[min(np.searchsorted(below, q), len(values) - 1)]) + 1 for q in QUANTILES})


def features(gaps: Counter, n: int, at: list[int]) -> list[float]:
    over = [sum(c for g, c in gaps.items() if g >= t) for t in at]
    return [100 * x / max(1, n) for x in over] + [float(np.log1p(x)) for x in over] + [float(np.log(max(1, n)))]


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps: mean and scale of the features, weights with the constant last."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
    return mean, scale, w


def fit(texts: list[str], toxic: list[int]) -> tuple[Distance, list[int], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Calibrates thresholds and weights on out-of-fold gaps of three folds, then trains the dictionaries on all rows."""
    seen, y = [], []
    for fold in range(3):
        at = [k for k in range(len(texts)) if k % 3 != fold]
        model = Distance(*train_dictionaries([texts[k] for k in at], [toxic[k] for k in at]))
        for k in range(fold, len(texts), 3):
            seen.append(model.gaps(texts[k]))
            y.append(toxic[k])
    at = thresholds([g for (g, _), label in zip(seen, y, strict=True) if not label])
    return Distance(*train_dictionaries(texts, toxic)), at, fit_weights(np.array([features(g, n, at) for g, n in seen]), np.array(y, float))


def held_out() -> F.Column:
    """crc32(doc_id as text) mod 3 is 1; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Of repeated or contradictory labels of a doc_id toxic wins; null labels are left out. Null and empty texts have no
    windows and get the score of a text without a gap. With fewer than two classes of labels every score is the
    share of toxic labels (0 without labels).
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = []
    for label in (0, 1):
        chosen = labels.where((F.col("toxic") == label) & ~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        rows += texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect()  # at most sample_rows ids
    rows = sorted({(r.doc_id, r.text or "", r.toxic) for r in rows})
    share = float(np.mean([r[2] for r in rows])) if rows else 0.0
    known = [r[1] for r in rows], [r[2] for r in rows]
    model = None
    if min(Counter(known[1]).values(), default=0) >= 3 and len(set(known[1])) == 2:
        distance, at, weights = fit(*known)
        model = (*distance.raw, at, *weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model:
            distance, (at, mean, scale, w) = Distance(*model[:2]), model[2:]
        for batch in batches:
            if model and batch.num_rows:
                x = np.array([features(*distance.gaps(t.as_py()), at) for t in batch.column("text")])
                score = 1 / (1 + np.exp(-np.clip(np.c_[(x - mean) / scale, np.ones(len(x))] @ w, -30, 30)))
            else:
                score = np.full(batch.num_rows, share)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return texts.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(lean(judge), "doc_id long, held_out boolean, score double, predicted int")
