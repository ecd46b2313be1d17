"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The model predicts a word from the two before it: the sum of their vectors, each scaled by its position's weights, times
the vector of the word's class, plus its bias, and likewise for the word in its class. The commonest words, GROWTH times the root
of the training tokens, have vectors of their own, so the model grows with the corpus; other words share one symbol and are told
apart by their smoothed counts. Every task trains on the training texts that it reads, telling words from a sample of noise;
a word's parameters are averaged by its tokens in each task. The normalisers over classes and over the words of a class come
from batched matrix products, so token probabilities sum to one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, RangeHash, chunks, lean, word_bounds
from .work import stored

SIZE, NOISE, OWN_NOISE, BATCH, RATE = 16, 64, 5, 4096, 0.1
#: Rows of one matrix of logits, so that it stays in the processor's cache.
ROWS = 512
#: Occurrences in the training texts that give a word vectors of its own, and words that are a class each.
LEAST, HEAD = 20, 250
#: Words with vectors of their own, as a multiple of the root of the number of training words: tasks and driver hold the model whole.
GROWTH = 2
#: Words whose counts go to every task, at most; the others are joined.
COMMON = 400_000
CHUNK = (1 << 22) - 1
DOCS = ["CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text"]


def held_out() -> F.Column:
    """crc32(doc_id as text) mod 5 is 1; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def word_codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends, words_at = word_bounds(data, at)
    return RangeHash(data)(starts, ends).view(np.int64), words_at


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, at in chunks(batch, "text", CHUNK):
            words, counts = np.unique(word_codes(data, at)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], names=["word", "c"])


class Symbols:
    """Numbers of words: the vocabulary's 0..K-1, K for all others, K + 1 for the end."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words)
        self.order = np.argsort(words, kind="stable")
        self.other, self.end = len(words), len(words) + 1

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if not self.other:
            return np.full(len(codes), self.other)
        k = np.minimum(np.searchsorted(self.words, codes), self.other - 1)
        return np.where(self.words[k] == codes, self.order[k], self.other)

    def trigrams(self, codes: np.ndarray, words_at: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of all texts with an end after each, the two before each (ends before a text), and each text's first place; own: the words' symbols, if known."""
        n = np.diff(words_at)
        rows = np.arange(len(n))
        symbols = np.full(len(codes) + len(n), self.end)
        symbols[np.arange(len(codes)) + np.repeat(rows, n)] = self(codes) if own is None else own
        first = words_at[:-1] + rows
        one, two = np.full(len(symbols), self.end), np.full(len(symbols), self.end)
        one[1:], two[2:] = symbols[:-1], symbols[:-2]
        one[first], two[first] = self.end, self.end
        two[np.minimum(first + 1, len(symbols) - 1)] = self.end
        return symbols, one, two, first


def _scatter(p: np.ndarray, squares: np.ndarray, at: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """One Adagrad step on the rows `at` of p, whose gradients add up where rows repeat."""
    order = np.argsort(at.astype(np.uint16) if len(p) < 1 << 16 else at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    g, own = np.add.reduceat(grads[order], first), at[first]
    squares[own] += g * g
    p[own] -= rate * g / np.sqrt(squares[own])


def _log_sum(logits: np.ndarray) -> np.ndarray:
    """Logarithms of the rows' sums of exponentials; logits is overwritten."""
    top = logits.max(1)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return top + np.log(logits.sum(1))


class LogBilinear:
    """Parameters: r (vectors as context), q (as target in its class), p and b (vectors and biases of classes), c (weights of the two positions).

    Symbols are words by falling frequency, then the other words' symbol and the end. The first `head` words and the last two
    symbols are each a class; the words between lie in blocks of about the root of their number. A word's probability is its
    class's times its own in the class, whose bias is the logarithm of its share.
    """

    def __init__(self, share: np.ndarray, size: int = SIZE, seed: int = 5, head: int = HEAD):
        rng = np.random.default_rng(seed)
        self.share = share / share.sum()
        n, k = len(share), len(share) - 2
        self.head = min(head, k)
        self.tail = k - self.head
        self.block = max(1, math.isqrt(self.tail))
        self.class_of = np.arange(n)
        self.class_of[self.head : k] = self.head + 2 + np.arange(self.tail) // self.block
        self.class_of[k:] = self.head, self.head + 1
        self.class_share = np.bincount(self.class_of, self.share)
        self.own_share = np.log(self.share[self.head : k] / self.class_share[self.class_of[self.head : k]]).astype(np.float32)
        self.r, self.q, self.p = (rng.normal(0, 0.1, (m, size)).astype(np.float32) for m in (n, self.tail, len(self.class_share)))
        self.c = np.ones((2, size), np.float32)
        self.b = np.log(self.class_share).astype(np.float32)
        self.squares: list[np.ndarray] = []

    def dense(self) -> list[np.ndarray]:
        return [self.p, self.c, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.dense()])

    def load(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for p in self.dense():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def rows(self, symbols: np.ndarray) -> np.ndarray:
        """The vectors of symbols as context and as target in their class, zeros where they are their class."""
        out = np.zeros((len(symbols), 2 * self.r.shape[1]), np.float32)
        out[:, : self.r.shape[1]] = self.r[symbols]
        own = (symbols >= self.head) & (symbols < self.head + self.tail)
        out[own, self.r.shape[1] :] = self.q[symbols[own] - self.head]
        return out

    def load_rows(self, symbols: np.ndarray, rows: np.ndarray) -> None:
        self.r[symbols] = rows[:, : self.r.shape[1]]
        own = (symbols >= self.head) & (symbols < self.head + self.tail)
        self.q[symbols[own] - self.head] = rows[own, self.r.shape[1] :]

    def step(self, two: np.ndarray, one: np.ndarray, word: np.ndarray, weight: np.ndarray, rng: np.random.Generator, rate: float = RATE) -> None:
        """One noise-contrastive step with Adagrad. Noise classes, drawn by frequency, are shared by the batch; noise words are drawn for each word from its block."""
        if not self.squares:
            self.squares = [np.ones_like(self.r), np.ones_like(self.q), *(np.full_like(p, 1e-2) for p in self.dense())]
        noise = rng.choice(len(self.class_share), NOISE, p=self.class_share)
        kind = self.class_of[word]
        h = self.c[0] * self.r[one] + self.c[1] * self.r[two]
        log_kn = np.log(NOISE * self.class_share).astype(np.float32)
        sig = lambda x: np.reciprocal(1 + np.exp(np.minimum(-x, 60, out=x)))
        true = (h * self.p[kind]).sum(1) + self.b[kind] - log_kn[kind]
        false = h @ self.p[noise].T + self.b[noise] - log_kn[noise]
        total = np.float32(weight.sum())
        weight = weight.astype(np.float32)
        d_true = (sig(true) - 1) * weight
        d_false = sig(false) * weight[:, None]
        d_h = d_true[:, None] * self.p[kind] + d_false @ self.p[noise]
        grads = [np.zeros_like(p) for p in self.dense()]
        np.add.at(grads[0], kind, d_true[:, None] * h)
        np.add.at(grads[0], noise, d_false.T @ h)
        np.add.at(grads[2], kind, d_true)
        np.add.at(grads[2], noise, d_false.sum(0))
        deep = np.flatnonzero(kind >= self.head + 2)
        if len(deep):
            first = (kind[deep] - self.head - 2) * self.block
            size = np.minimum(self.block, self.tail - first)
            drawn = first[:, None] + (rng.random((len(deep), OWN_NOISE)) * size[:, None]).astype(np.int64)
            at = np.concatenate([(word[deep] - self.head)[:, None], drawn], axis=1)
            q, own = self.q[at], h[deep]
            d = sig(np.einsum("md,mkd->mk", own, q) + self.own_share[at] - np.log(OWN_NOISE / size)[:, None].astype(np.float32))
            d[:, 0] -= 1
            d *= weight[deep, None]
            d_h[deep] += np.einsum("mk,mkd->md", d, q)
            _scatter(self.q, self.squares[1], at.ravel(), (d[:, :, None] * own[:, None, :]).reshape(-1, own.shape[1]), rate)
        grads[1][0], grads[1][1] = (d_h * self.r[one]).sum(0), (d_h * self.r[two]).sum(0)
        _scatter(self.r, self.squares[0], np.append(one, two), np.concatenate([d_h * self.c[0], d_h * self.c[1]]), rate)
        for p, g, s in zip(self.dense(), grads, self.squares[2:], strict=True):
            g /= total
            s += g * g
            p -= rate * g / np.sqrt(s)

    def learn(self, symbols: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the distinct trigrams, weighted by their counts."""
        n = len(self.share)
        context, which = np.unique(two * n + one, return_inverse=True)
        keys, weight = np.unique(which * n + symbols, return_counts=True)
        order = rng.permutation(len(keys))
        for k in range(0, len(keys), BATCH):
            own = keys[order[k : k + BATCH]]
            before = context[own // n]
            self.step(before // n, before % n, own % n, weight[order[k : k + BATCH]], rng)

    def class_normalisers(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Natural log of the sum over all classes for each of the contexts."""
        out = np.empty(len(two), np.float32)
        p = np.ascontiguousarray(self.p.T)
        room = np.empty((ROWS, p.shape[1]), np.float32)
        for k in range(0, len(two), ROWS):
            part = slice(k, k + ROWS)
            logits = room[: len(one[part])]
            np.matmul(self.c[0] * self.r[one[part]] + self.c[1] * self.r[two[part]], p, out=logits)
            logits += self.b
            out[part] = _log_sum(logits)
        return out

    def normalisers(self) -> np.ndarray:
        """class_normalisers() of all contexts (two, one) of a small model."""
        n = len(self.share)
        return self.class_normalisers(np.repeat(np.arange(n), n), np.tile(np.arange(n), n)).reshape(n, n)

    def log_probs(self, symbols: np.ndarray, one: np.ndarray, two: np.ndarray, z: np.ndarray | None = None) -> np.ndarray:
        """Natural log probabilities; z: normalisers(), else those of the contexts at hand are computed."""
        n = len(self.share)
        kind = self.class_of[symbols]
        hidden = lambda at: self.c[0] * self.r[one[at]] + self.c[1] * self.r[two[at]]
        if z is None:
            context, which = np.unique(two * n + one, return_inverse=True)
            over = self.class_normalisers(context // n, context % n)[which]
        else:
            over = z[two, one]
        out = self.b[kind] - over
        for k in range(0, len(out), 8 * ROWS):
            part = slice(k, k + 8 * ROWS)
            out[part] += np.einsum("ij,ij->i", hidden(part), self.p[kind[part]])
        deep = np.flatnonzero(kind >= self.head + 2)
        deep = deep[np.argsort(kind[deep], kind="stable")]
        cuts = np.flatnonzero(np.diff(kind[deep])) + 1
        for rows in np.split(deep, cuts) if len(deep) else ():
            first = (kind[rows[0]] - self.head - 2) * self.block
            block = slice(first, min(first + self.block, self.tail))
            for k in range(0, len(rows), ROWS):
                some = rows[k : k + ROWS]
                logits = hidden(some) @ self.q[block].T
                logits += self.own_share[block]
                own = logits[np.arange(len(some)), symbols[some] - self.head - first]
                out[some] += own - _log_sum(logits)
        return out


TRAINED_DDL = "part int, symbol int, weight double, params binary"


def _trained(part: int, symbols: np.ndarray, weight: np.ndarray, params: np.ndarray) -> pa.RecordBatch:
    values = [row.tobytes() for row in params]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(symbols), part, np.int32)), pa.array(symbols.astype(np.int32)), pa.array(weight.astype(float)), pa.array(values, pa.binary())], names=["part", "symbol", "weight", "params"])


def _train(start: LogBilinear, symbols_of: Symbols):
    """A row with symbol -1 for what all words share, and one for each symbol that the task read, weighted by its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, model, seen = np.random.default_rng(part), start, np.zeros(len(start.share), np.int64)
        for batch in batches:
            for _, data, at in chunks(batch, "text", CHUNK):
                symbols, one, two, _ = symbols_of.trigrams(*word_codes(data, at))
                model.learn(symbols, one, two, rng)
                seen += np.bincount(symbols, minlength=len(seen))
        if seen.any():
            yield _trained(part, np.array([-1]), seen.sum(keepdims=True), model.flat()[None])
            read = np.flatnonzero(seen)
            for k in range(0, len(read), 10_000):
                some = read[k : k + 10_000]
                yield _trained(part, some, seen[some], model.rows(some))

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted means of each symbol's params and its weight."""
    symbols, weight, total = np.zeros(0, np.int64), np.zeros(0), None
    for batch in batches:
        if not batch.num_rows:
            continue
        w = batch.column("weight").to_numpy()
        own = np.frombuffer(b"".join(batch.column("params").to_pylist()), np.float32).reshape(len(w), -1) * w[:, None]
        every = np.append(symbols, batch.column("symbol").to_numpy())
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(every[order]) != 0))
        symbols = every[order][first]
        weight = np.add.reduceat(np.append(weight, w)[order], first)
        total = np.add.reduceat((own if total is None else np.concatenate([total, own]))[order], first, axis=0)
    if len(symbols):
        yield _trained(0, symbols, weight, (total / weight[:, None]).astype(np.float32))


def fit(train: DataFrame, symbols_of: Symbols, share: np.ndarray) -> LogBilinear:
    """Trains on all rows of train; the driver gets at most 32 averages of what all words share, and one row a symbol."""
    model = LogBilinear(share)
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stored(train.select("text").mapInArrow(lean(_train(model, symbols_of)), TRAINED_DDL), "params")
    means = parts.where("symbol < 0").repartition(32, "part").mapInArrow(lean(_average), TRAINED_DDL).collect()
    if means:
        flats = sorted((bytes(r.params), r.weight) for r in means)
        model.load(np.average([np.frombuffer(p, np.float32) for p, _ in flats], axis=0, weights=[t for _, t in flats]).astype(np.float32))
        rows = parts.where("symbol >= 0").repartition(max(n, 1), "symbol").mapInArrow(lean(_average), TRAINED_DDL).select("symbol", "params").toArrow()
        for batch in rows.to_batches():
            if batch.num_rows:
                vectors = np.frombuffer(b"".join(batch.column("params").to_pylist()), np.float32).reshape(batch.num_rows, -1)
                model.load_rows(batch.column("symbol").to_numpy().astype(np.int64), vectors)
    model.squares = []
    return model


def _common(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Words with at least the least count that keeps them at `most`, with their counts, by hash; and that count."""
    kinds = counts.groupBy("c").agg(F.count("*").alias("words"))
    #: The count of counts is small: it grows with the root of the tokens.
    rows = sorted(((r.c, r.words) for r in kinds.collect()), reverse=True)
    taken, least = 0, (rows[0][0] + 1) if rows else 1
    for c, words in rows:
        if taken + words > most:
            break
        taken, least = taken + words, c
    own = counts.where(F.col("c") >= least).toPandas().sort_values("word")
    return own.word.to_numpy(np.int64), own.c.to_numpy(np.int64), least


ROW_DDL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, common double, model double, rare array<long>"


def scores(docs: DataFrame, vocabulary: int | None = None, common: int = COMMON, least: int = LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    The model knows the commonest words that have `least` occurrences in the training texts, GROWTH times the root of the number of
    training words, or the `vocabulary` commonest where that is given.
    A null or empty text is one end. Rows with one doc_id are each counted and scored. Without training texts every count
    is 0, every base score 0 and the model knows ends and other words only.
    """
    #: One thread a worker for matrix products: a task has one core.
    docs.sparkSession.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    texts = docs.selectExpr(*DOCS)
    train = texts.where(~held_out())
    counts = stored(train.select("text").mapInArrow(lean(_counts), "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    n, v = totals.n + ends, totals.v + (ends > 0)
    words, c, _ = _common(counts, common)
    top = np.lexsort((words, -c))[: min((c >= least).sum(), int(GROWTH * math.sqrt(totals.n))) if vocabulary is None else vocabulary]
    symbols_of = Symbols(words[top])
    known = c[top]
    share = np.append(known, [totals.n - known.sum(), ends]).astype(float) + 0.5
    model = fit(train, symbols_of, share)
    #: Words beyond the vocabulary: add one half over their kinds and one more.
    other = np.log10(totals.n - known.sum() + 0.5 * (totals.v - len(top) + 1))
    unit = np.log10(n + 0.5 * (v + 1))
    #: The symbols of the common words, among which the vocabulary is.
    symbol_of, log_count = symbols_of(words), np.log10(c + 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, data, at in chunks(batch, "text", CHUNK):
                codes, words_at = word_codes(data, at)
                rows = np.arange(part.num_rows)
                k = np.minimum(np.searchsorted(words, codes), max(0, len(words) - 1))
                usual = words[k] == codes if len(words) else np.zeros(len(codes), bool)
                logs = np.where(usual, log_count[k], 0.0) if len(words) else np.zeros(len(codes))
                own = np.where(usual, symbol_of[k], symbols_of.other) if len(words) else np.full(len(codes), symbols_of.other)
                symbols, one, two, first = symbols_of.trigrams(codes, words_at, own)
                beyond = own == symbols_of.other
                row = np.repeat(rows, np.diff(words_at))
                total = lambda x, row=row: np.bincount(row, x, minlength=part.num_rows)  # noqa: B023, E731
                likely = np.add.reduceat(model.log_probs(symbols, one, two).astype(float), first) / np.log(10)
                n_words = np.diff(words_at)
                rare_at = np.append(0, np.cumsum(total(~usual))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + rows), part.column("doc_id"), part.column("held_out"), pa.array(n_words + 1), pa.array(total(usual).astype(np.int64) + (ends > 0)), pa.array(total(beyond).astype(np.int64)),
                        pa.array(total(logs) + np.log10(ends + 0.5)), pa.array(likely + total(np.where(beyond, logs, 0.0))), pa.ListArray.from_arrays(pa.array(rare_at), pa.array(codes[~usual])),
                    ],
                    names=[x.split()[0] for x in ROW_DDL.split(", ")],
                )
                number += part.num_rows

    rows = stored(texts.withColumn("held_out", held_out()).mapInArrow(lean(run), ROW_DDL), "rows")
    rare = rows.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("more"), F.count("c").alias("more_known"))
    more = F.coalesce("more", F.lit(0.0))
    return rows.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("common") + more - F.col("n_tokens") * F.lit(float(unit))).alias("base_score"), (F.col("model") + more - F.col("n_other") * F.lit(float(other))).alias("score"),
    )
