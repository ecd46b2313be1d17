"""Secret scan: pattern matches, and runs that probabilistic automata learned from labelled credentials find likely.

Grammar inference: for each kind of credential a prefix tree of character classes is built from a bounded sample of
matches labelled by kind; states whose outgoing frequencies are compatible (Hoeffding bound) are merged, with their
subtrees, into a probabilistic automaton. Every candidate run is scored by its best log likelihood a character,
less that of an automaton learned in the same way from a bounded sample of all runs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import lean
from .work import stored

#: The base patterns of the contract with the least length of the credential.
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
KINDS = ("assign", "access", "hex", "format")

#: Bounds of the training samples: distinct credentials of a kind, and distinct runs.
SAMPLE_ROWS, SAMPLE_RUNS = 400, 2000
ALPHA = 0.05
#: Least surplus of log likelihood a character.
THRESHOLD = 0.6


def symbol(c: str) -> str:
    if c.isdigit():
        return "0"
    if c.isalpha():
        return ("h" if c in "abcdef" else "l") if c.islower() else ("H" if c in "ABCDEF" else "U")
    return c


SYMBOLS = {k: symbol(chr(k)) for k in range(128)}


class Automaton:
    """A probabilistic automaton: for each state the count of ends and of moves by symbol, and the moves' targets."""

    #: 10 symbols besides the punctuation; the chance of a move never seen.
    UNSEEN = 1e-3

    def __init__(self, strings: list[str] | dict[str, int], alpha: float = ALPHA):
        """Learned from strings, each as often as a dict of them says."""
        self.ends, self.counts, self.moves = [0], [{}], [{}]
        weights = strings if isinstance(strings, dict) else Counter(strings)
        for s in sorted(weights):
            state = 0
            for c in map(symbol, s):
                if c not in self.moves[state]:
                    self.moves[state][c] = len(self.ends)
                    self.ends.append(0)
                    self.counts.append({})
                    self.moves.append({})
                self.counts[state][c] = self.counts[state].get(c, 0) + weights[s]
                state = self.moves[state][c]
            self.ends[state] += weights[s]
        self.alpha = alpha
        self._merge_states()
        self.weights = weights
        #: For each state the log likelihood and target of a move by symbol.
        self.steps = [{c: (self._log(n, self._total(q)), self.moves[q].get(c, 0)) for c, n in self.counts[q].items()} for q in range(len(self.ends))]

    def _log(self, n: int, total: int) -> float:
        return math.log((1 - 20 * self.UNSEEN) * n / max(1, total) + self.UNSEEN)

    def _total(self, q: int) -> int:
        return self.ends[q] + sum(self.counts[q].values())

    def _alike(self, a: int, b: int) -> bool:
        """Whether the futures of two states, move by move, don't differ beyond the Hoeffding bound."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self._total(a), self._total(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in self.counts[a].keys() | self.counts[b].keys():
                if abs(self.counts[a].get(c, 0) / n - self.counts[b].get(c, 0) / m) > bound:
                    return False
                if c in self.moves[a] and c in self.moves[b] and self.moves[a][c] != self.moves[b][c]:
                    pairs.append((self.moves[a][c], self.moves[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        todo = [(into, tree)]
        while todo:
            q, t = todo.pop()
            self.ends[q] += self.ends[t]
            for c, n in self.counts[t].items():
                self.counts[q][c] = self.counts[q].get(c, 0) + n
                if c in self.moves[q]:
                    todo.append((self.moves[q][c], self.moves[t][c]))
                else:
                    self.moves[q][c] = self.moves[t][c]

    def _merge_states(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.moves[0])]
        while blue:
            source, c = blue.pop(0)
            state = self.moves[source][c]
            if state in red:
                continue
            like = next((r for r in red if self._alike(r, state)), None)
            if like is None:
                red.append(state)
            else:
                self.moves[source][c] = like
                self._fold(like, state)
            blue = [(r, c) for r in red for c in sorted(self.moves[r]) if self.moves[r][c] not in red]

    def score(self, s: str) -> float:
        """Log likelihood a character; after a move never seen the walk starts anew."""
        if s in self.weights:
            return self._score_without(s)
        state, total = 0, 0.0
        for c in s.translate(SYMBOLS):
            step, state = self.steps[state].get(c, NEVER)
            total += step
        return total / max(1, len(s))

    def _score_without(self, s: str) -> float:
        """The score of a string that was learned, without one occurrence of it: a string seen once would else be likely whatever it is."""
        path, state = [], 0
        for c in map(symbol, s):
            path.append((state, c))
            state = self.moves[state].get(c, 0)
        moves, states = Counter(path), Counter(q for q, _ in path)
        return sum(self._log(self.counts[q].get(c, 0) - moves[q, c], self._total(q) - states[q]) for q, c in path) / max(1, len(s))


NEVER = math.log(Automaton.UNSEEN), 0


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) by start, then kind as listed."""
    out = [(m.start(), m.end(), 0, m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 12] if (":" in text or "=" in text) else []
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k], v) for s, e, k, v in sorted(out)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


FOUND_DDL = "array<struct<start:int,end:int,kind:string,value:string>>"
FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))


def runs(text: str, base: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, run) of the candidates: runs of credential characters that no base span holds whole."""
    at, reach = 0, -1
    for m in RUN.finditer(text):
        #: reach: the furthest end of the base spans that begin no later than the run.
        while at < len(base) and base[at][0] <= m.start():
            reach, at = max(reach, base[at][1]), at + 1
        if reach < m.end():
            yield m.start(), m.end(), m[0]


def _rank(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1


def _samples(rows: dict[str, int]):
    """Of each kind, and of runs, the task's distinct values with the smallest hashes, up to rows[kind], and their occurrences in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        #: By value its hash and occurrences. Limits only fall, so a value kept to the end was counted from its first occurrence on.
        kept: dict[str, dict[str, list[int]]] = {k: {} for k in rows}
        limit = dict.fromkeys(rows, 1 << 63)

        def trim(kind: str) -> None:
            own = sorted(kept[kind].items(), key=lambda x: (x[1][0], x[0]))[: rows[kind]]
            kept[kind] = dict(own)
            if len(own) == rows[kind]:
                limit[kind] = own[-1][1][0]

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                for kind, value in [*((k, v) for _, _, k, v in base), *(("run", v) for _, _, v in runs(text, base))]:
                    if (rank := _rank(value)) <= limit[kind]:
                        kept[kind].setdefault(value, [rank, 0])[1] += 1
                        if len(kept[kind]) > 4 * rows[kind]:
                            trim(kind)
        for kind in kept:
            trim(kind)
        every = [(k, v, r, n) for k, own in kept.items() for v, (r, n) in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*every, strict=True) if every else [()] * 4, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["kind", "value", "rank", "n"])

    return run


def samples_of(texts: DataFrame, rows: int, run_rows: int = SAMPLE_RUNS) -> dict[str, dict[str, int]]:
    """Up to `rows` distinct credentials of each kind, and `run_rows` runs, with their occurrences: those with the smallest hashes, so reruns agree."""
    bounds = {**dict.fromkeys(KINDS[:3], rows), "run": run_rows}
    found = texts.select("text").mapInArrow(lean(_samples(bounds)), "kind string, value string, rank long, n long").groupBy("kind", "rank", "value").agg(F.sum("n").alias("n"))
    found = stored(found, "samples")
    return {k: {r.value: r.n for r in found.where(F.col("kind") == k).orderBy("rank", "value").limit(most).collect()} for k, most in bounds.items()}


#: Judged runs that a task remembers, at most.
REMEMBERED = 200_000


def learned_of(samples: dict[str, dict[str, int]]) -> tuple[list[Automaton], Automaton]:
    """An automaton for each kind of credential, from distinct ones, and one of runs, each as often as it occurs."""
    return [Automaton(list(samples[k])) for k in KINDS[:3] if samples[k]], Automaton(samples["run"] or ["a1"])


def judge_of(learned: list[Automaton], ordinary: Automaton, threshold: float):
    """Whether a run is likelier a credential: its best automaton beats that of runs by `threshold` a character."""
    seen: dict[str, bool] = {}

    def likely(value: str) -> bool:
        found = seen.get(value)
        if found is None:
            if len(seen) >= REMEMBERED:
                seen.clear()
            found = seen[value] = bool(learned) and max(a.score(value) for a in learned) - ordinary.score(value) >= threshold
        return found

    return likely


def secrets(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base array of (start, end, kind, value), found: base and the method's spans with kind `format`.

    Candidates are all runs of 12 or more credential characters, the least length of a labelled one, that no base span holds whole. A null or empty text
    has no spans; rows with one doc_id are each scanned; a null doc_id stays null. Without labelled matches of any kind
    no automaton can be learned and only base spans are found.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    automata = learned_of(samples_of(texts, sample_rows))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = judge_of(*automata, threshold)
        for batch in batches:
            base, every = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                own = base_spans(text)
                more = [(s, e, KINDS[3], v) for s, e, v in runs(text, own) if likely(v)]
                base.append([dict(zip(("start", "end", "kind", "value"), x, strict=True)) for x in own])
                every.append([dict(zip(("start", "end", "kind", "value"), x, strict=True)) for x in sorted(own + more, key=lambda x: (x[0], KINDS.index(x[2])))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, FOUND), pa.array(every, FOUND)], names=["doc_id", "base", "found"])

    return texts.mapInArrow(lean(scan), f"doc_id long, base {FOUND_DDL}, found {FOUND_DDL}")


def joined(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """The digest columns of secrets()."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))


def digest(text: str | None) -> str:
    return hashlib.sha256(_joined([x[:3] for x in base_spans(text or "")]).encode()).hexdigest()
