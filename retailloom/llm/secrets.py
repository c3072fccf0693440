"""Secret scans: base patterns, and a likelihood ratio of two character Markov models.

One model learns transitions between characters from labelled secrets (what the
base patterns find), the other from ordinary identifiers: all other words as they stand, and
put together as names are (see ``identifiers``). A word that the first explains
much better than the second is a secret, too.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import ready

# The base patterns; letters count in either case in the first only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")
LEAST_ASSIGNED = 8
# A word of fewer characters cannot reach the bound on the whole ratio but by chance.
LEAST_WORD = 10
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_WORD)
_IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{4,}")

_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
STATES = len(_ALPHABET) + 1
_STATE = np.full(256, STATES - 1, np.int64)
for _i, _c in enumerate(_ALPHABET):
    _STATE[ord(_c)] = _i


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, where the secret itself starts), leftmost and non-overlapping per kind, by start and then kind."""
    found = [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _transitions(words: list[str]) -> np.ndarray:
    joined = np.frombuffer("\n".join(words).encode("ascii"), np.uint8)
    state = _STATE[joined]
    return np.bincount(state[:-1] * STATES + state[1:], minlength=STATES * STATES) if len(state) > 1 else np.zeros(STATES * STATES, np.int64)


class Covered:
    """Where base spans lie, as disjoint runs in order."""

    def __init__(self, spans: list[tuple]):
        self.begin: list[int] = []
        self.end: list[int] = []
        for _, begin, end, *_ in spans:  # by start
            if self.end and begin <= self.end[-1]:
                self.end[-1] = max(self.end[-1], end)
            else:
                self.begin.append(begin)
                self.end.append(end)

    def rests(self, begin: int, end: int) -> Iterator[tuple[int, int]]:
        """The parts of a span that no base span covers."""
        at = bisect_right(self.end, begin)
        while begin < end:
            if at == len(self.begin) or self.begin[at] >= end:
                yield begin, end
                return
            if self.begin[at] > begin:
                yield begin, self.begin[at]
            begin = max(begin, self.end[at])
            at += 1


def _count(batches):
    secret, ordinary = np.zeros(STATES * STATES, np.int64), np.zeros(STATES * STATES, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            if spans:
                secret += _transitions([text[s[3] : s[2]] for s in spans])
                covered = Covered(spans)
                ordinary += _transitions([text[b:e] for m in _IDENTIFIER.finditer(text) for b, e in covered.rests(*m.span()) if e - b >= 4])
            else:
                ordinary += _transitions(_IDENTIFIER.findall(text))
    cells = np.flatnonzero(secret + ordinary)
    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(secret[cells]), pa.array(ordinary[cells])], ["cell", "secret", "ordinary"])


_EDGE = STATES - 1
_JOINS = [_ALPHABET.index(c) for c in "_-/.="]


def identifiers(ordinary: np.ndarray) -> np.ndarray:
    """Transitions within names put together of the counted words, which prose itself hardly holds.

    A word's end and the next one's begin meet directly, with a capital, or around a joint; words
    are also written in capitals throughout; joints repeat as in rules; digits follow digits and joints as in dates and versions.
    The variants weigh as much as the words as they stand.
    """
    plain = ordinary.astype(float).reshape(STATES, STATES)
    begins, ends = plain[_EDGE].copy(), plain[:, _EDGE].copy()
    begins[_EDGE] = ends[_EDGE] = 0
    upper = np.arange(STATES)
    upper[:26] = np.arange(26, 52)
    capital = np.zeros(STATES)
    np.add.at(capital, upper, begins)
    out, words = plain.copy(), max(1.0, begins.sum())
    out += np.outer(ends, capital) / words  # camelCase
    capital_end = np.zeros(STATES)
    np.add.at(capital_end, upper, ends)
    shouted = np.zeros_like(plain)
    np.add.at(shouted, (upper[:, None], upper[None, :]), plain)
    out += shouted / 4
    digits = [_ALPHABET.index(c) for c in "0123456789"]
    for joint in _JOINS:
        share = 1 / len(_JOINS)
        out[:, joint] += share * (ends + capital_end / 4)
        out[joint] += share * (begins + capital / 4)
        out[joint, joint] += share * words / 8
        out[joint, digits] += share * words / 80
        out[digits, joint] += share * words / 80
    out[np.ix_(digits, digits)] += words / 400
    out[digits, _EDGE] += words / 80
    out[_EDGE, digits] += words / 80
    return out.ravel()


@dataclass
class SecretModel:
    """Log-likelihood ratio of each transition, in nats; the last state is the edge of a word."""

    ratio: np.ndarray
    least_total: float = 12.0
    least_mean: float = 0.5

    def find(self, words: list[str]) -> np.ndarray:
        """Whether each word's ratio reaches the bounds in total and per transition."""
        if not words:
            return np.zeros(0, bool)
        state = _STATE[np.frombuffer(("\n" + "\n".join(words) + "\n").encode("ascii"), np.uint8)]
        step = self.ratio[state[:-1] * STATES + state[1:]]
        steps = np.array([len(w) + 1 for w in words])
        total = np.add.reduceat(step, np.cumsum(steps) - steps)
        return (total >= self.least_total) & (total >= self.least_mean * steps)


def fit(docs: DataFrame) -> SecretModel | None:
    """Count transitions of labelled secrets and of ordinary words over all documents; None where nothing is labelled.

    A task counts its own cells first, at most ``STATES`` squared of them, so
    neither the shuffle nor the driver's share grows with the texts. Both models
    are smoothed by one count per transition of a uniform alphabet.
    """
    ready(docs.sparkSession)
    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_count, "cell int, secret long, ordinary long")
    rows = counted.groupBy("cell").agg(F.sum("secret").alias("secret"), F.sum("ordinary").alias("ordinary")).collect()
    table = np.zeros((2, STATES * STATES))
    for r in rows:
        table[:, r.cell] = r.secret, r.ordinary
    if not table[0].any():
        return None
    table[1] = identifiers(table[1])
    chance = np.log((table + 1).reshape(2, STATES, STATES) / (table.reshape(2, STATES, STATES).sum(2, keepdims=True) + STATES))
    return SecretModel((chance[0] - chance[1]).ravel())


def scan(docs: DataFrame, model: SecretModel | None) -> DataFrame:
    """Adds ``secrets``, an array of (kind, start, finish) in code points, to every document's id.

    Base spans are as the patterns give them; a ``markov`` span is a word, or what base spans leave of one, of at
    least ``LEAST_WORD`` characters that the model finds. Words and spans are merged in order, so a text with many of both takes linear time. NULL and
    empty texts have none. Rows are scanned each for itself, whole.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # a fixed table of transitions

    def run(batches):
        known = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans = [[s[:3] for s in base_spans(t)] for t in texts]
            where: list[tuple[int, int, int]] = []
            words: list[str] = []
            for row, text in enumerate(texts) if known else ():
                covered = Covered(spans[row])
                for m in _WORD.finditer(text):
                    for begin, end in covered.rests(*m.span()):
                        if end - begin >= LEAST_WORD:
                            where.append((row, begin, end))
                            words.append(text[begin:end])
            for (row, begin, end), secret in zip(where, known.find(words) if known else (), strict=True):
                if secret:
                    spans[row].append(("markov", begin, end))
            out = [[{"kind": k, "start": b, "finish": e} for k, b, e in sorted(s, key=lambda s: (s[1], KINDS.index(s[0])))] for s in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("finish", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "secrets"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, secrets array<struct<kind:string,start:bigint,finish:bigint>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as text."""
    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["finish"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
