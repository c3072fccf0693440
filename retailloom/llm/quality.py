"""Quality classifier: averaged embeddings of hashed word and character n-grams, softmax output.

Features of a text: its words, pairs of neighbouring words, and its 3- and 5-byte
strings. The pair's hash is the difference of its words' hashes, so all repeated
words share one feature. Embeddings and output weights are learned together by
stochastic gradient descent.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import held_out, ready
from retailloom.llm.text import SPACED_WORDS, U64, Words, mix, salt, slices

BUCKETS = 1 << 14
_SHIFT = U64(50)  # the top 14 bits


def features(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) arrays of each kind of feature; rows ascend within a kind."""
    out, sizes = [], np.diff(at)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    wide = data.astype(np.uint32)
    for width in (3, 5):
        n = len(wide) - width + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint32)
        for j in range(width):
            code *= np.uint32(0x01000193)
            code += wide[j : j + n]
        code *= np.uint32(0x9E3779B1)
        whole = rows[:n] == rows[width - 1 :]
        out.append((rows[:n][whole], (code >> np.uint32(18)).astype(np.int64)[whole]))
    words = Words(data, at, SPACED_WORDS)
    with np.errstate(over="ignore"):
        out.append((words.row, (mix(words.hash ^ salt(1)) >> _SHIFT).astype(np.int64)))
        pair = words.row[1:] == words.row[:-1]
        out.append((words.row[1:][pair], (mix(words.hash[1:] - words.hash[:-1]) >> _SHIFT).astype(np.int64)[pair]))
    return out


@dataclass
class QualityModel:
    """What each bucket adds to the log-odds of label 1 (embeddings times output weights), and the intercept."""

    gain: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        rows = len(at) - 1
        total, count = np.zeros(rows), np.zeros(rows)
        for row, bucket in features(data, at):
            total += np.bincount(row, self.gain[bucket], rows)
            count += np.bincount(row, minlength=rows)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.intercept)))


def _sample_features(batches):
    for batch in batches:
        for first, end, data, at in slices(batch.column(0)):
            rows = end - first
            buckets, counts = [], []
            found = features(data, at)
            row, bucket = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            key, n = np.unique(row * BUCKETS + bucket, return_counts=True)
            ends = np.searchsorted(key, np.arange(rows + 1) * BUCKETS)
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                buckets.append((key[a:b] % BUCKETS).astype("<u2").tobytes())
                counts.append((n[a:b] / max(1, n[a:b].sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.binary()), pa.array(counts, pa.binary()), batch.column(1).slice(first, rows)],
                ["buckets", "weights", "label"])


def _train(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, steps: int, rate: float) -> QualityModel:
    rng = np.random.default_rng(11)
    embed = rng.normal(0, 0.1, (BUCKETS, width)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (width, 2)).astype(np.float32), np.zeros(2, np.float32)
    size, done = 64, 0
    squares = [np.full(BUCKETS, 1e-8, np.float32), np.float32(1e-8)]
    block = np.zeros((size, BUCKETS), np.float32)
    while done < steps:
        order = rng.permutation(len(y))
        for low in range(0, len(y), size)[: steps - done]:
            rows = order[low : low + size]
            part = block[: len(rows)]
            part[:] = 0
            for i, r in enumerate(rows):
                part[i, x[r][0]] = x[r][1]
            hidden = part @ embed
            logits = hidden @ out + bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            pace = rate * (1 - done / steps)
            grad_embed, grad_out = part.T @ (p @ out.T), hidden.T @ p
            # Steps are scaled by each row's past gradients, as buckets differ widely in how often they occur.
            squares[0] += (grad_embed * grad_embed).mean(1)
            squares[1] += float((grad_out * grad_out).mean())
            embed -= pace * grad_embed / np.sqrt(squares[0])[:, None]
            out -= pace * grad_out / np.sqrt(squares[1])
            bias -= pace * p.sum(0)
            done += 1
    return QualityModel((embed @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 6000, width: int = 8, steps: int = 800, rate: float = 1.0) -> QualityModel:
    """Learn ``label`` from at most ``sample`` labelled documents outside the held-out fold, chosen by a hash of their id.

    Documents and labels meet on ``doc_id``; repeated label rows count as often as
    they stand. Only the sample's hashed features reach the driver. Without any
    labelled document every score is one half.
    """
    spark = ready(docs.sparkSession)
    chosen = (
        labels.where(F.col(label).isin(0, 1)).where("doc_id is not null").where(~held_out())
        .select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    table = joined.select("text", "label").mapInArrow(_sample_features, "buckets binary, weights binary, label int").limit(2 * sample).toArrow()
    rows = sorted(zip(table.column("buckets").to_pylist(), table.column("weights").to_pylist(), table.column("label").to_pylist(), strict=True))
    if not rows:
        return QualityModel(np.zeros(BUCKETS), 0.0)
    x = [(np.frombuffer(b, "<u2").astype(np.int64), np.frombuffer(w, "<f4")) for b, w, _ in rows]
    return _train(x, np.array([r[2] for r in rows]), width, steps, rate)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole ``text`` alone.

    NULL and empty texts have no feature and get the score of the intercept.
    Repeated rows are scored each; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # one number per bucket

    def run(batches):
        known = shared.value
        for batch in batches:
            result = np.zeros(batch.num_rows)
            for first, end, data, at in slices(batch.column(2)):
                result[first:end] = known.scores(data, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(result), pa.array((result >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
