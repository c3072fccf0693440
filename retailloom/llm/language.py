"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams of its letters, weighted by square
root of frequency and inverse document frequency, and scaled to length one. Each
language has a few centroids from spherical k-means. The nearest centroid by
cosine names the language; a text too far from every centroid is rejected. How far
is too far follows from learned documents of that language and pieces of them, of
about as many trigrams, held against centroids that were learnt without them.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailloom.llm.shared import held_out, ready
from retailloom.llm.text import slices

DIMS = 1 << 14
BLOCK = 128  # rows of trigram counts at a time
LENGTHS = 16  # powers of two of a text's number of different trigrams
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint8)
    for b in range(256):
        if b >= 0x80:
            table[b] = b
        elif chr(b).isalpha():
            table[b] = b | 0x20
    return table


_LETTERS = _letters()


def _slot(a, b, c):
    return (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA6B) + c * np.uint32(0xC2B2AE35)) >> np.uint32(18)


def trigram_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams, a row per text; texts are padded by blanks, so none is too short."""
    rows = len(at) - 1
    counts = np.zeros((rows, DIMS), np.float32)
    for low in range(0, rows, BLOCK):
        high = min(rows, low + BLOCK)
        sizes = np.diff(at[low : high + 1])
        begins = np.cumsum(sizes + 2) - (sizes + 2)
        padded = np.full(int((sizes + 2).sum()) + 2, 0x20, np.uint8)
        place = np.arange(at[high] - at[low]) + np.repeat(begins + 1 - (at[low:high] - at[low]), sizes)
        padded[place] = _LETTERS[data[at[low] : at[high]]]
        wide = padded.astype(np.uint32)
        slot = _slot(wide[:-2], wide[1:-1], wide[2:]).astype(np.int64)
        slot += np.repeat(np.arange(high - low) * DIMS, sizes + 2)
        counts[low:high] = np.bincount(slot, minlength=(high - low) * DIMS).reshape(high - low, DIMS)
    blank = np.full(1, 0x20, np.uint32)
    counts[:, int(_slot(blank, blank, blank)[0])] = 0
    return counts


def blocks(column: pa.Array):
    """(first row, end row, trigram counts) of a text column, few rows at a time, so that counts stay small."""
    for first, end, data, at in slices(column):
        for low in range(0, end - first, BLOCK):
            high = min(end - first, low + BLOCK)
            yield first + low, first + high, trigram_counts(data[at[low] : at[high]], at[low : high + 1] - at[low])


def lengths(counts: np.ndarray) -> np.ndarray:
    """The power of two at or below each row's number of different trigrams: a word repeated for long is as short as the word."""
    return np.frexp(np.maximum((counts > 0).sum(1), 1).astype(np.float64))[1] - 1


@dataclass
class LanguageModel:
    """Weights, centroids, the language of each centroid, and the cosine below which a text of some length is rejected, a row per language."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    languages: list[str]
    reject_below: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.sqrt(counts)
        weighted *= self.idf
        weighted /= np.maximum(np.sqrt((weighted * weighted).sum(1, keepdims=True)), 1e-12)
        return weighted

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, cosine, rejected) of each row; ties go to the first centroid."""
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(np.float64), 0, 1)
        number = self.owner[best]
        return number, score, (score <= 0) | (score < self.reject_below[number, lengths(counts)])


def _pieces(text: bytes) -> list[bytes]:
    """A text, and of each length of 1.25 times a power of two below its own one piece of it."""
    out, size = [text], 5
    while size < len(text):
        begin = zlib.crc32(text, size) % (len(text) - size + 1)
        while begin < len(text) and 0x80 <= text[begin] < 0xC0:  # not inside a letter
            begin += 1
        out.append(text[begin : begin + size])
        size *= 2
    return out


def _sample_counts(batches):
    """Trigram counts of each text, then of its pieces, as the slots that are not 0 and their counts, packed."""
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            pieces = []
            for _, _, counts in blocks(pa.array(_pieces(text.as_buffer().to_pybytes()), pa.binary())):
                pieces += [(row[row > 0].astype("<f4").tobytes(), np.flatnonzero(row > 0).astype("<u2").tobytes()) for row in counts]
            yield pa.RecordBatch.from_arrays([pa.array([_packed(pieces)], pa.binary()), pa.array([lang.as_py()], pa.string())], ["pieces", "lang"])


def _packed(pieces: list[tuple[bytes, bytes]]) -> bytes:
    """(counts, slots) of a text and its pieces as few bytes, since those of a sample meet in the driver."""
    return zlib.compress(b"".join([np.array([len(pieces), *(len(s) // 2 for _, s in pieces)], "<u4").tobytes(), *(c for c, _ in pieces), *(s for _, s in pieces)]), 1)


def _unpacked(packed: bytes) -> list[tuple[bytes, bytes]]:
    raw = zlib.decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    sizes = np.frombuffer(raw, "<u4", n, 4).astype(np.int64)
    at, out = 4 * (n + 1) + np.concatenate([[0], np.cumsum(4 * sizes)]), []
    after = int(at[-1]) + np.concatenate([[0], np.cumsum(2 * sizes)])
    for k in range(n):
        out.append((raw[at[k] : at[k + 1]], raw[after[k] : after[k + 1]]))
    return out


def _dense(sparse: list[tuple[bytes, bytes]]) -> np.ndarray:
    counts = np.zeros((len(sparse), DIMS), np.float32)
    for row, (c, s) in zip(counts, sparse, strict=True):
        row[np.frombuffer(s, "<u2")] = np.frombuffer(c, "<f4")
    return counts


def _sample_vectors(model: LanguageModel, sparse: list[tuple[bytes, bytes]]) -> np.ndarray:
    """The vectors of a sample, a block of dense counts at a time, so that the driver holds one such table of it."""
    out = np.zeros((len(sparse), DIMS), np.float32)
    for low in range(0, len(sparse), BLOCK):
        out[low : low + BLOCK] = model.vectors(_dense(sparse[low : low + BLOCK]))
    return out


def _centres(own: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """Spherical k-means from members drawn with a fixed seed."""
    centres = own[np.random.default_rng(7).permutation(len(own))[: min(centroids, len(own))]]
    for _ in range(rounds):
        nearest = (own @ centres.T).argmax(1)
        sums = np.stack([own[nearest == k].sum(0) if (nearest == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _bounds(size: np.ndarray, cosine: np.ndarray, lost: float, slack: float, least: int = 20) -> np.ndarray:
    """The bound at each length; a length of too few texts has that of the next shorter one, 0 if there is none."""
    out = np.zeros(LENGTHS)
    for n in range(LENGTHS):
        here = cosine[size == n]
        out[n] = slack * float(np.quantile(here, lost, method="lower")) if len(here) >= least else out[n - 1] if n else 0.0
    return out


def fit(docs: DataFrame, per_language: int = 400, centroids: int = 4, rounds: int = 12, lost: float = 0.005, slack: float = 0.5,
        max_languages: int = 500) -> LanguageModel | None:
    """Learn from a sample of the labelled documents outside the held-out fold.

    About ``per_language`` documents of each language are chosen by a hash of their
    id, never more than twice that; only their trigram counts reach the driver.
    A language's rejection bound at a length is ``slack`` times the cosine that all
    but ``lost`` of its sample's texts and pieces of that length reach, each half of
    the sample held against centroids of the other half. A length of which the sample
    has fewer than 20 is judged as the next shorter one.
    More than ``max_languages`` labels are an error. None if nothing is labelled.
    """
    spark = ready(docs.sparkSession)
    usable = docs.where("lang is not null and text is not null").where(~held_out())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages are labelled; none is left out, so allow for more by max_languages")
    if not sizes:
        return None
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))]), F.col("lang"))
    chosen = usable.where(F.col("lang").isin(list(sizes))).where(place < share).select("text", "lang")
    table = chosen.mapInArrow(_sample_counts, "pieces binary, lang string").limit(2 * per_language * len(sizes)).toArrow()
    samples: dict[str, list[bytes]] = {}
    for packed, lang in zip(*(table.column(n).to_pylist() for n in ("pieces", "lang")), strict=True):
        samples.setdefault(lang, []).append(packed)
    del table
    if not samples:
        return None
    held = np.zeros(DIMS, np.int64)
    for own in samples.values():
        for packed in own:
            held[np.frombuffer(_unpacked(packed)[0][1], "<u2")] += 1
    idf = np.log((1 + sum(map(len, samples.values()))) / (1 + held)).astype(np.float32) + np.float32(0.1)
    model = LanguageModel(idf, np.zeros((0, DIMS), np.float32), np.zeros(0, np.int64), sorted(samples), np.zeros(0))
    found, owner, bounds = [], [], []
    for number, language in enumerate(model.languages):
        own = sorted(map(_unpacked, samples.pop(language)))
        vectors = _sample_vectors(model, [pieces[0] for pieces in own])
        found.append(_centres(vectors, centroids, rounds))
        owner += [number] * len(found[-1])
        # Copies are in one half, as it follows from what they hold.
        half = np.array([zlib.crc32(b"".join(pieces[0])) % 2 for pieces in own])
        size, cosine = [], []
        for k in (0, 1):
            if 0 < (half == k).sum() < len(own):
                others = _centres(vectors[half != k], centroids, rounds)
                for pieces in (p for p, h in zip(own, half, strict=True) if h == k):
                    counts = _dense(pieces)
                    size.append(lengths(counts))
                    cosine.append((model.vectors(counts) @ others.T).max(1))
        bounds.append(_bounds(np.concatenate(size), np.concatenate(cosine), lost, slack) if size else np.zeros(LENGTHS))
    model.centroids, model.owner, model.reject_below = np.concatenate(found).astype(np.float32), np.array(owner), np.stack(bounds)
    return model


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``rejected`` to every document, from its whole ``text`` alone.

    ``und``, score 0 and rejected for a NULL text or one without a letter, and for
    every text if there is no model. Columns of those names are replaced.
    """
    spark = ready(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    shared = spark.sparkContext.broadcast(model)  # at most a few hundred languages' centroids
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    text, at_letter = kept.index("text"), len(kept)

    def run(batches):
        known = shared.value
        for batch in batches:
            number, score, rejected = (np.zeros(batch.num_rows, t) for t in (np.int64, np.float64, bool))
            for first, end, counts in blocks(batch.column(text)) if known else ():
                number[first:end], score[first:end], rejected[first:end] = known.nearest(counts)
            letter = batch.column(at_letter).to_numpy(zero_copy_only=False) & (known is not None)
            names = np.array([*(known.languages if known else []), UNDETERMINED], object)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at_letter], pa.array(names[np.where(letter, number, len(names) - 1)], pa.string()),
                 pa.array(np.where(letter, score, 0.0)), pa.array(rejected | ~letter)], [*kept, "lang_pred", "score", "rejected"])

    letters = docs.select(*kept, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    return letters.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
