"""Token-ID output: Parquet list columns in id order, with controlled encodings, row groups and pages.

Columns of the files: ``doc_id``, ``part`` (number of the writing task, ascending
in doc_id), ``local_start`` (ids before the document within its part),
``n_tokens`` and ``ids``. Ids are dictionary encoded, falling back to delta
packing; ``doc_id`` and ``local_start`` are delta packed by the version-2 writer.
Page indexes let a reader of one id range, or of the metadata columns, skip all else.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailloom.llm.shared import ready
from retailloom.llm.text import slices
from retailloom.llm.vocab import Coded
from retailloom.session import scratch_path

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"
# Row groups of 32 MB, pages of 256 KB or 500 rows; dictionaries may hold a whole vocabulary.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
}
# A task keeps the ids of up to twice this many chunks of at most this length, and takes texts in runs of this many bytes.
_KEPT_CHUNKS = 400_000
_KEPT_LENGTH = 32
_RUN_BYTES = 8 << 20
_JOINED_CHUNKS = 256
_CLOSING = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
_LETTER = np.isin(np.arange(256) | 0x20, np.arange(ord("a"), ord("z") + 1)) & (np.arange(256) >= 0x40) & (np.arange(256) < 0x80)
# Chunks end at blanks and line feeds.
_IN_CHUNK = ~np.isin(np.arange(256), [0x20, 0x0A])
_encoders: dict[str, "ChunkEncoder"] = {}


def _closing(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of closing marks that end a chunk after an ASCII letter: there the tokenizer always begins a new word."""
    where = np.flatnonzero(_CLOSING[data])
    last = np.ones(len(data) + 1, bool)
    last[:-1] = ~_IN_CHUNK[data]
    last[at] = True
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    where = where[last[where + 1] & ~first[where]]
    return where[_LETTER[data[where - 1]]]


class ChunkEncoder:
    """Whole texts encoded chunk by chunk, parted at blanks and line feeds; ids of short chunks are kept, up to a bound.

    The tokenizer drops white space before it looks for words, and no word or
    special token spans a blank or a line feed, so a text's ids are those of its
    chunks one after the other. Every id comes from the library. New chunks of
    letters, or of letters and marks after them, are handed over many at a time,
    joined by blanks: they are one word, or two, and the vocabulary marks where a
    word ends. Of the kept chunks, those not used for long are forgotten first. Texts are
    parted and their chunks looked up as arrays: a chunk is asked for once per run of texts.
    """

    def __init__(self, path: str):
        # Spark's tasks are the parallelism; the library's own threads would only contend for the same cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, fresh: list[str]) -> None:
        words, closed, other = [], [], []
        for chunk in fresh:
            (words if chunk.isalpha() else closed if chunk.rstrip(punctuation).isalpha() else other).append(chunk)
        single = [*other, *self._joined(words, 1), *self._joined(closed, 2)]
        for chunk, found in zip(single, self._encoded(single), strict=True):
            self.recent[chunk] = np.array(found.ids, "<u4").tobytes()

    def _joined(self, chunks: list[str], words: int) -> list[str]:
        """Learns chunks of at least so many words each, many at a time; returns those that must be encoded alone."""
        left: list[str] = []
        groups = [chunks[i : i + _JOINED_CHUNKS] for i in range(0, len(chunks), _JOINED_CHUNKS)]
        for group, found in zip(groups, self._encoded([" ".join(g) for g in groups]), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            if len(ends) == words * len(group):
                raw, ends = ids.tobytes(), ends[words - 1 :: words]
                self.recent.update(zip(group, [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)], strict=True))
            else:  # more words in all: a letter was normalised to several characters
                left += group
        return left

    def _encoded(self, texts: list[str]):
        for first in range(0, len(texts), 100):
            yield from self.tokenizer.encode_batch_fast(texts[first : first + 100], add_special_tokens=False)

    def ids_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different chunks one after the other, and how many each has."""
        if len(self.recent) > _KEPT_CHUNKS:
            self.recent, self.older = {}, self.recent
        rows = list(map(self.recent.get, chunks))
        missing = [i for i, ids in enumerate(rows) if ids is None]
        known = [self.older.get(chunks[i]) for i in missing]
        fresh = [chunks[i] for i, ids in zip(missing, known, strict=True) if ids is None]
        self._learn(fresh)
        for i, ids in zip(missing, known, strict=True):
            if ids is None:
                rows[i] = self.recent[chunks[i]]
            else:
                rows[i] = self.recent[chunks[i]] = ids
        for chunk in fresh:
            if len(chunk) > _KEPT_LENGTH:
                del self.recent[chunk]
        return np.frombuffer(b"".join(rows), "<i4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of whole texts: (first, end, all ids with ``end_id`` after each text, ids of each text)."""
        for first, last, data, at in slices(texts, _RUN_BYTES):
            # The tokenizer lowers letters itself, but knows its special tokens by their case and as a whole.
            special = b"<|" in data.tobytes()
            words = Coded(data, at, _IN_CHUNK, lower=not special, parted=None if special else _closing(data, at))
            flat, sizes = self.ids_of(words.values.to_pylist())
            begin = np.cumsum(sizes) - sizes
            # Each chunk's ids are picked from those of the different ones, with room after it for the end of every text up to the next chunk.
            n = sizes[words.codes]
            per_text = np.bincount(words.row, weights=n, minlength=last - first).astype(np.int64) + 1
            ahead = int(words.row[0]) if len(n) else last - first
            room = n + np.diff(words.row, append=last - first)
            total = int(room.sum())
            picked = np.repeat(begin[words.codes] - np.cumsum(room) + room, room)
            picked += np.arange(total)
            out = np.empty(ahead + total, np.int32)
            np.take(flat, picked, out=out[ahead:], mode="clip")
            out[np.cumsum(per_text) - 1] = end_id
            yield first, last, out, per_text


def _encode(tokenizer: str, end_id: int):
    def run(batches):
        if tokenizer not in _encoders:
            _encoders[tokenizer] = ChunkEncoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, flat, sizes in _encoders[tokenizer].encode(batch.column(1), end_id):
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.full(last - first, part, np.int32)), pa.array(starts), pa.array(sizes.astype(np.int32)), ids],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, partitions: int | None = None) -> None:
    """Encode ``text`` of every document and write one file per range of ``doc_id``.

    NULL and empty texts have the end id only. Rows with equal ids are written in
    order of their text; a NULL ``doc_id`` comes first. Other columns are ignored.
    An empty table gives files without rows. ``partitions`` defaults to the
    session's shuffle partitions: choose it so that a part fits a task.
    """
    spark = ready(docs.sparkSession)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(tokenizer, end_id), FILE_SCHEMA).write.options(**LAYOUT).parquet(path)


def _placed(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds to rows of the files, by ``part``, the ids of all parts before theirs; only the two small columns are read for it."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("base"))
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("local_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of such files, with ``start``, the ids of all documents before each.

    A reader that selects no ``ids`` never touches their pages.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return _placed(files, files).select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def _digest(batches):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        ends = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of such files: its place, length, and the crc32 of its ids as little-endian 32-bit values.

    The ids are reduced where they are read, before anything is shuffled.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    rows = files.select("doc_id", "part", "local_start", "ids").mapInArrow(
        _digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    return _placed(files, rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the documents' ids to the cluster's shared folder and digest what the files hold."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return digest(docs.sparkSession, path)
