"""Token ids in compressed files: range asymmetric numeral systems with static tables.

A file is a folder of Parquet parts whose rows are *segments* of whole documents in
ascending ``doc_id``: at most about ``SEGMENT_IDS`` ids, or one longer document.  A
segment has one frequency table, shared by its blocks.  A block holds ``LANES`` times
``STEPS`` ids (the last one is filled up with its first id), coded alone in interleaved
lanes: id number ``step * LANES + lane`` belongs to ``lane``.  Each lane is a coder with a
64-bit state, kept in [2**31, 2**63), that gives out words of 32 bits; the words of a
block stand in the order in which decoding takes them.

Every block can be decoded alone, and every checkpoint (each ``CHECKPOINT`` steps: the
lanes' states and the place in the words) starts decoding within one.  A crc32 covers the
words and states of each block, another one the ids of the segment.

========== ================================================================
doc_ids    ascending, as the table has them
lengths    ids of each document, its end id included
start      ids before the segment in its part; ``part`` numbers the parts
symbols    the different ids, ascending; ``frequencies`` sum up to 2**20
words      32-bit words of all blocks, ``word_counts`` of each
states     64-bit states at each checkpoint of each block, first at step 0
places     words taken before each checkpoint
block_crcs of each block;  ids_crc: of all ids of the segment
========== ================================================================
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.public_vocabulary import token_ids
from linkloom.llm.segments import released, slices

LANES = 64
STEPS = 1024
CHECKPOINT = 256
SCALE = 20
SEGMENT_IDS = 1 << 20
END_ID = 0
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS = np.uint64(SCALE)
_MASK = np.uint64((1 << SCALE) - 1)

_SCHEMA = (
    "part int, number int, start long, n_ids long, doc_ids array<long>, lengths array<int>,"
    " symbols binary, frequencies binary, words binary, word_counts array<int>, states binary,"
    " places array<int>, block_crcs array<long>, ids_crc long"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("number", pa.int32()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("symbols", pa.binary()),
        ("frequencies", pa.binary()),
        ("words", pa.binary()),
        ("word_counts", pa.list_(pa.int32())),
        ("states", pa.binary()),
        ("places", pa.list_(pa.int32())),
        ("block_crcs", pa.list_(pa.int64())),
        ("ids_crc", pa.int64()),
    ]
)


class DamagedFile(ValueError):
    """A checksum or a length does not fit."""


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum up to 2**SCALE, near the counts' shares."""
    total = 1 << SCALE
    if len(counts) > total:
        raise ValueError(f"more than {total} different ids in a segment")
    free = total - len(counts)
    exact = counts * (free / counts.sum())
    found = np.floor(exact).astype(np.int64)
    most = np.argsort(found - exact, kind="stable")[: free - found.sum()]
    found[most] += 1
    return (found + 1).astype(np.uint32)


def _different(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    most = int(ids.max())
    if most > 1 << 22:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    number = np.zeros(most + 1, np.int64)
    number[symbols] = np.arange(len(symbols))
    return symbols.astype(np.uint32), number[ids], counts[symbols]


def encode(ids: np.ndarray) -> dict:
    """One segment's table and blocks."""
    symbols, index, counts = _different(ids)
    frequencies = quantised(counts)
    below = np.cumsum(frequencies, dtype=np.uint64) - frequencies
    size = LANES * STEPS
    blocks = -(-len(ids) // size)
    filled = np.empty(blocks * size, np.int64)
    filled[: len(ids)] = index
    filled[len(ids) :] = index[(blocks - 1) * size]
    steps = min(STEPS, -(-len(ids) // LANES)) if blocks == 1 else STEPS
    lanes = np.ascontiguousarray(filled.reshape(blocks, STEPS, LANES)[:, :steps].transpose(1, 0, 2))
    frequency = frequencies.astype(np.uint64)
    state = np.full((blocks, LANES), _LOW)
    gave = np.empty((steps, blocks, LANES), bool)
    word = np.empty((steps, blocks, LANES), np.uint32)
    marks = range(0, steps, CHECKPOINT)
    states = np.empty((blocks, len(marks), LANES), np.uint64)
    limit, one = _WORD + np.uint64(31) - _BITS, np.uint64(1)
    for step in range(steps - 1, -1, -1):
        f = frequency.take(lanes[step])
        full = np.greater_equal(state, f << limit, out=gave[step])
        word[step] = state
        np.right_shift(state, _WORD, out=state, where=full)
        high = state // f
        state += below.take(lanes[step])
        high *= (one << _BITS) - f
        state += high  # high << SCALE, plus the rest of the division, plus below
        if step % CHECKPOINT == 0:
            states[:, step // CHECKPOINT] = state
    taken = gave.transpose(1, 0, 2)
    per_step = taken.sum(2)
    before = np.cumsum(per_step, 1) - per_step
    word_counts = per_step.sum(1)
    words = word.transpose(1, 0, 2)[taken]
    ends = np.cumsum(word_counts)
    crcs = [
        zlib.crc32(states[b].tobytes(), zlib.crc32(words[ends[b] - word_counts[b] : ends[b]].tobytes()))
        for b in range(blocks)
    ]
    return {
        "symbols": zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes(), 1),
        "frequencies": zlib.compress(frequencies.astype("<u4").tobytes(), 1),
        "words": words.astype("<u4").tobytes(),
        "word_counts": word_counts.tolist(),
        "states": states.astype("<u8").tobytes(),
        "places": before[:, :: CHECKPOINT].ravel().tolist(),
        "block_crcs": crcs,
        "ids_crc": zlib.crc32(ids.astype("<u4").tobytes()),
        "n_ids": len(ids),
    }


def _table(segment: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    symbols = np.cumsum(np.frombuffer(zlib.decompress(segment["symbols"]), "<u4"), dtype=np.uint32)
    frequencies = np.frombuffer(zlib.decompress(segment["frequencies"]), "<u4")
    if frequencies.sum() != 1 << SCALE or len(symbols) != len(frequencies):
        raise DamagedFile("frequency table")
    below = np.cumsum(frequencies, dtype=np.uint64) - frequencies
    return symbols, frequencies.astype(np.uint64), below, np.repeat(np.arange(len(symbols), dtype=np.uint16 if len(symbols) <= 1 << 16 else np.uint32), frequencies)


def decode(segment: dict, blocks: list[int] | None = None, first_step: int = 0) -> np.ndarray:
    """The ids of a segment, or of some of its blocks from a checkpoint's step on."""
    n_blocks = len(segment["word_counts"])
    chosen = np.arange(n_blocks) if blocks is None else np.array(blocks)
    steps = min(STEPS, -(-segment["n_ids"] // LANES)) if n_blocks == 1 else STEPS
    marks = -(-steps // CHECKPOINT)
    words = np.frombuffer(segment["words"], "<u4")
    counts = np.array(segment["word_counts"], np.int64)
    ends = np.cumsum(counts)
    states = np.frombuffer(segment["states"], "<u8").reshape(n_blocks, marks, LANES)
    if len(words) != ends[-1]:
        raise DamagedFile("words")
    for b in chosen.tolist():
        own = zlib.crc32(words[ends[b] - counts[b] : ends[b]].tobytes())
        if zlib.crc32(states[b].tobytes(), own) != segment["block_crcs"][b]:
            raise DamagedFile(f"block {b}")
    symbols, frequency, below, slot = _table(segment)
    mark = first_step // CHECKPOINT
    first_step = mark * CHECKPOINT
    state = np.array(states[chosen, mark], np.uint64)
    at = (ends - counts)[chosen] + np.array(segment["places"]).reshape(n_blocks, marks)[chosen, mark]
    index = np.empty((steps - first_step, len(chosen), LANES), slot.dtype)
    for step in range(steps - first_step):
        low = state & _MASK
        found = slot.take(low.view(np.int64))
        index[step] = found
        state >>= _BITS
        state *= frequency.take(found)
        state += low
        state -= below.take(found)
        row, lane = np.nonzero(state < _LOW)  # in the order of the words
        taken = np.bincount(row, minlength=len(chosen))
        first = at - (np.cumsum(taken) - taken)
        state[row, lane] = (state[row, lane] << _WORD) | words[first[row] + np.arange(len(row))]
        at = at + taken
    ids = symbols[index.transpose(1, 0, 2).reshape(-1)]
    if blocks is not None or first_step:
        return ids
    ids = ids[: segment["n_ids"]]
    if zlib.crc32(ids.astype("<u4").tobytes()) != segment["ids_crc"]:
        raise DamagedFile("ids")
    return ids


def _segment_rows(part: int, documents: Iterator[tuple[list, np.ndarray, np.ndarray]]) -> Iterator[dict]:
    """Whole documents to segments; ``documents`` gives doc_ids, flat ids, counts."""
    names, ids, lengths = [], [], []
    pending = start = number = 0

    def row() -> dict:
        flat = np.concatenate(ids)
        return {"part": part, "number": number, "start": start, "doc_ids": names, "lengths": lengths} | encode(flat)

    for doc_ids, flat, counts in documents:
        ends = np.cumsum(counts)
        for doc_id, end, count in zip(doc_ids, ends.tolist(), counts.tolist(), strict=True):
            if pending and pending + count > SEGMENT_IDS:
                yield row()
                start, number = start + pending, number + 1
                names, ids, lengths, pending = [], [], [], 0
            names.append(doc_id)
            ids.append(flat[end - count : end])
            lengths.append(count)
            pending += count
        ids = [np.concatenate(ids)]  # lets go of the slice
    if pending:
        yield row()


def write_token_files(documents: DataFrame, path: str, vocabulary: str) -> None:
    """Encode ``text`` of every document and write the ids in ascending ``doc_id``.

    A NULL text is an empty one: its end id alone.  A NULL ``doc_id`` comes first; rows
    that repeat a ``doc_id`` all stay.  An empty table gives files without a segment.
    Other columns are not read.
    """
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select("doc_id", "text").repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store = token_ids(vocabulary)

        def encoded() -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
            for piece in slices(batches):
                flat, counts = store.ids(piece.column("text"), END_ID)
                yield piece.column("doc_id").to_pylist(), flat, counts

        for row in _segment_rows(TaskContext.get().partitionId(), encoded()):
            yield pa.RecordBatch.from_pylist([row], _ARROW)

    (
        ordered.mapInArrow(released(rows, token_ids), _SCHEMA)
        .write.option("compression", "uncompressed")
        .option("parquet.page.size.row.check.min", 1)
        .option("parquet.block.size.row.check.min", 1)
        .option("parquet.block.size", 16 << 20)
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id``, ``start``, ``n_tokens`` and its ``ids`` as little-endian bytes.

    ``start`` counts the ids of all documents before it in the files.
    """
    return _documents(spark, path, with_ids=True)


def token_file_index(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_token_files``, with ``ids_crc32`` instead of the ids; all blocks are decoded."""
    return _documents(spark, path, with_ids=False)


def _documents(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    # A document can be larger than what Parquet's reader would take in many rows at once.
    stored = spark.read.schema(_SCHEMA).parquet(path)
    sizes = stored.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).collect()
    before, total = {}, 0
    for part, n_ids in sorted((r["part"], r["n_ids"]) for r in sizes):  # one row for each part
        before[part], total = total, total + n_ids
    value = ("ids", pa.binary()) if with_ids else ("ids_crc32", pa.int64())
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), value])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                segment = batch.slice(number, 1).to_pylist()[0]
                ids = decode(segment).astype("<u4", copy=False)
                lengths = np.array(segment["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment["doc_ids"], pa.int64()),
                        pa.array(before[segment["part"]] + segment["start"] + ends - lengths),
                        pa.array(lengths),
                        pa.array([bytes(x) if with_ids else zlib.crc32(x) for x in each], value[1]),
                    ],
                    schema=fields,
                )

    kind = "ids binary" if with_ids else "ids_crc32 long"
    return stored.mapInArrow(rows, f"doc_id long, start long, n_tokens long, {kind}")
