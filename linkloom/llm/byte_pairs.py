"""Byte-level BPE by ranks, with a hierarchical-bitmap rank queue.

A pre-token starts as single bytes in a linked list.  Every neighbouring pair whose bytes
together have a rank lies in the bucket of that rank.  Two levels of bitmaps tell which
buckets hold something; finding the first set bit gives the lowest rank.  The leftmost
pair of that bucket is merged, which adds at most two pairs; entries of pairs that are
gone stay in their buckets and are skipped when they come up.  A pre-token of n bytes
takes O(n log n) steps, however long it is.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from linkloom.llm.segments import SegmentIds, gather, slices

_WIDTH = 8
_LOW = (1 << _WIDTH) - 1
_COUNT = list(range(64))
_BEFORE = list(range(-1, 63))


def load_ranks(path: str) -> dict[bytes, int]:
    """``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """For each two tokens that make up a third: ``first << 32 | second`` to the third."""
    found = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            first, second = ranks.get(token[:i]), ranks.get(token[i:])
            if first is not None and second is not None:
                found[first << 32 | second] = rank
    return found


def merge(word: bytes, single: list[int], pairs: dict[int, int]) -> list[int]:
    """The ids of one pre-token: always the pair of lowest rank is merged, the leftmost first.

    ``single`` has the id of each byte, ``pairs`` is from ``pair_ranks``.
    """
    ids = [single[x] for x in word]
    n = len(ids)
    pair = [pairs.get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
    pair.append(-1)  # the rank of the pair that begins here
    after = _COUNT[1 : n + 1] if n < len(_COUNT) else list(range(1, n + 1))
    before = _BEFORE[:n] if n < len(_COUNT) else list(range(-1, n - 1))
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top = 0
    for i, rank in enumerate(pair):
        if rank >= 0:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                high = rank >> _WIDTH
                leaves[high] = leaves.get(high, 0) | 1 << (rank & _LOW)
                top |= 1 << high
    get = pairs.get
    while top:
        high = (top & -top).bit_length() - 1
        leaf = leaves[high]
        low = leaf & -leaf
        rank = high << _WIDTH | low.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            here = heappop(bucket)
        else:
            here = bucket[0]
            del buckets[rank]
            leaves[high] = leaf = leaf ^ low
            if not leaf:
                top &= top - 1
        if pair[here] != rank:
            continue  # stale: merged away, or a longer part begins here now
        gone = after[here]
        following = after[gone]
        ids[here] = rank
        ids[gone] = pair[gone] = pair[here] = -1
        after[here] = following
        previous = before[here]
        if following < n:
            before[following] = here
            found = get(rank << 32 | ids[following], -1)
            if found >= 0:
                pair[here] = found
                if found in buckets:
                    heappush(buckets[found], here)
                else:
                    buckets[found] = [here]
                    high = found >> _WIDTH
                    leaves[high] = leaves.get(high, 0) | 1 << (found & _LOW)
                    top |= 1 << high
        if previous >= 0:
            pair[previous] = found = get(ids[previous] << 32 | rank, -1)
            if found >= 0:
                if found in buckets:
                    heappush(buckets[found], previous)
                else:
                    buckets[found] = [previous]
                    high = found >> _WIDTH
                    leaves[high] = leaves.get(high, 0) | 1 << (found & _LOW)
                    top |= 1 << high
    return [x for x in ids if x >= 0]


class Vocabulary:
    """Encodes and decodes texts by the ranks of one file."""

    def __init__(self, path: str, pattern: str):
        import regex

        self._ranks = load_ranks(path)
        self._single = [self._ranks[bytes([x])] for x in range(256)]
        self._pairs = pair_ranks(self._ranks)
        self._find = regex.compile(pattern).findall
        tokens = sorted(self._ranks.items(), key=lambda x: x[1])
        lengths = np.zeros(tokens[-1][1] + 1, np.int64)
        lengths[[rank for _, rank in tokens]] = [len(token) for token, _ in tokens]
        self._lengths = lengths
        self._starts = np.cumsum(lengths) - lengths
        self._bytes = np.frombuffer(b"".join(token for token, _ in tokens), np.uint8)
        decimals = [b"%d " % number for number in range(len(lengths))]
        self._decimal_lengths = np.array([len(x) for x in decimals], np.int64)
        self._decimal_starts = np.cumsum(self._decimal_lengths) - self._decimal_lengths
        self._decimals = np.frombuffer(b"".join(decimals), np.uint8)
        self._store = SegmentIds(self._encode)

    def _encode(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids: list[int] = []
        ends = np.empty(len(segments), np.int64)
        ranks, single, pairs = self._ranks, self._single, self._pairs
        for number, segment in enumerate(segments):
            for word in self._find(segment.decode("utf-8", "replace")):
                token = word.encode()
                whole = ranks.get(token)
                if whole is None:
                    ids += merge(token, single, pairs)
                else:
                    ids.append(whole)
            ends[number] = len(ids)
        return np.arange(len(segments)), np.array(ids, np.uint32), np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each has."""
        return self._store.ids(texts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat bytes of all texts, and how many each has."""
        return _pieces(self._bytes, self._starts, self._lengths, ids, counts)

    def decimals(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts as decimal numbers, each with a space behind it."""
        return _pieces(self._decimals, self._decimal_starts, self._decimal_lengths, ids, counts)


def _pieces(flat, starts, lengths, ids, counts) -> tuple[np.ndarray, np.ndarray]:
    each = lengths[ids]
    total = np.concatenate([[0], np.cumsum(each)])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return gather(flat, starts[ids], each), np.diff(total[bounds])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each file and worker."""
    return Vocabulary(path, pattern)


def encode_texts(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ``ids`` of every ``text`` (NULL: none); one row for each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for piece in slices(batches):
            ids, counts = words.encode(piece.column("text"))
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], ["doc_id", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the bytes that ``ids`` stand for, as ``content``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            column = batch.column("ids")
            counts = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            data, sizes = words.decode(column.flatten().to_numpy(), counts.astype(np.int64))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "content"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, content binary")


def _digests(data: np.ndarray, sizes: np.ndarray, last: int = 0) -> pa.Array:
    """The sha256 of each part without its ``last`` bytes."""
    raw = memoryview(data)
    ends = np.cumsum(sizes)
    spans = zip((ends - sizes).tolist(), np.maximum(ends - last, ends - sizes).tolist(), strict=True)
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in spans], pa.string())


def round_trip_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes and decodes every ``text`` in one pass.

    ``ids_sha256`` is of the decimal ids with one space between them, ``decoded_sha256``
    of the decoded bytes.  A NULL or empty text has no ids, and both digests are of the
    empty string.  Repeated rows each give a row; other columns are not read.
    """
    fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for piece in slices(batches):
            ids, counts = words.encode(piece.column("text"))
            numbers = _digests(*words.decimals(ids, counts), last=1)
            texts = _digests(*words.decode(ids, counts))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts), numbers, texts], fields)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)
