"""Texts cut into short segments that a tokenizer treats alone, and their ids.

Both word pieces and byte pieces never reach across the start of white space that follows
something else.  Texts are cut there (and between an ASCII letter and punctuation), so
that each different segment is encoded once and then found by hash.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
#: Beyond so many segments a worker keeps the ids of those only that came in two slices.
CACHED_SEGMENTS = 700_000

_byte = np.arange(256)
_LETTER = ((_byte | 32) >= 97) & ((_byte | 32) <= 122)
_PUNCTUATION = (_byte > 32) & (_byte < 127) & ~_LETTER & ~((_byte >= 48) & (_byte <= 57))
_PUNCTUATION[ord("'")] = False
_BLANK = (_byte == 32) | (_byte == 10)
_VISIBLE = (_byte > 32) & (_byte < 127)
_CONTINUES = (_byte >= 0x80) & (_byte < 0xC0)
#: Characters of two bytes that start so are never white space.
_LEADS_TWO = (_byte >= 0xC3) & (_byte < 0xE0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins; NULL is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of text, or of one longer text."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def released(rows: Callable, *caches) -> Callable:
    """``rows`` for ``mapInArrow`` that empties the worker's ``caches`` when its task ends.

    An idle worker then holds no store of an earlier stage while another stage runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            for cache in caches:
                cache.cache_clear()
            gc.collect()

    return run


def _special_places(data: np.ndarray, offsets: np.ndarray, specials: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Where the ``specials`` stand in the texts: leftmost, longest first, never across two texts."""
    if not specials or not len(data):
        return []
    pattern = re.compile(b"|".join(re.escape(x) for x in sorted(specials, key=len, reverse=True)))
    found = []
    for match in pattern.finditer(data.tobytes()):
        start, end = match.span()
        if np.searchsorted(offsets, start, "right") == np.searchsorted(offsets, end - 1, "right"):
            found.append((start, end))
    return found


def segments(texts: pa.Array, specials: tuple[bytes, ...] = ()) -> tuple[pa.Array, np.ndarray]:
    """All segments of all texts, and how many each text has.

    Each occurrence of one of ``specials`` in a text is a segment of its own, as the
    tokenizers library splits texts at its special tokens before anything else.
    """
    data, offsets = text_bytes(texts)
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        now, last = data[1:], data[:-1]
        solid = _VISIBLE[last]
        solid[1:] |= _CONTINUES[last[1:]] & _LEADS_TWO[last[:-1]]
        cut[1:] = (_BLANK[now] & solid) | (_PUNCTUATION[now] & _LETTER[last])
    for start, end in _special_places(data, offsets, specials):
        cut[start + 1 : end] = False
        cut[start] = True
        if end < len(data):
            cut[end] = True
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts, len(data)).astype(np.int64)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )
    return found, np.diff(np.searchsorted(starts, offsets))


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[start : start + length]`` of each pair, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    index = np.arange(ends[-1])
    index += np.repeat(starts - (ends - lengths), lengths)
    return flat[index]


class SegmentIds:
    """The ids of texts.

    ``encode`` takes different segments and returns the order in which it dealt with
    them, the ids in that order, and how many each segment has.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self._encode = encode
        self._specials = tuple(getattr(encode, "specials", ()))
        self._keep([], np.empty(0, np.int64))

    def _keep(self, segments: list[bytes], places: np.ndarray) -> None:
        self._place: dict[bytes, int] = dict(zip(segments, range(len(segments)), strict=True))
        if len(segments):
            counts = self.counts[places]
            self.flat = gather(self.flat, self.starts[places], counts)
            self.counts, self.starts = counts, np.cumsum(counts) - counts
        else:
            self.flat = np.zeros(0, np.uint32)
            self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._seen = np.zeros(len(segments), np.uint8)

    def _shrink(self) -> None:
        often = self._seen >= 2
        if often.sum() > CACHED_SEGMENTS // 2:
            often[:] = False
        kept = [(s, p) for s, p in self._place.items() if often[p]]
        self._keep([s for s, _ in kept], np.array([p for _, p in kept], np.int64))

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each segment its place in this store; segments of each text.

        Places hold until the next call.
        """
        if len(self._place) > CACHED_SEGMENTS:
            self._shrink()
        found, per_text = segments(texts, self._specials)
        coded = found.dictionary_encode()
        different = coded.dictionary.to_pylist()
        get = self._place.get
        places = np.array([get(s, -1) for s in different], np.int64)
        new = np.flatnonzero(places < 0)
        if len(new):
            missing = [different[i] for i in new.tolist()]
            order, flat, counts = self._encode(missing)
            first = len(self.starts)
            places[new[order]] = np.arange(first, first + len(new))
            self._place.update(zip([missing[i] for i in order.tolist()], range(first, first + len(new)), strict=True))
            starts = len(self.flat) + np.cumsum(counts) - counts
            self.flat = np.concatenate([self.flat, flat.astype(np.uint32, copy=False)])
            self.starts = np.concatenate([self.starts, starts])
            self.counts = np.concatenate([self.counts, counts])
            self._seen = np.concatenate([self._seen, np.zeros(len(new), np.uint8)])
        self._seen[places] = np.minimum(self._seen[places], 254) + 1
        return places[coded.indices.to_numpy()], per_text

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each has; ``end`` follows each text."""
        places, per_text = self.places(texts)
        counts = self.counts[places]
        total = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        per_text_ids = np.diff(total[bounds])
        flat = gather(self.flat, self.starts[places], counts)
        if end is None:
            return flat, per_text_ids
        stops = np.cumsum(per_text_ids)
        return np.insert(flat, stops, np.uint32(end)), per_text_ids + 1
