"""Ids by the tokenizers library, from a vocabulary file that every executor has."""

from __future__ import annotations

import functools
import os

import numpy as np

from linkloom.llm.segments import SegmentIds

#: Segments that go through the library as one text.
_JOINED = 2000


def _joins(segment: bytes) -> bool:
    """Whether it can follow, and be followed by, others of its kind without a change."""
    last = segment[-1]
    letter = 0x20 < last < 0x7F or (len(segment) > 2 and 0xC3 <= segment[-2] < 0xE0)
    return segment[0] in b" \n" and letter


class _Library:
    """Encodes many segments as a few texts; where a segment ends is read off offsets."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        #: Special tokens in a text get their ids, as by the library's default.
        self.specials = tuple(t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values() if t.special)
        kept = self._tokenizer.normalizer is None
        self._lengths = None
        if kept:  # each character of a byte-level token stands for one byte
            vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
            self._lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
            for token, number in vocabulary.items():
                self._lengths[number] = len(token)

    def __call__(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        joins = np.array([_joins(s) for s in segments], bool)
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        n = int(joins.sum())
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for first in range(0, n, _JOINED):
            some = [segments[i] for i in order[first : min(n, first + _JOINED)].tolist()]
            try:
                flat, each = self._together(some)
            except UnicodeDecodeError:
                flat, each = self._alone(some)
            ids.append(flat)
            counts.append(each)
        flat, each = self._alone([segments[i] for i in order[n:].tolist()])
        return order, np.concatenate([*ids, flat]), np.concatenate([*counts, each])

    def _alone(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that are not UTF-8 count as U+FFFD."""
        texts = [s.decode("utf-8", "replace") for s in segments]
        found = [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.array([i for ids in found for i in ids], np.uint32)
        return flat, np.array([len(ids) for ids in found], np.int64)

    def _together(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b"".join(segments).decode()
        if self._lengths is not None:
            coded = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(coded.ids, np.uint32)
            starts = np.cumsum(self._lengths[ids]) - self._lengths[ids]
            ends = np.cumsum([len(s) for s in segments])
        else:
            coded = self._tokenizer.encode(text, add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            starts = np.array([start for start, _ in coded.offsets], np.int64)
            ends = np.cumsum([len(s.decode()) for s in segments])
        return ids, np.diff(np.searchsorted(starts, ends), prepend=0)


@functools.lru_cache(maxsize=4)
def token_ids(path: str) -> SegmentIds:
    """One store for each vocabulary and worker."""
    return SegmentIds(_Library(path))
