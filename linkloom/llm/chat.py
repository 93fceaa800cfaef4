r"""Conversations as one text each, with a loss mask over its tokens.

The template of a turn is ``<|im_start|>ROLE<|im_sep|>TEXT<|im_end|>``; the three marks are
tokens of their own.  In roles and texts every ``<``, backslashes, ``|`` gets one more
backslash, so no mark can appear there, and dropping one backslash restores them.

Text is encoded once, with offsets; a token is under the mask if it meets the span of an
assistant's text, found by binary search among the sorted spans.  Since marks are tokens,
text is cut at marks without any effect on the ids: a conversation of any length comes as
a series of *chunks* of whole turns, each of bounded size unless one turn is larger.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TRAINED = "assistant"
CHUNK_CHARS = 1 << 18
_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

_SCHEMA = (
    "part int, chunk long, n_turns int, text string,"
    " ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
)


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns, and the spans in it that are to be learned."""
    parts: list[str] = []
    spans = []
    at = 0
    for role, text in turns:
        head, body = START + escape(role) + SEPARATOR, escape(text)
        parts += [head, body, END]
        if role == TRAINED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns that ``render`` was given."""
    turns = []
    for turn in text.split(END)[:-1]:
        role, body = turn.removeprefix(START).split(SEPARATOR)
        turns.append((unescape(role), unescape(body)))
    return turns


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each token's span meets one of the sorted, disjoint spans."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans).T
    after = np.searchsorted(last, starts, "right")  # the first span that ends behind the token's start
    return (after < len(spans)) & (first[np.minimum(after, len(spans) - 1)] < ends)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([START, SEPARATOR, END])
    return tokenizer


def format_conversations(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """Chunks: ``conv_id``, its place (``part``, ``chunk``), the text, token ids, offsets, mask.

    Rows are ordered by ``turn`` (NULL first), ties by role and by a hash of the text.  A
    NULL role or text is empty; NULL is a ``conv_id`` like any other.  Repeated rows are
    turns of their own, an empty table has no chunk, and other columns are not read.
    Offsets count code points of the chunk's text.
    """
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The last key only divides rows that are the same, whose order does not matter.
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "hash", "row"]
    ordered = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("conv_id", "role", "text")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        conv_id, turns, size = None, [], 0

        def chunk() -> pa.RecordBatch:
            text, spans = render(turns)
            coded = _tokenizer(vocabulary).encode(text, add_special_tokens=False)
            starts, ends = np.array(coded.offsets, np.int32).reshape(-1, 2).T
            values = [conv_id, part, number, len(turns), text, coded.ids, starts, ends, loss_mask(starts, ends, spans)]
            kinds = [kind, pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
            columns = ["conv_id", "part", "chunk", "n_turns", "text", "ids", "starts", "ends", "loss"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], columns)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for this, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns and (this != conv_id or size + len(text) > CHUNK_CHARS):
                    yield chunk()
                    number, turns, size = number + 1, [], 0
                conv_id = this
                turns.append((role, text))
                size += len(text) + len(role) + len(START) + len(SEPARATOR) + len(END)
        if turns:
            yield chunk()

    return ordered.mapInArrow(chunks, f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, {_SCHEMA}")


def learned_texts(text: str, starts: list[int], ends: list[int], loss: list[bool]) -> list[str]:
    """The texts under the mask, unescaped; tokens that touch belong together."""
    found: list[list[int]] = []
    for start, end, under in zip(starts, ends, loss, strict=True):
        if under:
            if found and start <= found[-1][1]:
                found[-1][1] = max(end, found[-1][1])
            else:
                found.append([start, end])
    return [unescape(text[a:b]) for a, b in found]


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, from its chunks.

    ``turns_sha256`` is of role, newline, text, newline of each turn; ``loss_sha256`` of all
    that is under the mask.  A digest is sequential by nature, so the chunks of one
    conversation pass through one task, but as a sorted stream, chunk by chunk.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = formatted.select("conv_id", "part", "chunk", "n_turns", "text", "starts", "ends", "loss")
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, n_turns = None, 0
        turns = loss = None
        loss_chars = chars = 0

        def row() -> pa.RecordBatch:
            values = [conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for i in range(batch.num_rows):
                chunk = batch.slice(i, 1).to_pylist()[0]
                if turns is None or chunk["conv_id"] != conv_id:
                    if turns is not None:
                        yield row()
                    conv_id, n_turns, loss_chars, chars = chunk["conv_id"], 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                n_turns += chunk["n_turns"]
                chars += len(chunk["text"])
                for role, text in parse(chunk["text"]):
                    turns.update(f"{role}\n{text}\n".encode())
                for text in learned_texts(chunk["text"], chunk["starts"], chunk["ends"], chunk["loss"]):
                    loss.update(text.encode())
                    loss_chars += len(text)
        if turns is not None:
            yield row()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(digest, schema)
