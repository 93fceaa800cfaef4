"""Documents packed into sequences: linear grouping of the large, best fit for the small.

Lengths are whole numbers up to the capacity, so the whole corpus is described by how
often each length occurs.  The driver plans with this table alone, whose size is bounded
by the capacity:

1. Large lengths, in descending order, fall into groups of equal cardinality; each group
   counts as its longest length.
2. A linear programme over configurations of those few sizes, solved by column
   generation, says how many sequences have which mix of groups.
3. The actual pieces take the places of their groups.  What they are shorter leaves room.
4. All other pieces, from long to short, go where they fit best.

The plan is a list of runs: neighbours in the order by descending length that go to
sequences in a row.  Every piece finds its run by its place in that order; no group of
pieces is ever gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.public_vocabulary import token_ids
from linkloom.llm.segments import released, slices
from linkloom.scratch import written

CAPACITY = 2048
#: Plans with so many groups are made; the one with the fewest sequences is taken.
GROUPS = (8, 16, 32, 64)
#: Lengths up to this part of the capacity are small.
SMALL = 1 / 3
END_ID = 0
_PLACE = (1 << 33) - 1


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make up the most valuable sequence (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes_up, values_up = sizes[order], values[order]
    for room in range(int(sizes_up[0]), capacity + 1):
        fits = int(np.searchsorted(sizes_up, room, "right"))
        gain = best[room - sizes_up[:fits]] + values_up[:fits]
        most = int(gain.argmax())
        if gain[most] > best[room - 1] + 1e-12:
            best[room], choice[room] = gain[most], order[most]
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return pattern


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how many sequences follow each, rounded down from the programme's optimum."""
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(20 * len(sizes)):
        amount = np.linalg.solve(basis, demand)
        price = np.linalg.solve(basis.T, np.ones(len(sizes)))
        pattern = _best_pattern(sizes, np.maximum(price, 0), capacity)
        if price @ pattern <= 1 + 1e-7:
            break
        change = np.linalg.solve(basis, pattern)
        grows = change > 1e-9
        if not grows.any():
            break
        ratio = np.where(grows, np.maximum(amount, 0) / np.where(grows, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    amount = np.floor(np.maximum(np.linalg.solve(basis, demand), 0) + 1e-6).astype(np.int64)
    return [(basis[:, i].astype(np.int64), int(n)) for i, n in enumerate(amount) if n]


class _Plan:
    def __init__(self, capacity: int):
        self.capacity = capacity
        #: first place, end, place of the first piece of the first sequence, pieces for
        #: each sequence, first sequence, offset of the first piece, length
        self.runs: list[tuple[int, int, int, int, int, int, int]] = []
        self.sequences = 0
        self._rooms: list[int] = []
        self._by_room: dict[int, list[tuple[int, int]]] = {}

    def leave(self, first: int, count: int, filled: int) -> None:
        """``count`` sequences from number ``first`` on are filled so far."""
        room = self.capacity - filled
        if count and room:
            if room not in self._by_room:
                insort(self._rooms, room)
                self._by_room[room] = []
            self._by_room[room].append((first, count))

    def new(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def fit(self, place: int, count: int, length: int) -> None:
        """Pieces of one length go, as many as fit, to the fullest sequences that have room."""
        while count:
            at = bisect_left(self._rooms, length)
            if at == len(self._rooms):
                each = self.capacity // length
                bins = -(-count // each)
                first, filled = self.new(bins), 0
            else:
                room = self._rooms[at]
                first, bins = self._by_room[room].pop()
                if not self._by_room[room]:
                    del self._by_room[room], self._rooms[at]
                filled, each = self.capacity - room, room // length
            used = min(count, bins * each)
            self.runs.append((place, place + used, place, each, first, filled, length))
            whole, rest = divmod(used, each)
            self.leave(first, whole, filled + each * length)
            self.leave(first + whole, min(1, rest), filled + rest * length)
            self.leave(first + whole + min(1, rest), bins - whole - min(1, rest), filled)
            place, count = place + used, count - used


def plan(counts: np.ndarray, groups: tuple[int, ...] = GROUPS, small: float = SMALL) -> np.ndarray:
    """The runs for ``counts[length]`` pieces of each length, ascending by place.

    Places number the pieces in descending order of length.
    """
    best = min((_grouped(counts, n, small) for n in groups), key=lambda x: x.sequences)
    return np.array(sorted(best.runs), np.int64).reshape(-1, 7)


def _grouped(counts: np.ndarray, groups: int, small: float) -> _Plan:
    capacity = len(counts) - 1
    lengths = np.arange(capacity, 0, -1)
    lengths = lengths[counts[lengths] > 0]
    ends = np.cumsum(counts[lengths])
    result = _Plan(capacity)
    n_large = int(counts[int(capacity * small) + 1 :].sum())
    rest: list[tuple[int, int]] = []  # places that have no sequence yet

    def length_at(place: int) -> int:
        return int(lengths[np.searchsorted(ends, place, "right")])

    if n_large:
        size = -(-n_large // groups)
        starts = list(range(0, n_large, size))
        tops = np.array([length_at(s) for s in starts])
        sizes, group_of = np.unique(-tops, return_inverse=True)
        sizes = -sizes
        bounds = [min(starts[i] for i in np.flatnonzero(group_of == g)) for g in range(len(sizes))] + [n_large]
        demand = np.diff(bounds)
        given = list(bounds[:-1])
        for pattern, bins in configurations(sizes, demand.astype(float), capacity):
            slots: list[int] = []
            for g in np.flatnonzero(pattern).tolist():
                for _ in range(int(pattern[g])):
                    slots.append(given[g])
                    given[g] += bins
            first = result.new(bins)
            breaks = {0, bins}
            for slot in slots:
                breaks.update(int(e) - slot for e in ends[(ends > slot) & (ends < slot + bins)])
            steps = sorted(breaks)
            for a, b in zip(steps, steps[1:], strict=False):
                filled = 0
                for slot in slots:
                    length = length_at(slot + a)
                    result.runs.append((slot + a, slot + b, slot + a, 1, first + a, filled, length))
                    filled += length
                result.leave(first + a, b - a, filled)
        rest = [(a, b) for a, b in zip(given, bounds[1:], strict=True) if a < b]
    rest.append((n_large, int(counts.sum())))
    for a, b in rest:
        inside = [int(e) for e in ends[(ends > a) & (ends < b)]]
        for x, y in zip([a, *inside], [*inside, b], strict=True):
            if x < y:
                result.fit(x, y - x, length_at(x))
    return result


def document_pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each ``text`` as ids, with the end id.

    Only a document of more than ``capacity`` ids is cut.  A NULL or empty text is its end
    id alone.  Other columns are not read.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = token_ids(vocabulary)
        for part in slices(batches):
            flat, counts = store.ids(part.column("text"), END_ID)
            raw = memoryview(flat.astype("<u4", copy=False).tobytes())
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            at = (np.cumsum(counts) - counts)[row] + start
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            values = [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), *values], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return documents.select("doc_id", "text").mapInArrow(released(rows, token_ids), schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Repeated rows and rows that tie are pieces of their own.  Without pieces there is no
    row.  ``pieces`` is read twice, so it should come from files.
    """
    spark = pieces.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.desc("length"), F.asc("doc_id"), F.asc("piece")]
    ordered = pieces.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    ordered = written(ordered.withColumn("_place", F.monotonically_increasing_id()), "packing-order")
    parts = ordered.groupBy(F.shiftright("_place", 33).alias("part")).count().collect()
    # One row for each shuffle partition, and one for each length.
    n_parts = 1 + max((r["part"] for r in parts), default=0)
    sizes = np.zeros(n_parts, np.int64)
    for r in parts:
        sizes[r["part"]] = r["count"]
    before = np.cumsum(sizes) - sizes
    counts = np.zeros(capacity + 1, np.int64)
    for r in ordered.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    runs = plan(counts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            local = batch.column("_place").to_numpy()
            place = before[local >> 33] + (local & _PLACE)
            run = runs[np.searchsorted(runs[:, 0], place, "right") - 1]
            step = place - run[:, 2]
            sequence = run[:, 4] + step // run[:, 3]
            offset = run[:, 5] + step % run[:, 3] * run[:, 6]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ordered.mapInArrow(rows, f"{schema}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Cuts, plans and places: one row per piece of a document."""
    return pack(written(document_pieces(documents, vocabulary, capacity), "pieces"), capacity)
