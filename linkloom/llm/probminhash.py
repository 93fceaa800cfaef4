"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A text is the multiset of its runs of five words (a shorter text is one shingle).  Each
shingle is the source of a Poisson process whose rate is its weight; every arrival falls
on one of ``COMPONENTS`` at random, and a component keeps the shingle that arrives first.
Two texts agree in a component with the probability Jaccard similarity of their weights.
A process ends as soon as its time is later than the last first arrival so far.

Texts with the same words are one *text* from the start.  Texts that agree in a band of
``ROWS`` components share a bucket.  Links are a matter of sets of shingles, so every text
also has the bands of its sketch with all weights 1: texts of similarity 0.8 share none of
those with a probability of 5e-8, however often either repeats a shingle.  The leader of a bucket is its text with the most
company in all of its buckets: of copies that differ from each other, the original.  All
texts of buckets with one leader are a *group*.  Each is compared with the leader, exactly,
by the Jaccard similarity of the sets of shingles.  Groups in which some are not linked to
the leader compare those, the outsiders, with all texts of other classes, in blocks of
bounded size.  So no link between texts of a bucket is lost, no pairs of a group are ever
listed, and a group that hangs together takes comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from linkloom.llm.segments import slices, text_bytes
from linkloom.llm.shield import shielded, unshielded
from linkloom.scratch import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
COMPONENTS = BANDS * ROWS
#: Texts of a block, and bytes of their shingles, at most (but one text at least).
_BLOCK, _BLOCK_BYTES = 256, 2 << 20
#: Ids and keys of so many texts, some 4 MB, may go to every executor; more are shuffled.
_SENT_ROWS = 100_000
_KEYS = ("key", "leader", "class")
_NO_TEXT = b""
#: Bytes of text hashed at once by a worker (but one text at least).
_SLICE = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
_PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64) | 1 for i in range(SHINGLE)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that looks random."""
    x = x ^ (x >> np.uint64(33))
    x = x * _FACTORS[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _FACTORS[1]
    return x ^ (x >> np.uint64(33))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every text, and how many words each text has."""
    data, offsets = text_bytes(texts)
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    starts[first] = inside[first]
    letters = data[inside]
    place = np.concatenate([[0], np.cumsum(inside)])
    begins = place[np.flatnonzero(starts)]
    ends = np.append(begins, len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters))]
    ).dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    counts = np.diff(np.concatenate([[0], np.cumsum(starts)])[offsets])
    return hashes[words.indices.to_numpy()] if len(hashes) else hashes, counts


def _shingles(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of one text, ascending, and how often it has each."""
    n = len(words)
    if n < SHINGLE:
        return (_mixed(np.array([words @ _PLACES[:n] + np.uint64(n)], np.uint64)), np.ones(1, np.int64)) if n else (words, np.empty(0, np.int64))
    found = np.zeros(n - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        found += words[i : n - SHINGLE + 1 + i] * _PLACES[i]
    found = np.sort(_mixed(found))
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[starts], np.diff(np.append(starts, len(found)))


def signatures(shingles: np.ndarray, weights: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """For each text and component the shingle that arrives first (0 without shingles)."""
    time = np.full(n_texts * COMPONENTS, np.inf)
    who = np.zeros(n_texts * COMPONENTS, np.uint64)
    last = np.full(n_texts, np.inf)
    rate = 1.0 / weights
    now = np.zeros(len(shingles))
    step = 0
    while len(shingles):
        step = (step + int(_GOLDEN)) % (1 << 64)
        draw = _mixed(shingles + np.uint64(step))
        now = now - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) * rate
        alive = now < last[text]
        shingles, text, now, rate, draw = shingles[alive], text[alive], now[alive], rate[alive], draw[alive]
        place = text * COMPONENTS + (_mixed(draw ^ _GOLDEN) % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(time, place, now)
        first = time[place] == now
        who[place[first]] = shingles[first]
        busy = np.flatnonzero(np.bincount(text, minlength=n_texts)) if len(text) else text
        last[busy] = time.reshape(n_texts, COMPONENTS)[busy].max(1)
    return who.reshape(n_texts, COMPONENTS)


def _buckets(who: np.ndarray) -> np.ndarray:
    """For each text and band a number of the shingles in the band's components."""
    who = who.reshape(len(who), BANDS, ROWS)
    bucket = np.broadcast_to(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), who.shape[:2])
    for i in range(ROWS):
        bucket = _mixed(bucket * _GOLDEN + who[:, :, i])
    return bucket


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id``, a 16-byte ``key`` of the words (none without words) and its buckets.

    Buckets are those of the weighted sketch, and those of the sketch with all weights 1
    where they differ.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=_SLICE):
            words, counts = _words(piece.column("text"))
            parts = np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []
            found = [_shingles(p) for p in parts]
            text = np.repeat(np.arange(len(found)), [len(s) for s, _ in found])
            shingles = np.concatenate([s for s, _ in found])
            weights = np.concatenate([w for _, w in found])
            bucket = _buckets(signatures(shingles, weights, text, len(found)))
            buckets, kept = bucket, np.ones(bucket.shape, bool)
            repeats = np.array([bool((w > 1).any()) for _, w in found], bool)
            if repeats.any():  # the others have the same buckets with all weights 1
                of = repeats[text]
                number = np.cumsum(repeats) - 1
                even = bucket.copy()
                even[repeats] = _buckets(
                    signatures(shingles[of], np.ones(int(of.sum()), np.int64), number[text[of]], int(repeats.sum()))
                )
                buckets, kept = np.hstack([bucket, even]), np.hstack([kept, even != bucket])
            keys = [xxhash.xxh3_128_digest(p.tobytes()) if len(p) else _NO_TEXT for p in parts]
            flat = pa.array(buckets[kept].view(np.int64))
            ends = pa.array(np.concatenate([[0], np.cumsum(kept.sum(1))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(ends, flat)],
                ["doc_id", "key", "buckets"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, key binary, buckets array<long>")


def _sent_if_small(ids: DataFrame) -> DataFrame:
    """Files of numbers and keys, to be broadcast if they have few rows; texts then stay in place."""
    fixed = all(f.dataType.simpleString() in ("int", "bigint", "boolean") or f.name in _KEYS for f in ids.schema.fields)
    return F.broadcast(ids) if fixed and ids.count() <= _SENT_ROWS else ids


def _shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key, shingles`` of the texts whose ``rep`` and ``key`` are wanted."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=_SLICE):
            words, counts = _words(piece.column("text"))
            keys, shingles = [], []
            for part, key in zip(np.split(words, np.cumsum(counts)[:-1]), piece.column("key").to_pylist(), strict=True):
                if xxhash.xxh3_128_digest(part.tobytes()) == key:  # else another text with this doc_id
                    keys.append(key)
                    shingles.append(_shingles(part)[0].tobytes())
            columns = [pa.array(x, pa.binary()) for x in (keys, shingles)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "shingles"])

    texts = documents.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")))
    return texts.select("text", "key").mapInArrow(rows, "key binary, shingles binary").dropDuplicates(["key"])


def _alike(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of ``a`` and ``b`` shingles, ``both`` of them common, are similar enough."""
    return both >= (SIMILARITY - 1e-9) * (a + b - both)


def _linked_to_leader(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: the leaders and texts that are similar enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for one, other in zip(batch.column("sa"), batch.column("sb"), strict=True):
                a, b = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(bool(_alike(both, len(a), len(b))))
            found = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield found.filter(pa.array(kept, pa.bool_()))

    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    pairs = groups.where("key != leader").select(F.col("leader").alias("a"), F.col("key").alias("b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(rows, "a binary, b binary")


def _blocks(members: DataFrame) -> DataFrame:
    """Texts of one group, with class and shingles, in rows of bounded size."""
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = members.repartitionByRange(partitions, "leader", "key").sortWithinPartitions("leader", "key")
    kinds = [pa.binary(), *[pa.list_(pa.binary())] * 3]
    names = ["leader", "keys", "classes", "sets"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, held, size = None, [], 0

        def block() -> pa.RecordBatch:
            values = [[leader], *([list(x)] for x in zip(*held, strict=True))]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for of, *member in zip(*(batch.column(n).to_pylist() for n in ("leader", "key", "class", "shingles")), strict=True):
                if held and (of != leader or len(held) == _BLOCK or size + len(member[2]) > _BLOCK_BYTES):
                    yield block()
                    held, size = [], 0
                leader = of
                held.append(member)
                size += len(member[2])
        if held:
            yield block()

    schema = "leader binary, keys array<binary>, classes array<binary>, sets array<binary>"
    return written(ordered.mapInArrow(rows, schema), "blocks")


def block_links(outside: dict, members: dict) -> list[tuple[bytes, bytes]]:
    """Links between texts of two blocks; for each text and other class one is enough."""
    sets = [np.frombuffer(x, np.uint64) for x in outside["sets"]]
    others = [np.frombuffer(x, np.uint64) for x in members["sets"]]
    different, number = np.unique(np.concatenate(others), return_inverse=True)
    sizes = np.array([len(x) for x in others])
    starts = np.cumsum(sizes) - sizes
    classes = np.array([*members["classes"], None], object)[:-1]
    found = []
    for key, own_class, own in zip(outside["keys"], outside["classes"], sets, strict=True):
        place = np.minimum(np.searchsorted(different, own), len(different) - 1)
        has = np.zeros(len(different), np.int64)
        has[place[different[place] == own]] = 1
        both = np.add.reduceat(has[number], starts)
        seen = {own_class}
        for i in np.flatnonzero(_alike(both, len(own), sizes)).tolist():
            if classes[i] not in seen:
                seen.add(classes[i])
                found.append((key, members["keys"][i]))
    return found


def _links_of_outsiders(groups: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: links that groups have besides those to their leader.

    Texts linked to the leader count as its class here, all others as classes of their own.
    """
    linked = links.select(F.col("a").alias("leader"), F.col("b").alias("key"), F.lit(True).alias("linked"))
    inside = F.coalesce("linked", F.col("key") == F.col("leader"))
    marked = groups.join(linked, ["leader", "key"], "left").select(
        "leader", "key", F.when(inside, F.col("leader")).otherwise(F.col("key")).alias("class"), (~inside).alias("outside")
    )
    marked = written(marked, "marked")
    open_groups = marked.where("outside").select("leader").distinct()
    marked = written(marked.join(open_groups, "leader", "left_semi").select("leader", "key", "class", "outside"), "open")
    full = _sent_if_small(marked).join(sets, "key")
    every = _blocks(full)
    some = _blocks(full.where("outside"))
    names = ["keys", "classes", "sets"]
    some = some.select("leader", *(F.col(n).alias(f"o_{n}") for n in names))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = block_links({n: row[f"o_{n}"] for n in names}, {n: row[n] for n in names})
                columns = [pa.array([pair[k] for pair in found], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return some.join(every, "leader").mapInArrow(rows, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``key, class``: each end of a link and the smallest key that links lead to.

    Every round takes the smallest class of all neighbours, then the class of that class.
    Partial minima keep a text with many links from being a hot spot.
    """
    both = written(
        links.select("a", "b").union(links.select("b", "a")).distinct().toDF("key", "other"), "links"
    )
    labels = written(both.groupBy("key").agg(F.least(F.min("other"), F.col("key")).alias("class")), "classes")
    while True:
        of = labels.select(F.col("key").alias("other"), F.col("class").alias("next"))
        near = both.join(of, "other").groupBy("key").agg(F.min("next").alias("near"))
        moved = labels.join(near, "key").select("key", "class", F.least("class", "near").alias("new"))
        jump = labels.select(F.col("key").alias("new"), F.col("class").alias("far"))
        moved = moved.join(jump, "new").select("key", F.least("new", "far").alias("class"), (F.least("new", "far") != F.col("class")).alias("moved"))
        moved = written(moved, "classes")
        labels = moved.select("key", "class")
        if moved.where("moved").isEmpty():
            return labels


def _classes(documents: DataFrame, prints: DataFrame) -> DataFrame:
    """``key, class`` of all texts that are in a class with others."""
    texts = prints.where(F.col("key") != F.lit(_NO_TEXT)).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("buckets").alias("buckets")
    )
    texts = written(texts, "texts")
    placed = texts.select(F.explode("buckets").alias("bucket"), "key")
    # Most buckets hold one text, so they are shuffled once, with the key, at any size of the table.
    counted = placed.withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
    members = written(counted.where("n > 1"), "members")
    company = members.groupBy("key").agg(F.sum("n").alias("company"))
    ranked = written(members.join(company, "key").select("bucket", F.struct("company", "key").alias("text")), "ranked")
    leaders = ranked.groupBy("bucket").agg(F.max("text").alias("leader"))
    groups = ranked.join(leaders, "bucket").select(F.col("leader.key").alias("leader"), F.col("text.key").alias("key"))
    groups = written(groups.distinct(), "groups")
    wanted = texts.select("key", "rep").join(company.select("key"), "key", "left_semi")
    wanted = _sent_if_small(written(wanted, "wanted"))
    sets = written(_shingle_sets(documents, wanted), "shingles")
    links = written(_linked_to_leader(groups, sets), "links")
    more = written(_links_of_outsiders(groups, links, sets), "links")
    return components(links.union(more))


def _named(documents: DataFrame) -> DataFrame:
    """``doc_id, key, class``: one row for each document."""
    prints = written(fingerprints(documents), "fingerprints")
    labels = _classes(documents, prints)
    named = prints.select("doc_id", "key").join(labels, "key", "left").select(
        "doc_id", "key", F.coalesce("class", "key").alias("class")
    )
    return written(named, "named")


def _classified(documents: DataFrame) -> DataFrame:
    """``doc_id, class_id``: one row for each document."""
    named = _named(documents)
    smallest = named.where(F.col("class") != F.lit(_NO_TEXT)).groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("n")
    )
    smallest = smallest.where("n > 1").drop("n")
    return named.join(smallest, "class", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id``, the smallest ``doc_id`` of its class, for every document.

    A text without words is alone in its class.  Rows that repeat a ``doc_id`` each give a
    row.  A NULL ``doc_id`` is never a ``class_id`` while its class has another.
    """
    return _classified(documents)


@F.arrow_udf(BinaryType())
def _key(texts: pa.Array) -> pa.Array:
    """The key that ``fingerprints`` gives to each text."""
    words, counts = _words(texts)
    parts = np.split(words, np.cumsum(counts)[:-1]) if len(counts) else []
    return pa.array([xxhash.xxh3_128_digest(p.tobytes()) if len(p) else _NO_TEXT for p in parts], pa.binary())


def _first_or_not(named: DataFrame) -> DataFrame:
    """``doc_id, key, first``: whether the row has the id and words that its class keeps.

    NULL for rows that are alone in their class, and for texts without words.
    """
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    firsts = named.where(F.col("key") != F.lit(_NO_TEXT)).groupBy("class").agg(
        F.min(own).alias("kept"), F.count("*").alias("n")
    )
    firsts = firsts.where("n > 1").drop("n")
    first = F.when(F.col("kept").isNotNull(), own.eqNullSafe(F.col("kept")))
    return named.join(firsts, "class", "left").select("doc_id", "key", first.alias("first"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest ``doc_id``, with all its columns.

    A NULL ``doc_id`` comes after all others; of different texts of the class with that
    ``doc_id`` the one with the smallest key stays, of rows with the same words one.  Texts
    without words all stay.  Rows with one ``doc_id`` whose fates differ are told apart by
    their words.
    """
    found = written(_first_or_not(_named(documents)), "named")
    ids = found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_if(~F.col("first")).alias("n_gone"), F.count_if("first").alias("n_first")
    )
    ids = written(ids.where("n_gone > 0 OR n_first > 1"), "ids")
    gone = _sent_if_small(written(ids.where("n_gone = n").select(F.col("doc_id").alias("_gone_")), "gone"))
    mixed = written(ids.where("n_gone < n AND n > 1").select(F.col("doc_id").alias("_mixed_")), "mixed")
    used = ("doc_id", "text")
    kept = shielded(documents, used).join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_")), "left_anti")
    if not mixed.isEmpty():
        of_mixed = F.col("doc_id").eqNullSafe(F.col("_mixed_"))
        pairs = found.where("NOT first").join(mixed, of_mixed, "left_semi")
        pairs = pairs.select(F.col("doc_id").alias("_gone_"), F.col("key").alias("_of_")).distinct()
        pairs = written(pairs, "gone")
        mixed = _sent_if_small(mixed)
        rest = kept.join(mixed, of_mixed, "left_semi").withColumn("_key_", _key("text"))
        rest = rest.join(pairs, F.col("doc_id").eqNullSafe(F.col("_gone_")) & (F.col("_key_") == F.col("_of_")), "left_anti")
        alone = rest.where(F.col("_key_") == F.lit(_NO_TEXT))
        rest = rest.where(F.col("_key_") != F.lit(_NO_TEXT)).dropDuplicates(["doc_id", "_key_"])
        kept = kept.join(mixed, of_mixed, "left_anti")
        kept = kept.unionByName(rest.unionByName(alone).drop("_key_"))
    return unshielded(kept, documents.columns, used)
