"""Spelling variants of frequent words, found by PartEnum signatures of their letters.

Two words one edit apart (a code point inserted, deleted or replaced) have letter multisets
of Hamming distance 1 or 2, taken as binary vectors over (letter, k-th occurrence).
PartEnum (partition and enumerate): the dimensions fall by hash into ``PARTS`` partitions,
each into ``SUBPARTS`` sub-partitions.  Two vectors within distance 2 differ in at most
``LEFT_OUT`` sub-partitions of some partition, so for every partition and every choice of
``LEFT_OUT`` sub-partitions left out, the projection on the rest is an exact signature;
vectors within distance 2 share at least one.  Words meet by an equi-join on signature and length (equal, or one
more, which is distance 1 and needs fewer signatures), and the pairs so found are verified by edit distance.  A signature with more than
``BLOCK`` words is split into blocks by hash; every pair of blocks meets under its own
key, so a hot signature takes many tasks and no pair is met twice.

Forms strictly increase ``n`` (at least twice), so the root is found by pointer doubling
in as many rounds as the longest chain has bits.
"""

from __future__ import annotations

from itertools import combinations, count, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.columns import with_computed_once
from linkloom.scratch import written

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
SHORTEST = 5
LEAST_N = 3
FACTOR = 2
#: PartEnum for Hamming distance 2: first-level partitions and sub-partitions of each.  One
#: partition (sub-partitions left out two at a time): two halves leave signatures of half
#: the letters, and on sf0.1 (90,172 words) 148.5 million pairs to verify instead of 19.0.
HAMMING = 2
PARTS, SUBPARTS = 1, 6
LEFT_OUT = -(-(HAMMING + 1) // PARTS) - 1
#: Words of one signature block at most, before the signature is split.
BLOCK = 2_000
#: The bits of the two halves.
_START, _END = -(1 << 32), (1 << 32) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(documents: DataFrame) -> DataFrame:
    """``word``: one row for each run of letters of every text, lower-cased in A-Z, altered.

    If 97 divides the unsigned crc32 of ``<doc_id>:<run>`` (a NULL ``doc_id`` as the empty
    text) the code point at that value modulo the run's length is deleted.  NULL texts
    have no runs.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), F.lit(RUN), 0)).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    runs = runs.select("run", h.alias("h"), (h % F.length("run")).cast("int").alias("at"))
    gone = F.concat(F.expr("substr(run, 1, at)"), F.expr("substr(run, at + 2)"))
    return runs.select(F.when(F.col("h") % 97 == 0, gone).otherwise(F.col("run")).alias("word"))


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word, n``: the words of ``SHORTEST`` code points or more that occur ``LEAST_N`` times or more."""
    counted = occurrences(documents).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= SHORTEST) & (F.col("n") >= LEAST_N))


def _bits(word: Column) -> Column:
    """The letter multiset as dimensions ``letter#k`` (k-th occurrence)."""
    chars = F.regexp_extract_all(word, F.lit("(?s)."), 0)
    return F.transform(
        chars, lambda c, i: F.concat(c, F.lit("#"), F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c)).cast("string"))
    )


def _cases() -> list[tuple[int, tuple[int, ...]]]:
    return [(p, out) for p in range(PARTS) for out in combinations(range(SUBPARTS), LEFT_OUT)]


def _one_apart() -> list[int]:
    """Numbers of cases of which any two vectors at distance 1 share one."""
    left, found = set(product(range(PARTS), range(SUBPARTS))), []
    shared = [{d for d in left if d[0] != p or d[1] in out} for p, out in _cases()]
    while left:
        best = max(range(len(shared)), key=lambda i: len(left & shared[i]))
        found.append(best)
        left = left - shared[best]
    return found


def projections(words: DataFrame) -> DataFrame:
    """``word, length, subs``: a hash of the word's dimensions in each sub-partition.

    The dimensions of a word differ from each other, so the exclusive or of their hashes
    does not depend on their order.
    """
    part = lambda b: F.pmod(F.xxhash64(b), F.lit(PARTS))
    sub = lambda b: F.pmod(F.xxhash64(b, F.lit("sub")), F.lit(SUBPARTS))
    hashed = F.transform(
        _bits(F.col("word")),
        lambda b: F.struct((part(b) * SUBPARTS + sub(b)).cast("int").alias("at"), F.xxhash64(b, F.lit("dimension")).alias("hash")),
    )
    placed = with_computed_once(words.select("word", F.length("word").alias("length")), "hashed", hashed)

    def folded(at: int) -> Column:
        return F.aggregate("hashed", F.lit(0).cast("long"), lambda x, d: F.when(d["at"] == at, x.bitwiseXOR(d["hash"])).otherwise(x))

    return placed.select("word", "length", F.array(*map(folded, range(PARTS * SUBPARTS))).alias("subs"))


def signatures(made: DataFrame) -> DataFrame:
    """``word, tag, number, sig, halves``: the PartEnum signatures of each word with its length (tag 0).

    Tag 1 has them with its length less one, for words of which one letter is gone; these are
    at distance 1, so the cases of ``_one_apart`` are enough.  ``halves`` has 32 bits of a
    hash of the word's start and of its end, of half that length: one edit spares one of them.
    """
    def halves(tag: int) -> Column:
        half = F.expr(f"(length - {tag}) div 2").cast("int")
        start = F.xxhash64(F.substr("word", F.lit(1), half)).bitwiseAND(F.lit(_START))
        return start.bitwiseOR(F.xxhash64(F.substr("word", half + tag + 1)).bitwiseAND(F.lit(_END)))

    def sig(number: int, tag: int) -> Column:
        p, out = _cases()[number]
        kept = [F.col("subs")[p * SUBPARTS + i] for i in range(SUBPARTS) if i not in out]
        value = F.xxhash64(F.lit(number), F.col("length") - tag, *kept)
        return F.struct(F.lit(tag).alias("tag"), F.lit(number).alias("number"), value.alias("sig"))

    found = [sig(i, 0) for i in range(len(_cases()))] + [sig(i, 1) for i in _one_apart()]
    rows = made.select("word", halves(0).alias("h0"), halves(1).alias("h1"), F.inline(F.array(*found)))
    return rows.select("word", "tag", "number", "sig", F.when(F.col("tag") == 0, F.col("h0")).otherwise(F.col("h1")).alias("halves"))


def _keyed(sigs: DataFrame) -> DataFrame:
    """``word, tag, number, halves, key``: a signature of many words gives a key for every pair of blocks that holds
    the word's own; such signatures are few, at most one in ``BLOCK`` rows."""
    hot = sigs.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    hot = written(hot, "spelling-hot")
    blocks = F.coalesce("blocks", F.lit(1))
    keyed = sigs.join(F.broadcast(hot), "sig", "left").select("word", "tag", "number", "halves", "sig", blocks.alias("blocks"))
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    keyed = keyed.select("word", "tag", "number", "halves", "sig", "blocks", mine.alias("mine"), other.alias("other"))
    split = F.xxhash64("sig", F.least("mine", "other"), F.greatest("mine", "other"))
    key = F.when(F.col("blocks") == 1, F.col("sig")).otherwise(split)
    return keyed.select("word", "tag", "number", "halves", key.alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` (a < b): all pairs of the words that are one edit apart, each once."""
    keyed = _keyed(signatures(written(projections(words), "spelling-projections")))

    def side(name: str, which: Column) -> DataFrame:
        return keyed.where(which).select(F.col("word").alias(name), F.col("halves").alias(f"{name}_halves"), "key")

    own = F.col("tag") == 0
    differ = F.col("a_halves").bitwiseXOR(F.col("b_halves"))
    spared = (differ.bitwiseAND(F.lit(_START)) == 0) | (differ.bitwiseAND(F.lit(_END)) == 0)
    replaced = side("a", own).join(side("b", own), "key").where(spared & (F.col("a") < F.col("b")))
    shorter = side("a", own & F.col("number").isin(_one_apart()))
    gone = shorter.join(side("b", F.col("tag") == 1), "key").where(spared & (F.col("a") != F.col("b")))
    met = replaced.select("a", "b").unionByName(gone.select("a", "b"))
    near = met.where(F.levenshtein("a", "b", 1) == 1)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def variants(documents: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word of ``documents``.

    A word's form is its near word of largest ``n`` (ties: the smallest word), if that
    ``n`` is at least twice its own; else NULL, and ``form_n`` with it.  ``root`` follows
    forms to the end.  An empty table or one without frequent words gives no rows;
    repeated rows count each time; columns other than ``doc_id`` and ``text`` are not used.
    """
    words = written(vocabulary(documents), "spelling-words")
    pairs = written(near_pairs(words.select("word")), "spelling-pairs")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
    best = counted.groupBy("a").agg(F.count("*").alias("n_near"))
    top = counted.groupBy("a").agg(F.max("nb").alias("top_n"))
    chosen = counted.join(top, "a").where(F.col("nb") == F.col("top_n")).groupBy("a", "top_n").agg(F.min("b").alias("best"))
    found = words.join(best.withColumnRenamed("a", "word"), "word", "left").join(chosen.withColumnRenamed("a", "word"), "word", "left")
    has_form = F.col("top_n") >= FACTOR * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("top_n")).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    return _rooted(found)


def _rooted(found: DataFrame) -> DataFrame:
    """Adds ``root`` by pointer doubling over ``form``."""
    links = found.select("word", F.coalesce("form", "word").alias("up"))
    for round_ in count():
        step = links.join(links.select(F.col("word").alias("up"), F.col("up").alias("next")), "up", "left")
        doubled = written(step.select("word", F.coalesce("next", "up").alias("up")), f"spelling-roots-{round_}")
        if doubled.join(links, ["word", "up"], "left_anti").isEmpty():
            links = doubled
            break
        links = doubled
    return found.join(links.withColumnRenamed("up", "root"), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", F.col("form_n").cast("long").alias("form_n")
    )
