"""Benchmark passages in training documents, found by winnowing, in Spark SQL alone.

Words are lower-cased (A-Z only) runs of digits, ASCII letters and all characters beyond
ASCII.  A *window* is ten consecutive words of a benchmark item; an item of fewer words
(but one at least) is a single window of all of them.  A document word is *hit* if it lies
inside an occurrence of any window.

Winnowing: every run of ``GRAM`` words has a hash; of every ``SPAN`` consecutive hashes the
least (the leftmost of equals) is a fingerprint.  Two texts that share ``GRAM + SPAN - 1 =
WINDOW`` consecutive words share a fingerprint at the same place of that span, so the
fingerprints of documents and items, joined on the hash, give every alignment of a shared
window (and some of hash collisions).  Each alignment is then extended word by word over
the item, and the ten-word windows that match in full are the occurrences.  Items of fewer
than ten words are found by the hash of all their words at every place of a document of a
length among theirs.  No step keeps a document's words apart from its row, and none
collects more than the set of short item lengths to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.scratch import written

# Fixed values of the contract: the word pattern and the window of ten words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
SPAN = WINDOW - GRAM + 1
#: Item fingerprints (or alignments) broadcast at most; beyond, they are joined by a (salted) shuffle.
SENT_FINGERPRINTS = 1_000_000
#: Parts of a hash value on the salted path, so that a frequent phrase takes several tasks.
SALT = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), 0)


def _grams(wh: str) -> Column:
    """``(h, p)`` structs: for every run of ``GRAM`` words the hash of their hashes ``wh``, and its start."""
    words = ", ".join(f"{wh}[i + {k}]" for k in range(GRAM))
    run = f"transform(sequence(0, size({wh}) - {GRAM}), i -> named_struct('h', xxhash64({words}), 'p', i))"
    return F.expr(f"CASE WHEN size({wh}) >= {WINDOW} THEN {run} ELSE array() END")


def _minima(g: str) -> Column:
    """For every ``SPAN`` consecutive hashes of ``g`` the least (the leftmost of equals)."""
    each = ", ".join(f"{g}[i + {k}]" for k in range(SPAN))
    return F.expr(f"CASE WHEN size({g}) >= {SPAN} THEN transform(sequence(0, size({g}) - {SPAN}), i -> least({each})) ELSE array() END")


def _once(m: str) -> Column:
    """A place is the least of consecutive windows only, so dropping repeats of the one before leaves each once."""
    return F.filter(m, lambda x, i: (i == 0) | (x != F.get(F.col(m), i - 1)))


def _fingerprints(table: DataFrame, key: str, w: str) -> DataFrame:
    """``key, h, p``: the winnowed fingerprints of each row's words."""
    hashed = table.select(key, F.transform(w, lambda x: F.xxhash64(x)).alias("wh"))
    minima = hashed.select(key, _grams("wh").alias("g")).select(key, _minima("g").alias("m"))
    return minima.select(key, F.explode(_once("m")).alias("f")).select(key, "f.h", "f.p")


def _whole_grams(w: str, length: int) -> Column:
    """``(h, p)`` of every run of ``length`` words."""
    run = f"transform(sequence(0, size({w}) - {length}), i -> named_struct('h', xxhash64(slice({w}, i + 1, {length})), 'p', i))"
    return F.expr(f"CASE WHEN size({w}) >= {length} THEN {run} ELSE array() END")


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` and ``items`` with equal ``h``: broadcast if the items' count allows, else salted."""
    if items.count() <= SENT_FINGERPRINTS:
        return docs.join(F.broadcast(items), "h")
    salted = docs.withColumn("salt", (F.col("p") % SALT).cast("int"))
    spread = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return salted.join(spread, ["h", "salt"]).drop("salt")


def _occurrences(candidates: DataFrame, doc_words: DataFrame, item_words: DataFrame) -> DataFrame:
    """``row, item_id, s, e``: each occurring window of an aligned item as a range of document words.

    Right after meeting its alignments a document gives each only the words that the item
    covers, so a document with many alignments is never copied whole.
    """
    sizes = item_words.select("item_key", F.size("iw").alias("m"))
    candidates = written(candidates.distinct().join(sizes, "item_key"), "decontamination-candidates")
    if candidates.count() <= SENT_FINGERPRINTS:  # the documents stay in place
        met = doc_words.join(F.broadcast(candidates), "row")
    else:
        met = candidates.join(doc_words, "row")
    lo, hi = "greatest(0, -offset)", "least(m, size(dw) - offset)"
    met = met.select(
        "row", "item_key", "offset", "m", F.expr(lo).alias("lo"), F.expr(hi).alias("hi"),
        F.expr(f"CASE WHEN {hi} > {lo} THEN slice(dw, offset + {lo} + 1, {hi} - {lo}) ELSE array() END").alias("ds"),
    )
    aligned = met.join(item_words, "item_key")
    mask = "transform(ds, (x, j) -> x = element_at(iw, lo + j + 1))"
    long_item = f"""CASE WHEN size(k) >= {WINDOW} THEN filter(sequence(0, size(k) - {WINDOW}), t -> forall(slice(k, t + 1, {WINDOW}), x -> x)) ELSE array() END"""
    found = aligned.select(
        "row", "item_id", "offset", "lo",
        F.expr(f"m >= {WINDOW}").alias("is_long"), F.expr("hi - lo = m AND m > 0").alias("whole"), F.expr(mask).alias("k"),
    )
    long_hits = found.where("is_long").select(
        "row", "item_id", F.explode(F.expr(long_item)).alias("t"), "offset", "lo"
    ).select("row", "item_id", F.expr("offset + lo + t").alias("s"), F.expr(f"offset + lo + t + {WINDOW}").alias("e"))
    short_hits = found.where("NOT is_long AND whole AND forall(k, x -> x)").select(
        "row", "item_id", F.col("offset").alias("s"), F.expr("offset + size(k)").alias("e")
    )
    return long_hits.unionByName(short_hits)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document row.

    Every row of ``documents`` gives one row, repeated rows and NULL ids too; a NULL text
    has no words.  ``n_items`` counts the different non-NULL ``item_id`` with an occurring
    window, ``items_sha256`` is the SHA-256 of those ids as text, sorted, joined by commas
    (of the empty string if none).  An item whose ``item_id`` is NULL still hits words but is
    not listed; an item without words has no window.  Other columns are not carried.
    """
    docs = written(
        documents.select("doc_id", words(F.col("text")).alias("dw")).withColumn("row", F.monotonically_increasing_id()),
        "decontamination-docs",
    )
    items = written(
        benchmark.select("item_id", words(F.col("text")).alias("iw"))
        .where(F.size("iw") > 0)
        .withColumn("item_key", F.monotonically_increasing_id()),
        "decontamination-items",
    )
    item_words = items.select("item_key", "item_id", "iw")
    doc_words = docs.select("row", "dw")

    doc_prints = _fingerprints(docs, "row", "dw")
    item_prints = _fingerprints(items, "item_key", "iw").withColumnRenamed("p", "ip")
    candidates = _joined(doc_prints, item_prints).select("row", "item_key", (F.col("p") - F.col("ip")).alias("offset"))

    lengths = [r[0] for r in items.where(F.size("iw") < WINDOW).select(F.size("iw")).distinct().collect()]  # < 10 values
    for length in sorted(lengths):
        short = items.where(F.size("iw") == length).select("item_key", F.xxhash64("iw").alias("h"))
        grams = docs.where(F.size("dw") >= length).select("row", F.explode(_whole_grams("dw", length)).alias("f"))
        found = _joined(grams.select("row", "f.h", "f.p"), short)
        candidates = candidates.unionByName(found.select("row", "item_key", F.col("p").alias("offset")))

    hits = _occurrences(candidates, doc_words, item_words)
    ranges = hits.groupBy("row", "s").agg(F.max("e").alias("e"))
    before = F.max("e").over(Window.partitionBy("row").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    covered = ranges.select("row", "s", "e", before.alias("b")).select(
        "row", F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce("b", "s"))).alias("add")
    )
    per_row = covered.groupBy("row").agg(F.sum("add").alias("n_hit"))
    listed = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    out = docs.select("row", "doc_id", F.size("dw").cast("long").alias("n_words")).join(per_row, "row", "left").join(listed, "row", "left")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
