"""Quality rules whose thresholds follow the documents of each language and source.

Every document gets a few whole-number measures.  A sketch of each measure is kept for
each language and source: a histogram whose bins are exact below 32 and 1/16 wide above,
so sketches merge by adding counts (sources to a language, languages to all) and any
quantile comes from cumulated counts.  Each level's fences lie beyond its outer quantiles
(``OUTER`` and ``100 - OUTER`` percent) by the distance of that quantile to the median,
one bin at least.  Fences are pooled: a language's are shrunk towards those of all
documents, a source's towards its language's, with ``PRIOR`` documents' weight, so small
groups follow their language and large ones themselves.  Comparisons are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.columns import with_computed_once
from linkloom.llm.shield import shielded, unshielded
from linkloom.scratch import written

_BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Outer quantiles, in percent, and the weight in documents of the level above.
OUTER = 1
PRIOR = 50
MEASURES = ("word_length", "symbols", "duplicate_lines", "capitals")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _window(words: Column, make: Callable[..., Column]) -> Column:
    """``make(word, ..., start)`` for each five words in a row."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    return F.transform(
        starts, lambda w, i: make(w, *(F.get(words, i + k) for k in range(1, WINDOW)), i)
    )


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more.

    Equal windows have equal hashes, so texts whose hashes all differ have none; only the
    others compare the words themselves.
    """

    def covered(starts: Column) -> Column:
        lengths = F.transform(
            starts,
            lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))),
        )
        return F.aggregate(lengths, F.lit(0), lambda a, b: a + b)

    def repeated(ordered: Column) -> Column:
        def start(x: Column, i: Column) -> Column:
            last, following = F.get(ordered, i - 1), F.get(ordered, i + 1)
            same = F.coalesce(last["w"] == x["w"], F.lit(False)) | F.coalesce(following["w"] == x["w"], F.lit(False))
            return F.when(same, x["i"])

        found = F.filter(F.transform(ordered, start), lambda s: s.isNotNull())
        return _let(F.sort_array(found), covered)

    hashes = _window(words, lambda *w: F.xxhash64(*w[:-1]))
    exact = F.sort_array(
        _window(words, lambda *w: F.struct(F.concat_ws(" ", *w[:-1]).alias("w"), w[-1].alias("i")))
    )
    return _let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(exact, repeated)).otherwise(F.lit(0)),
    )


def measure(documents: DataFrame) -> DataFrame:
    """Adds the counts, ``base_failed`` and the measures; names with ``_q_`` are its own.

    A NULL text counts as one without words.  Other columns stay, whatever their names;
    the counts come in one struct ``_q_``.
    """

    def counts(words: Column) -> Column:
        text = F.coalesce(F.col("text"), F.lit(""))
        lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(
                lines,
                lambda x: F.struct(
                    F.size(x).cast("long").alias("n_lines"),
                    (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                ),
            ).alias("lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        )

    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), _BLANKS), lambda w: w != "")
    return with_computed_once(documents, "_q_", _let(words, counts))


def counted(measured: DataFrame) -> dict[str, Column]:
    """The columns of the counts, by name."""
    q = F.col("_q_")
    found = {n: q[n] for n in ("n_words", "word_chars", "n_symbols", "n_repeat_words")}
    found["n_dup_lines"] = q["lines"]["n_dup_lines"]
    found["base_failed"] = (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])
    return found


def measures() -> dict[str, Column]:
    """Mean word length in hundredths; shares in thousandths."""
    q = F.col("_q_")
    chars = F.greatest(q["word_chars"], F.lit(1))
    return {
        "word_length": F.expr("100 * _q_.word_chars DIV greatest(_q_.n_words, 1)"),
        "symbols": F.expr("1000 * _q_.n_symbols DIV greatest(_q_.word_chars, 1)"),
        "duplicate_lines": F.expr("1000 * _q_.lines.n_dup_lines DIV greatest(_q_.lines.n_lines, 1)"),
        "capitals": F.expr("1000 * _q_.n_capitals DIV greatest(_q_.word_chars, 1)"),
    }


def sketch(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, value, n``: one row for each bin that holds documents.

    Documents that fail the base rules take no part.
    """
    values = F.array(
        *(F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in measures().items())
    )
    rows = measured.where(~counted(measured)["base_failed"]).select("lang", "source", F.inline(values))
    shift = F.expr("greatest(length(bin(value)) - 5, 0)")
    rows = rows.withColumn("shift", shift)
    rows = rows.withColumn("value", F.expr("shiftleft(shiftright(value, shift), shift)"))
    return rows.groupBy("lang", "source", "measure", "value").agg(F.count("*").alias("n"))


def _width(value: str) -> Column:
    """The width of the bin that starts at column ``value``."""
    return F.expr(f"shiftleft(CAST(1 AS BIGINT), greatest(length(bin({value})) - 5, 0))")


def _fences(bins: DataFrame, keys: list[str]) -> DataFrame:
    """``documents`` and the fences ``<measure>_low``, ``<measure>_high`` of each group of ``keys``."""
    merged = bins.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    every = Window.partitionBy(*keys, "measure")
    up_to = every.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = merged.select(
        *keys, "measure", "value", F.sum("n").over(up_to).alias("below"), F.sum("n").over(every).alias("total")
    )
    levels = {"lo": OUTER, "mid": 50, "hi": 100 - OUTER}
    quantiles = placed.groupBy(*keys, "measure").agg(
        F.max("total").alias("documents"),
        *(F.min(F.when(100 * F.col("below") >= p * F.col("total"), F.col("value"))).alias(q) for q, p in levels.items()),
    )
    fenced = quantiles.select(
        *keys, "measure", "documents",
        (F.col("hi") + F.greatest(F.col("hi") - F.col("mid"), _width("hi"))).alias("high"),
        (F.col("lo") - F.greatest(F.col("mid") - F.col("lo"), _width("lo"))).alias("low"),
    )
    rows = []
    for name in MEASURES:
        own = F.col("measure") == name
        rows += [F.max(F.when(own, F.col(end))).alias(f"{name}_{end}") for end in ("low", "high")]
    return fenced.groupBy(*keys).agg(F.max("documents").alias("documents"), *rows)


def thresholds(bins: DataFrame) -> DataFrame:
    """``lang, source``, the documents ``n_own``, ``n_lang`` and fences ``own``, ``by_lang``, ``overall``."""
    names = [f"{name}_{end}" for name in MEASURES for end in ("low", "high")]

    def packed(keys: list[str], as_name: str) -> DataFrame:
        return _fences(bins, keys).select(*keys, "documents", F.struct(*names).alias(as_name))

    own = packed(["lang", "source"], "own").withColumnRenamed("documents", "n_own")
    by_lang = packed(["lang"], "by_lang").select(F.col("lang").alias("l"), F.col("documents").alias("n_lang"), "by_lang")
    overall = packed([], "overall").select(F.lit(1).alias("one"), "overall")
    found = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).withColumn("one", F.lit(1)).join(overall, "one")
    return found.select("lang", "source", "n_own", "n_lang", "own", "by_lang", "overall")


def _inside(value: Column, end: str, name: str) -> Column:
    """Whether ``value`` is within the pooled fence, compared as whole numbers.

    Language: ``(n_lang * F_lang + PRIOR * F_all) / (n_lang + PRIOR)``; source:
    ``(n_own * F_own + PRIOR * language) / (n_own + PRIOR)``.
    """
    big = lambda c: c.cast("decimal(38,0)")
    field = f"{name}_{end}"
    n_own, n_lang = big(F.col("_t_.n_own")), big(F.col("_t_.n_lang"))
    lang_top = n_lang * big(F.col("_t_.by_lang")[field]) + PRIOR * big(F.col("_t_.overall")[field])
    lang_bottom = n_lang + PRIOR
    left = big(value) * (n_own + PRIOR) * lang_bottom
    right = n_own * big(F.col("_t_.own")[field]) * lang_bottom + PRIOR * lang_top
    return left <= right if end == "high" else left >= right


def judge(measured: DataFrame) -> DataFrame:
    """Adds ``_kept_`` to documents that were measured.

    ``measured`` is read twice, so it should come from files.  NULL is a language and a
    source like any other; an empty table gives no row.
    """
    limits = written(thresholds(sketch(measured)), "quality-thresholds")
    limits = limits.select(F.col("lang").alias("_lang_"), F.col("source").alias("_source_"), F.struct(*limits.columns[2:]).alias("_t_"))
    same = F.col("lang").eqNullSafe(F.col("_lang_")) & F.col("source").eqNullSafe(F.col("_source_"))
    inside = F.lit(True)
    for name, value in measures().items():
        inside &= _inside(value, "low", name) & _inside(value, "high", name)
    kept = ~counted(measured)["base_failed"] & F.coalesce(inside, F.lit(True))
    return measured.join(limits, same, "left").withColumn("_kept_", kept).drop("_lang_", "_source_", "_t_")


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    kept = documents.select("doc_id", "lang", "source", "text")
    judged = judge(written(measure(kept).drop("text"), "quality-measures"))
    columns = counted(judged)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *(columns[n].alias(n) for n in names), F.col("_kept_").alias("kept"))


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they are."""
    used = ("text", "lang", "source")
    judged = judge(written(measure(shielded(documents, used)), "quality-measures"))
    return unshielded(judged.where("_kept_"), documents.columns, used)
