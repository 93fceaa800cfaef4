"""Quality rules, line dedup and languages on odd rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom.llm import languages, quality, site_lines


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    n_symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(inside), failed


def test_counts(odd_documents):
    found = quality.quality_verdicts(odd_documents).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter((r.doc_id, *counts(r.text)) for r in odd_documents.collect())
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == want
    assert not any(r.kept for r in found if r.base_failed)


def test_windows_that_overlap(spark):
    texts = ["a b c d e a b c d e a", "x " * 12, "a b c d e f g h i j k l", "a b c d e q a b c d e"]
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.n_repeat_words for r in quality.quality_verdicts(rows).collect()}
    assert found == {i: counts(t)[4] for i, t in enumerate(texts)}


def test_fences_follow_the_group(spark):
    """Symbols are usual in one source and out of place in another."""
    rows = []
    for i in range(300):
        plain = " ".join(f"alpha{j * i % 97} beta{j}" for j in range(20))
        rows.append((i, plain, "en", "prose"))
        rows.append((1000 + i, plain.replace(" ", " ## "), "en", "code"))
    rows.append((5000, rows[0][1].replace(" ", " ## "), "en", "prose"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    lost = {r.doc_id for r in quality.quality_verdicts(table).where("NOT kept").collect()}
    assert lost == {5000}


def test_few_symbols_where_others_have_none(spark):
    """Some 5% of symbols are out of place among texts without any; what more than the outer
    percent of a group has is not."""
    plain = " ".join(f"word{j} other{j * 7}" for j in range(20))
    marked = " ".join(f"#{j}" for j in range(13))
    rows = [(i, plain, "en", "prose") for i in range(150)] + [(500, f"{plain} {marked}", "en", "prose")]
    rows += [(501, plain + " #", "en", "prose"), (502, plain + " &", "en", "prose")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality.quality_verdicts(table).where("NOT kept").collect()] == [500]


def test_fences_differ_between_groups(spark):
    """Fences come from each group's own quantiles: the same text is in place in one source only."""
    plain = " ".join(f"word{j} other{j * 7}" for j in range(20))
    marked = " ".join(f"&{j}" for j in range(6))
    rows = [(i, plain, "en", "prose") for i in range(300)] + [(1000 + i, f"{plain} {marked}", "en", "shop") for i in range(300)]
    rows += [(5000, f"{plain} {marked}", "en", "prose"), (5001, f"{plain} {marked}", "en", "shop")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality.quality_verdicts(table).where("NOT kept").collect()] == [5000]
    fences = quality.thresholds(quality.sketch(quality.measure(table))).collect()
    assert len({r.own.symbols_high for r in fences}) == 2


def test_small_groups_use_their_language(spark):
    plain = " ".join(f"word{j} other{j * 7}" for j in range(20))
    rows = [(i, plain, "en", f"s{i}") for i in range(150)] + [(999, plain.replace(" ", " $$$$ "), "en", "s999")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in quality.quality_verdicts(table).where("NOT kept").collect()] == [999]


def test_keep_good_keeps_columns(odd_documents, no_documents):
    kept = quality.keep_good(odd_documents)
    assert kept.schema == odd_documents.schema
    assert {r.doc_id for r in kept.collect()} == {1, 2, 7}
    assert kept.where("doc_id = 1").count() == 2
    assert quality.keep_good(no_documents).count() == 0
    assert quality.quality_verdicts(no_documents).count() == 0


def pages(spark, n=20):
    rows = [(i, f"unique {i}\nsite footer\n\n", "a" if i < n else None) for i in range(n + 3)]
    return rows


def test_site_lines(spark, odd_documents, no_documents):
    schema = "doc_id long, text string, source string, lines string"
    rows = [(*r, "x") for r in pages(spark)]
    rows += [(100 + i, "a copy\nof one page", "a", "x") for i in range(15)]
    rows += [(200, "site footer", "a", "x"), (201, None, "a", "x"), (202, "", "a", "x"), (203, "site footer", "b", "x")]
    table = spark.createDataFrame(rows, schema)
    found = {r.doc_id: r.text for r in site_lines.drop_site_lines(table).collect()}
    assert found[0] == "unique 0\n\n"
    assert found[20] == "unique 20\nsite footer\n\n", "three pages are not enough"
    assert found[100] == "a copy\nof one page", "copies of a page count once"
    assert (found[200], found[201], found[202], found[203]) == ("", None, "", "site footer")
    assert site_lines.drop_site_lines(table).columns == table.columns
    report = {r.doc_id: (r.n_lines, r.n_dropped) for r in site_lines.line_report(table).collect()}
    assert report[0] == (4, 1) and report[201] == (0, 0) and report[100] == (2, 0)
    same = site_lines.drop_site_lines(odd_documents)
    assert Counter(map(tuple, same.collect())) == Counter(map(tuple, odd_documents.collect()))
    assert site_lines.drop_site_lines(no_documents).count() == 0


def test_lines_on_a_smaller_share_of_a_large_site(spark):
    """Boilerplate of 8% of the pages goes, a sentence of 4.5% stays."""
    rows = [(i, f"unique {i}" + "\nfooter" * (i < 16) + "\nsaying" * (i >= 191), "a") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.text for r in site_lines.drop_site_lines(table).collect()}
    assert all(found[i] == f"unique {i}" for i in range(191))
    assert all(found[i] == f"unique {i}\nsaying" for i in range(191, 200))


def test_hosts_of_urls(spark):
    rows = [(i, f"http://h.example/{i}", f"p {i}\nmenu") for i in range(12)]
    table = spark.createDataFrame(rows, "page_id long, url string, text string")
    table = table.withColumn("host", F.regexp_extract("url", "//([^/]*)", 1))
    assert {r.text for r in site_lines.drop_site_lines(table, host="host").collect()} == {f"p {i}" for i in range(12)}


def test_languages_on_odd_rows(odd_documents, no_documents):
    found = languages.identify(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by_id = {r.doc_id: r for r in found}
    for doc_id in (3, 4, 6, 10):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in found} <= {"en", "fr", "de", "ja", "und"}
    assert languages.identify(no_documents).count() == 0
    kept = languages.keep_identified(odd_documents)
    assert kept.schema == odd_documents.schema
    assert not {3, 4, 6, 10} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    rows = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in languages.identify(rows).collect()] == [("und", 0.0)]


def test_held_out_rule(spark):
    import zlib

    ids = spark.range(200).select(F.col("id").alias("doc_id"), languages.held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in ids.collect())


def test_accuracy_on_documents_that_were_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = languages.identify(table).join(table, "doc_id").where("held_out")
    right = found.where("lang = lang_pred").count()
    assert right >= 0.99 * found.count()


def test_bundle_is_the_sum_of_bound_vectors():
    import numpy as np

    vectors = languages._Vectors()
    (grams, counts), = languages._grams(["Aba, ab"])
    text = " aba ab "
    want = sum(
        np.prod([np.roll(vectors._letter_vector(ord(c) if c != " " else 0), 2 - i) for i, c in enumerate(text[k : k + 3])], 0)
        for k in range(len(text) - 2)
    )
    assert np.array_equal(vectors.bundle(grams, counts), want)


@pytest.mark.parametrize("name", ["quality", "site_lines"])
def test_no_python_in_native_plans(odd_documents, name):
    plan = {"quality": quality.quality_verdicts, "site_lines": site_lines.line_report}[name](odd_documents)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)
