"""Spelling variants (op11), decontamination (op12) and whitening (op13) against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from linkloom.llm.decontamination import contamination
from linkloom.llm.spelling import variants
from linkloom.llm.whitening import whiten

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- op11 ---------------------------------------------------------------------------


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if _one_edit(w, v)] for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    found = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        form = forms[w]
        found.append((w, form, root, n, len(near[w]), words[form] if form else None))
    return sorted(found)


def test_variants_equal_brute_force(spark):
    texts = ["colour " * 7 + "color " * 3 + "colours " * 3, "Kolour Colour colour kolour kolor", "señora senora señora SEÑORA señoras",
             "alpha beta gamma " * 4, "zebra zebras zebraa zebra zebras zebra", "abcde abcdf abcdg " * 3, None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "nullid nullid nullid"), (1, texts[1])]
    found = variants(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_variants(rows)
    assert any(r[1] is not None for r in got)


def test_variants_on_odd_tables(spark, odd_documents, no_documents):
    assert variants(no_documents).count() == 0
    found = variants(odd_documents.withColumnRenamed("kept", "word").withColumnRenamed("score", "n"))
    got = sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_variants([(r.doc_id, r.text) for r in odd_documents.collect()])


def test_words_of_two_lengths_meet_under_few_signatures(spark):
    from linkloom.llm.spelling import projections, signatures

    words = spark.createDataFrame([("planet",), ("planets",)], "word string")
    found = signatures(projections(words))
    assert found.groupBy("tag").count().orderBy("tag").collect() == [(0, 30), (1, 6)]
    a, b = (found.where(w).select("sig") for w in ("word = 'planet' AND tag = 0", "word = 'planets' AND tag = 1"))
    assert a.intersect(b).count() >= 1


def test_hot_signature_is_split(spark, monkeypatch):
    import linkloom.llm.spelling as spelling

    monkeypatch.setattr(spelling, "BLOCK", 3)
    words = [f"w{a}{b}xyz" for a in "abcdefgh" for b in "abcd"]
    rows = [(i, " ".join([w] * 3)) for i, w in enumerate(words)]
    found = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_variants(rows)


# --- op12 ---------------------------------------------------------------------------


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def brute_contamination(docs, items):
    windows = []
    for item_id, text in items:
        w = _words(text)
        if len(w) >= 10:
            windows += [(item_id, tuple(w[i : i + 10])) for i in range(len(w) - 9)]
        elif w:
            windows.append((item_id, tuple(w)))
    found = []
    for doc_id, text in docs:
        w = _words(text)
        hit, ids = set(), set()
        for item_id, window in windows:
            m = len(window)
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) == window:
                    hit.update(range(i, i + m))
                    if item_id is not None:
                        ids.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(found, key=repr)


def test_contamination_equals_brute_force(spark):
    passage = "The quick brown fox jumps over the lazy dog near 12 río banks today"
    items = [(1, passage), (2, "Short item here"), (3, "one two three four five six seven eight nine ten"),
             (None, "hidden null item words"), (4, None), (5, "!!!"), (2, "Short item here")]
    docs = [
        (10, f"intro {passage} outro"),
        (11, "the QUICK brown fox jumps over the lazy dog near 12 rio"),  # 10 words but rio differs
        (12, "x short item here y Short Item Here"),
        (13, "one two three four five six seven eight nine ten one two three four five six seven eight nine ten"),
        (14, "hidden null item words"),
        (15, None),
        (None, passage + " " + passage),
        (16, "quick brown fox jumps over the lazy dog near 12 río banks"),
        (16, "quick brown fox jumps over the lazy dog near 12 río banks"),
    ]
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == brute_contamination(docs, items)
    assert sum(r[5] for r in got) >= 5


def test_contamination_long_texts_and_empty_tables(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "lorem ipsum dolor " * 5), (2, "word3 word4 word5")], "item_id long, text string")
    found = contamination(odd_documents, items)
    want = brute_contamination([(r.doc_id, r.text) for r in odd_documents.collect()], [(1, "lorem ipsum dolor " * 5), (2, "word3 word4 word5")])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert contamination(no_documents, items).count() == 0
    none = contamination(odd_documents, items.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == odd_documents.count()


# --- op13 ---------------------------------------------------------------------------


def brute_whitening(vectors):
    x = np.stack([np.floor(1024 * np.asarray(v, float)).astype(np.int64) + 100_000 for v in vectors])
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    centred = x - s / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    values, vecs = values[order], vecs[:, order]
    keep = values > 1e-9 * values[0]
    values, vecs = values[keep][:8], vecs[:, keep][:, :8]
    return deviation, centred @ vecs / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 10), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, [1.0])]
    rows += [(7, rows[7][1])]  # a repeated row counts twice
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas()
    kept = [v for _, v in rows[:300]] + [rows[7][1]]
    kept = [np.asarray(v, np.float32) for v in kept]
    deviation, white, explained = brute_whitening(kept)
    assert sorted(found.vec_id.unique()) == sorted(set(range(300)))
    assert found.n.unique().tolist() == [301]
    assert found.component.max() == 8
    ordered = found.sort_values(["component", "vec_id"], kind="stable")
    ids = np.array([i for i, _ in rows[:300]] + [7])
    order = np.argsort(ids, kind="stable")
    for k in range(8):
        part = ordered[ordered.component == k + 1]
        got = part.whitened.to_numpy()
        want = white[order, k]
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
        assert part.explained.iloc[0] == pytest.approx(explained[k], rel=1e-4)
    assert np.array_equal(ordered[ordered.component == 1].deviation.to_numpy(), deviation[order])
    assert found.identity_error.max() < 1e-4


def test_whitening_small_and_empty(spark):
    schema = "vec_id long, embedding array<double>, n long"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [0.5, 0.25], 9)], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [0.5, 0.25], 9), (2, [0.5, 0.25], 9)], schema)).count() == 0
    two = whiten(spark.createDataFrame([(1, [0.5, 0.25], 9), (2, [0.25, 0.5], 9), (None, [0.75, 0.0], 1)], schema)).toPandas()
    assert len(two) == 3 and two.component.max() == 1
    assert two.explained.iloc[0] == pytest.approx(1.0)
    assert abs((two.whitened**2).mean() - 1.0) < 1e-9
