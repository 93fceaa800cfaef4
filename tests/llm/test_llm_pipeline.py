"""The pipeline against the same stages done by brute force, on the smallest table."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from linkloom.llm import languages, oracles
from test_llm_pairs import brute_classes

SF_DIR = "/root/testdata/sf0.001"


def by_sql(rows, sql):
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])  # noqa: F841
    return {r[0]: r for r in duckdb.sql(sql).fetchall()}


def vector(text, letters):
    points = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 0 for c in text or ""]
    kept = [p for p, last in zip([0, *points, 0], [None, 0, *points], strict=True) if p or last != 0]
    grams = Counter(zip(kept, kept[1:], kept[2:], strict=False)) if any(kept) else {}
    total = np.zeros(languages.DIMENSIONS)
    for gram, n in grams.items():
        total += n * np.prod([np.roll(letters._letter_vector(p), 2 - i) for i, p in enumerate(gram)], 0)
    return total


def brute(rows):
    verdict = by_sql(rows, f"SELECT doc_id, kept FROM ({oracles.SQL['op5_quality']})")
    rows = [r for r in rows if verdict[r[0]][1]]
    letters = languages._Vectors()
    vectors = {r[0]: vector(r[1], letters) for r in rows}
    learned = defaultdict(lambda: np.zeros(languages.DIMENSIONS))
    for r in rows:
        if zlib.crc32(str(r[0]).encode()) % 4 != 2:
            learned[r[2]] += vectors[r[0]]

    def score(v):
        return max((v @ p / np.linalg.norm(p) / np.linalg.norm(v) for p in learned.values()), default=0)

    rows = [r for r in rows if vectors[r[0]].any() and score(vectors[r[0]]) >= languages.LEAST_SCORE]
    texts = by_sql(rows, f"SELECT doc_id, text FROM ({oracles.SQL['op10_site_lines']})")
    docs = [(r[0], texts[r[0]][1]) for r in rows]
    classes = brute_classes(docs)
    return [(i, t) for i, t in docs if classes[i] == i]


def test_pipeline_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = brute([tuple(r) for r in table.collect()])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text in kept:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    assert 100 < len(kept) < table.count()


def test_stages_keep_columns_and_take_odd_rows(spark, odd_documents, no_documents):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_documents, SF_DIR).columns == odd_documents.columns, name
        assert stage(spark, no_documents, SF_DIR).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd_documents, SF_DIR).count() >= odd_documents.count()


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names
