"""Near duplicates and vector search against brute force."""

import itertools
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import pivot_search
from linkloom.llm import probminhash as pm


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def probability_jaccard(a, b):
    p, q = sum(a.values()), sum(b.values())
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[x] / p / (a[d] / p), b[x] / q / (b[d] / q)) for x in a.keys() | b.keys())
    return total


def brute_classes(docs):
    sets = {i: shingles(t) for i, t in docs}
    inverse = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            inverse[g].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = {p for ids in inverse.values() for p in itertools.combinations(ids, 2)}
    for a, b in pairs:
        both = len(sets[a].keys() & sets[b].keys())
        plain = both / (len(sets[a]) + len(sets[b]) - both)
        if plain >= 0.8:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_links_between_blocks():
    draw = random.Random(1)
    texts = []
    for i in range(60):
        base = list(range(100 * (i % 3), 100 * (i % 3) + 40))
        members = sorted(draw.sample(base, draw.randint(30, 40)))
        texts.append((bytes([i]), bytes([i % 7]), members))
    part = lambda some: {
        "keys": [k for k, _, _ in some], "classes": [c for _, c, _ in some],
        "sets": [np.array(m, np.uint64).tobytes() for _, _, m in some],
    }
    found = pm.block_links(part(texts[:20]), part(texts))
    classes = {k: c for k, c, _ in texts}
    want = {
        (k, d) for k, c, m in texts[:20] for _, d, n in texts
        if c != d and len({*m} & {*n}) >= 0.8 * len({*m} | {*n})
    }
    assert {(k, classes[o]) for k, o in found} == want and len(found) == len(want)


def test_components_agree_with_the_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 1 << 60, 60, dtype=np.uint64)
    wa, wb = rng.integers(1, 5, 60), rng.integers(1, 5, 60)
    want = probability_jaccard(Counter(dict(zip(a[:50].tolist(), wa[:50].tolist()))), Counter(dict(zip(a[10:].tolist(), wb[10:].tolist()))))
    agree = total = 0
    for salt in range(60):
        moved = pm._mixed(a + np.uint64(salt * 977))
        flat = np.concatenate([moved[:50], moved[10:]])
        who = pm.signatures(flat, np.concatenate([wa[:50], wb[10:]]), np.repeat([0, 1], 50), 2)
        agree += int((who[0] == who[1]).sum())
        total += pm.COMPONENTS
        assert (who != 0).all()
    assert agree / total == pytest.approx(want, abs=0.03)


def test_one_shingle_fills_all_components():
    who = pm.signatures(np.array([5], np.uint64), np.array([3]), np.array([1]), 3)
    assert (who[1] == 5).all() and not who[0].any() and not who[2].any()


def test_near_duplicates_on_a_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r.class_id for r in pm.near_duplicates(table).collect()}
    assert found == brute_classes([(r.doc_id, r.text) for r in table.collect()])


def test_chains_and_large_groups(spark):
    """Copies that differ from each other more than from their base, in one bucket or many."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(120):
        words = list(base)
        for place in draw.sample(range(300), draw.choice([1, 4, 6])):
            words[place] = f"x{i}_{place}"
        docs.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(200)]
    for i in range(30):
        docs.append((1000 + i, " ".join(chain[4 * i :] + [f"d{j}" for j in range(4 * i)])))
    docs += [(5000 + i, " ".join(f"u{i}_{j}" for j in range(50))) for i in range(20)]
    docs += [(9000 + i, "Only three words") for i in range(5)] + [(9999, "only three words")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in pm.near_duplicates(rows).collect()}
    assert found == brute_classes(docs)


def test_copies_that_repeat_a_line(spark):
    """Near copies by sets of shingles that are far apart by counts of shingles."""
    docs = []
    for i in range(40):
        text = " ".join(f"t{i}_{j}" for j in range(300))
        line = " ".join(f"t{i}_{j}" for j in range(288, 300))
        docs += [(2 * i, text), (2 * i + 1, f"{text} " + " ".join([line] * 50))]
    assert probability_jaccard(*(shingles(t) for _, t in docs[:2])) < 0.4
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in pm.near_duplicates(rows).collect()}
    assert found == brute_classes(docs) == {i: i - i % 2 for i, _ in docs}


def test_odd_documents(odd_documents, no_documents):
    found = Counter(map(tuple, pm.near_duplicates(odd_documents).collect()))
    assert found[1, 1] == 2 and found[2, 1] == 1 and found[3, 3] == 1 and found[4, 4] == 1 and found[6, 6] == 1
    assert sum(found.values()) == odd_documents.count()
    kept = pm.keep_one(odd_documents)
    assert kept.schema == odd_documents.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, 5, None, 6, 7, 8, 9, 10])
    assert pm.near_duplicates(no_documents).count() == 0
    assert pm.keep_one(no_documents).count() == 0


def test_ids_that_repeat_with_other_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a)], "doc_id long, text string")
    assert sorted(map(tuple, pm.near_duplicates(rows).collect())) == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert sorted(r.text for r in pm.keep_one(rows).collect()) == [a, b]


def test_one_id_with_several_fates(spark):
    """Repeated and NULL ids: each row goes or stays by its own words."""
    x, y, z = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    near = f"{z} more"

    def kept(*rows):
        table = spark.createDataFrame(list(rows), "doc_id long, text string")
        return Counter(map(tuple, pm.keep_one(table).collect()))

    assert kept((5, x), (1, x), (5, y)) == Counter([(1, x), (5, y)])
    assert kept((5, x), (1, x), (5, y), (9, y), (5, y)) == Counter([(1, x), (5, y)])
    assert kept((1, x), (None, x), (None, y), (None, ""), (None, None)) == Counter(
        [(1, x), (None, y), (None, ""), (None, None)]
    )
    for rows in ([(None, z), (None, near)], [(3, z), (3, near)]):
        found = kept(*rows, (None, y))
        assert found[None, y] == 1 and sum(found.values()) == 2


SCHEMA = "vec_id long, embedding array<float>, score string, rank string"


def brute_top(rows, k):
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    want = {}
    for query, q in sorted(r for r in rows if r[0] % 50 == 0):
        if query not in want:
            top = (1 << 63) - 1
            scores = [(max(-top - 1, min(top, sum(x * y for x, y in zip(q, v)))), i) for i, v in rows if i != query]
            want[query] = sorted(((s, i) for s, i in scores), key=lambda x: (-x[0], x[1]))[:k]
    return want


def search(spark, rows, k=5):
    table = spark.createDataFrame([(i, v, "s", "r") for i, v in rows], SCHEMA)
    vectors = pivot_search.whole_vectors(table)
    found = defaultdict(list)
    for r in pivot_search.top_k(vectors, vectors.where("vec_id % 50 = 0"), k).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return dict(found)


def whole(rows):
    return [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows]


def test_search_with_ties_copies_and_clusters(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows += [(400 + i, [0.5] * 6) for i in range(900)]
    rows += [(1300 + i, (np.eye(6)[i % 6] * 3).tolist()) for i in range(100)]
    rows += rows[:30]
    assert search(spark, rows) == brute_top(whole(rows), 5)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, [1.0]), (6, [])]
    assert search(spark, rows + [(None, [9.0, 9.0])]) == {0: [(65536, 5), (0, 6)]}


def test_large_components_saturate(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 1.0])]
    top = (1 << 63) - 1
    assert search(spark, rows) == {0: [(top, 1), (65536, 3), (-top - 1, 2)]}


def test_large_exact_scores(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 1.0]), (2, [3e7, 2.0]), (3, [3e7, 0.0])]
    assert search(spark, rows) == brute_top(whole(rows), 5)


def test_no_vectors_and_one(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0])]) == {}


def test_index_covers_all_rows_and_prunes(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 8)) * 20
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * 0.1).tolist()) for i in range(1200)]
    table = spark.createDataFrame([(i, v, "s", "r") for i, v in rows], SCHEMA)
    vectors = pivot_search.whole_vectors(table)
    index = pivot_search.fit(vectors)
    blocks = pivot_search.build(vectors, index)
    assert blocks.agg(F.sum(F.size("ids"))).first()[0] == 1200
    query = index.matrix([whole(rows)[0][1]])
    best = sorted((index.products(query, index.matrix([v]))[0, 0] for _, v in whole(rows)), reverse=True)[4]
    assert (index.bounds(query) >= best).mean() < 0.5
    assert search(spark, rows) == brute_top(whole(rows), 5)


def test_no_shuffle_file_outlives_its_step(spark):
    from linkloom.scratch import _CLEANUP, written

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getPath() for i in range(files.size())}

    before, setting = shuffled(), spark.conf.get(_CLEANUP)
    found = written(spark.range(1000).repartition(3, "id").groupBy("id").count(), "step")
    for _ in range(50):  # files go in the background
        left = [f for f in shuffled() - before if "shuffle_" in f]
        if left:
            time.sleep(0.2)
    assert not left
    assert found.count() == 1000 and spark.conf.get(_CLEANUP) == setting
