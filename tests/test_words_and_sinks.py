import gzip

import pytest
from pyspark.sql import functions as F

from linkloom.operators.inventory import scan_totals
from linkloom.operators.words import word_count
from linkloom.plans import jobs
from linkloom.sinks.tsv import full_scan, keyed, write_parquet, write_tsv
from linkloom.sources.files import file_chunks, text_lines, whole_files


def test_words(spark, rows):
    text = "  a\tb\r\nA b,\fc\n\n c c \x0bd"
    df = spark.createDataFrame([(text,), ("",), (None,), ("a",)], "text STRING")
    assert dict(rows(word_count(df))) == {
        "a": 2, "b": 1, "A": 1, "b,": 1, "c": 1, "c c": 1, "\x0bd": 1,
    }


def test_words_of_files(spark, rows, tmp_path):
    (tmp_path / "1.txt").write_bytes(b"one two\r\ntwo no-newline")
    (tmp_path / "2.txt").write_bytes(b"")
    (tmp_path / "3.txt.gz").write_bytes(gzip.compress(b"two \xff\xe2\x82x\n"))
    whole = whole_files(spark, f"{tmp_path}/*.txt")
    assert whole.count() == 1  # Spark's file sources pass over empty files.
    pieces = file_chunks(spark, f"{tmp_path}/*", chunk_bytes=7).orderBy("path", "number").collect()
    for name in ("1.txt", "3.txt.gz"):
        own = b"".join(bytes(r.content) for r in pieces if r.path.endswith(name))
        assert own == (tmp_path / name).read_bytes()
    assert all(len(r.content) <= 7 for r in pieces)
    lines = text_lines(spark, f"{tmp_path}/*.txt*")
    expected = {"one": 1, "two": 3, "no-newline": 1, "��x": 1}
    assert dict(rows(word_count(lines))) == expected
    assert dict(rows(word_count(whole, "content"))) == {"one": 1, "two": 2, "no-newline": 1}


def test_listing_files_does_not_read_them(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    df = whole_files(spark, str(tmp_path)).select("path", "length")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_full_scan(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    files = whole_files(spark, str(tmp_path))
    full_scan(files)
    assert tuple(scan_totals(files, "content").first())[:2] == (1, 3)


def test_tsv_lines(spark, tmp_path):
    df = spark.createDataFrame([("a\"b", True, None), ("é", False, 2)], "k STRING, b BOOLEAN, n INT")
    write_tsv(df, str(tmp_path / "out"))
    found = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert found == ['a"b\ttrue\tnull', "é\tfalse\t2"]


@pytest.mark.parametrize("partitions", [None, 16])
def test_keyed_output_is_sorted_in_each_file(spark, tmp_path, partitions):
    df = spark.range(2000).select((F.col("id") * 7919 % 101).cast("string").alias("k"), "id")
    write_tsv(df, str(tmp_path / "out"), key="k", partitions=partitions)
    keys_of_file = []
    for path in (tmp_path / "out").glob("part-*"):
        keys = [line.split("\t")[0] for line in path.read_text().splitlines()]
        assert keys == sorted(keys)
        keys_of_file.append(set(keys))
    # At a range's end a key may go on in the next file.
    assert 101 <= sum(map(len, keys_of_file)) <= 101 + 15 * bool(partitions)
    if partitions:
        assert 1 < len(keys_of_file) <= 16
    write_parquet(df, str(tmp_path / "parquet"), key="k", partitions=partitions)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2000


@pytest.mark.parametrize("partitions", [None, 16])
def test_a_hot_key_is_spread_over_partitions(spark, partitions):
    """A third of the rows under one key, with partitions much smaller than that."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        value = F.sha1(F.col("id").cast("string").cast("binary"))
        df = spark.range(0, 120_000, 1, 8).select(key.alias("k"), value.alias("v"))
        found = keyed(df, "k", partitions).groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.count_if(F.col("k") == "hot").alias("hot")
        ).collect()
        assert sum(r.n for r in found) == 120_000
        assert sum(r.hot for r in found) == 40_000
        assert max(r.hot for r in found) < 20_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_jobs_from_files_to_files(spark, tmp_path):
    import derived_inputs as derive

    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    paths = derive.write_warc(table, str(tmp_path / "in"))
    for partitions in (None, 3):
        jobs.write_warc_vertices(spark, paths, f"{tmp_path}/v{partitions}", partitions)
        jobs.write_warc_edges(spark, paths, f"{tmp_path}/e{partitions}", partitions)
        assert spark.read.text(f"{tmp_path}/v{partitions}").count() == 49
        assert spark.read.text(f"{tmp_path}/e{partitions}").count() == 281
    jobs.write_inventory(spark, paths, f"{tmp_path}/inventory")
    jobs.write_word_count(spark, paths, f"{tmp_path}/words")
    jobs.scan_files(spark, paths)
    assert spark.read.text(f"{tmp_path}/inventory").first().value.endswith("\t50\t50\t0")
