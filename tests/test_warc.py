import gzip
import os

import pytest

from linkloom.operators.graph import edges, vertices
from linkloom.operators.headers import warc_body, warc_headers
from linkloom.operators.inventory import corpus_inventory
from linkloom.operators.links import corpus_totals, link_outcomes, links
from linkloom.operators.pages import page_outcomes, pages_from_table, pages_from_warc
from linkloom.plans import jobs
from linkloom.sources import warc
from linkloom.sources.warc import read_warc


def record(content=b"", target="http://h/x", extra=(), kind="response", length=None):
    lines = ["WARC/1.0", f"WARC-Type: {kind}"]
    if target is not None:
        lines.append(f"WARC-Target-URI: {target}")
    lines += extra
    if length != "":
        lines.append(f"Content-Length: {len(content) if length is None else length}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


@pytest.fixture
def read(spark, tmp_path):
    """Writes bytes as a file and reads it back as rows in file order."""

    def run(data, name="a.warc.gz", **options):
        packed = gzip.compress(data) if name.endswith(".gz") else data
        (tmp_path / name).write_bytes(packed)
        return read_warc(spark, str(tmp_path / name), **options).orderBy("record_no").collect()

    return run


def contents(rows):
    return [None if r.content is None else bytes(r.content) for r in rows]


def test_fields_of_a_record(read):
    extra = [
        "WARC-Date: 2012-02-10T21:51:20Z",
        "WARC-Record-ID: <urn:uuid:1>",
        "Content-Type: application/http",
        "WARC-TREC-ID:  doc-1 ",
        "NoColon",
        "Twice: 1",
        "Twice: 2: b",
        "warc-type: lower",
    ]
    (row,) = read(record(b"abc", extra=extra))
    assert row.warc_file.endswith("a.warc.gz") and row.warc_file.startswith("file:")
    assert (row.record_no, row.record_type, row.warc_date) == (1, "response", "2012-02-10T21:51:20Z")
    assert (row.record_id, row.content_type) == ("<urn:uuid:1>", "application/http")
    assert (row.content_length, bytes(row.content), row.read_error) == (3, b"abc", None)
    assert row.metadata == {
        "WARC-Target-URI": "http://h/x",
        "WARC-TREC-ID": "doc-1",
        "NoColon": "",
        "Twice": "2: b",
        "warc-type": "lower",
    }


def test_headers_may_follow_the_length(read):
    data = b"WARC/1.0\ncontent-length: 2\nWARC-Type: info\n\nok\n\n"
    (row,) = read(data, "a.warc")
    assert (row.record_type, bytes(row.content)) == ("info", b"ok")


def test_content_may_hold_a_record_mark(read):
    inner = record(b"inner")
    rows = read(record(inner) + record(b"next"))
    assert contents(rows) == [inner, b"next"]


def test_text_before_a_record_is_skipped(read):
    rows = read(b"junk\nxWARC/1.0\n" + b"y" * 3_000_000 + b"\n" + record(b"a"))
    assert contents(rows) == [b"a"]


def test_empty_content_and_empty_files(read):
    assert contents(read(record(b"") + record(b"x"))) == [b"", b"x"]
    assert read(b"", "empty.warc.gz") == []
    assert read(b"", "empty.warc") == []


def test_several_gzip_members(spark, tmp_path):
    data = b"".join(gzip.compress(record(str(i).encode())) for i in range(50))
    (tmp_path / "m.warc.gz").write_bytes(data)
    rows = read_warc(spark, str(tmp_path / "m.warc.gz")).orderBy("record_no").collect()
    assert contents(rows) == [str(i).encode() for i in range(50)]
    assert [r.record_no for r in rows] == list(range(1, 51))


@pytest.mark.parametrize("length", ["", "abc", "-1", "9223372036854775808", "1_0", "٣"])
def test_a_bad_length_ends_the_file(read, length):
    rows = read(record(b"a") + record(b"b", length=length) + record(b"c"))
    assert contents(rows) == [b"a", None]
    assert [r.read_error is None for r in rows] == [True, False]


def test_damaged_gzip_keeps_earlier_records(spark, tmp_path):
    members = [gzip.compress(record(os.urandom(5000))) for _ in range(4)]
    cut = b"".join(members[:3]) + members[3][:2000]
    broken = bytearray(b"".join(members))
    start = sum(map(len, members[:2])) + 10
    broken[start : start + 50] = b"\xff" * 50
    garbage = members[0] + b"no gzip"
    for name, data, n_good in (("cut", cut, 3), ("broken", broken, 2), ("garbage", garbage, 1)):
        (tmp_path / f"{name}.warc.gz").write_bytes(bytes(data))
        rows = read_warc(spark, str(tmp_path / f"{name}.warc.gz")).orderBy("record_no").collect()
        assert [r.read_error is None for r in rows] == [True] * n_good + [False], name
        assert rows[-1].record_no == n_good + 1


def test_content_that_ends_early_is_dropped(read):
    rows = read(record(b"a") + record(b"bcd", length=100), "a.warc")
    assert contents(rows) == [b"a", None]
    assert rows[1].read_error is not None


def test_content_can_be_left_out(read):
    data = record(b"a" * 10) + record(b"b" * 11) + record(b"c" * 3_000_000)
    rows = read(data, content=False)
    assert contents(rows) == [None] * 3
    assert [r.content_length for r in rows] == [10, 11, 3_000_000]
    rows = read(data, max_content_bytes=10)
    assert contents(rows) == [b"a" * 10, None, None]
    assert [r.content_length for r in rows] == [10, 11, 3_000_000]


def test_batches_are_bounded_by_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_BATCH_BYTES", 1000)
    path = tmp_path / "a.warc"
    path.write_bytes(record(b"x" * 300) * 9 + record(b"y" * 5000) + record(b"z"))
    batches = [batch.column("content").to_pylist() for batch in warc._read_file(f"file:{path}", 1 << 20)]
    assert sum(map(len, batches)) == 11
    for batch in batches:
        assert len(batch) == 1 or sum(map(len, batch)) <= 1000
    assert [b"y" * 5000] in batches


def test_batches_stay_small(tmp_path):
    path = tmp_path / "a.warc"
    path.write_bytes(record(b"x" * 3000) * 12_000)
    batches = [batch.nbytes for batch in warc._read_file(f"file:{path}", 1 << 20)]
    assert max(batches) < 4 << 20


def test_small_files_share_a_batch(tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.warc").write_bytes(record(b"x") if i % 2 else record(b"x", length=""))
    paths = [f"file:{tmp_path}/{i}.warc" for i in range(5)]
    (batch,) = warc._read_files(paths, 1 << 20)
    assert batch.column("warc_file").to_pylist() == paths
    assert [e is None for e in batch.column("read_error").to_pylist()] == [False, True] * 2 + [False]


def test_one_record_in_each_file(spark, rows):
    import derived_inputs as derive
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(i, f"http://h/{i}", "é" * i) for i in range(40)], "page_id long, url string, html string")
    path = derive.write_warc(table, derive.scratch_path(spark, "each"), 1, damaged=F.col("page_id") % 4 == 1)
    assert "*" not in path  # a glob would have the driver look at each file by itself
    records = read_warc(spark, path)
    assert records.select("warc_file").distinct().count() == 40
    texts = rows(warc_body(records), "body")
    assert texts == sorted([("\r\n" + "é" * i,) for i in range(40) if i % 4 != 1], key=repr)
    assert rows(page_outcomes(pages_from_warc(records))) == [("ERROR_RECORD_READ", 10), ("PAGES", 30)]


def test_a_record_too_large_for_a_row_is_passed_over(spark, rows, tmp_path):
    path = tmp_path / "large.warc"
    size = (1 << 31) + 5
    with path.open("wb") as file:
        file.write(record(b"first"))
        file.write(record(b"", target="http://h/large", length=str(size))[:-4])
        file.seek(size, 1)
        file.write(b"\r\n\r\n" + record(b'<a href="/good">', target="http://h/after"))
    found = read_warc(spark, str(path)).orderBy("record_no").collect()
    assert [r.content_length for r in found] == [5, size, 16]
    assert [r.content is None for r in found] == [False, True, False]
    assert [r.content_error is None for r in found] == [True, False, True]
    assert [r.read_error for r in found] == [None] * 3
    assert rows(jobs.warc_vertices(spark, str(path)), "url") == [("h/after",), ("h/large",), ("h/x",)]
    assert jobs.warc_edges(spark, str(path)).count() == 1
    outcomes = dict(rows(link_outcomes(links(pages_from_warc(read_warc(spark, str(path)))))))
    assert outcomes == {"LINKS": 1, "ERROR_PAYLOAD_PARSE": 1}


def test_a_long_header_loses_nothing(read):
    long = record(b"b", extra=["X-Long: " + "h" * (65 << 20)])
    rows = read(record(b"a") + long + record(b"c"))
    assert contents(rows) == [b"a", b"b", b"c"]


def test_other_versions_and_files_without_records(read):
    rows = read(record(b"a").replace(b"WARC/1.0", b"WARC/1.1") + record(b"b"), "v.warc")
    assert contents(rows) == [b"a", b"b"]
    (row,) = read(b"HTTP/1.1 200 OK\r\n\r\nno archive", "n.warc")
    assert row.read_error is not None


def test_globs(spark, tmp_path):
    for folder in ("Disk1", "Disk2", "Disk9"):
        (tmp_path / folder / "CW_00").mkdir(parents=True)
        path = tmp_path / folder / "CW_00" / "0.warc.gz"
        path.write_bytes(gzip.compress(record(folder.encode())))
    found = read_warc(spark, f"{tmp_path}/Disk[12]/CW_??/*.warc.gz")
    assert sorted(contents(found.collect())) == [b"Disk1", b"Disk2"]


def test_file_names_need_no_escaping(read):
    for name in ("a b.warc.gz", "é%20+@.warc"):
        (row,) = read(record(b"x"), name)
        assert bytes(row.content) == b"x"


def test_page_outcomes_and_the_size_limit(spark, rows, tmp_path):
    limit = 4 * 1024 * 1024
    data = [
        record(b"ok"),
        record(b"x" * limit),
        record(b"x" * (limit + 1)),
        record(b"x", target=None),
        record(b"x" * (limit + 1), target=None),
        record(b"x", target="nonsense://h"),
        record(b"x", target="http://h/info", kind="warcinfo"),
        record(b"", length="bad"),
        record(b"lost"),
    ]
    path = str(tmp_path / "a.warc")
    (tmp_path / "a.warc").write_bytes(b"".join(data))
    expected = [
        ("ERROR_BAD_SOURCE_URL", 1),
        ("ERROR_MISSING_TARGET", 2),
        ("ERROR_PAGE_TOO_LARGE", 1),
        ("ERROR_RECORD_READ", 1),
        ("PAGES", 4),
    ]
    for options in ({}, {"content": False}, {"max_content_bytes": limit}):
        records = read_warc(spark, path, **options)
        assert rows(page_outcomes(pages_from_warc(records, max_bytes=limit))) == expected
    unlimited = dict(rows(page_outcomes(pages_from_warc(read_warc(spark, path)))))
    assert unlimited["PAGES"] == 5 and "ERROR_PAGE_TOO_LARGE" not in unlimited
    pages = pages_from_warc(read_warc(spark, path))
    assert rows(vertices(pages), "url") == [("h/info",), ("h/x",)]


def test_inventory_lists_every_file(spark, rows, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(b"1") + record(b"2", target=None))
    (tmp_path / "b.warc").write_bytes(b"no record\n")
    (tmp_path / "c.warc").write_bytes(record(b"1") + record(b"2", length="?"))
    (tmp_path / "d.warc").write_bytes(b"")
    paths = f"{tmp_path}/*.warc"
    found = corpus_inventory(spark, paths, read_warc(spark, paths, content=False))
    summary = [
        (r.warc_file[-6:], r.n_bytes, r.records, r.pages, r.errors)
        for r in found.orderBy("warc_file").collect()
    ]
    sizes = [(tmp_path / n).stat().st_size for n in ("a.warc", "b.warc", "c.warc")]
    assert summary == [
        ("a.warc", sizes[0], 2, 1, 1),
        ("b.warc", sizes[1], 0, 0, 1),
        ("c.warc", sizes[2], 1, 1, 1),
        ("d.warc", 0, 0, 0, 0),
    ]


def test_headers_and_body(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\nX: y\r\n\r\nhello"
    data = record(http, extra=["WARC-TREC-ID: t1"]) + record(b"first\nsecond\nthird") + record(b"one")
    (tmp_path / "a.warc").write_bytes(data)
    records = read_warc(spark, str(tmp_path / "a.warc"))
    bodies = [r.body for r in warc_body(records).orderBy("record_no").collect()]
    assert bodies == ["X: y\r\n\r\nhello", "second\nthird", "one"]
    head = warc_headers(records).orderBy("record_no").first()
    assert (head.target_uri, head.doc_id, head.content_length) == ("http://h/x", "t1", len(http))
    written = (
        "WARC/1.0\nWARC-Type: response\nWARC-Date: \nWARC-Record-ID: \n"
        "WARC-Target-URI: http://h/x\nWARC-TREC-ID: t1\nContent-Type: \n"
        f"Content-Length: {len(http)}\n"
    )
    assert head.total_length == len(written) + len(http)


def test_round_trip_gives_the_same_graph(spark, rows):
    import derived_inputs as derive

    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    paths = derive.write_warc(table, derive.scratch_path(spark, "trip"), records_per_file=7)
    records = read_warc(spark, paths)
    assert records.select("warc_file").distinct().count() == 8
    direct, archived = pages_from_table(table), pages_from_warc(records)
    assert rows(vertices(archived)) == rows(vertices(direct))
    assert rows(edges(links(archived))) == rows(edges(links(direct)))
    totals = corpus_totals(records, "metadata['WARC-Target-URI']", "content").first()
    assert tuple(totals) == (50, links(direct).count())
