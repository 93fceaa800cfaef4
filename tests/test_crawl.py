import json

import pytest

import derived_inputs as derive
from linkloom.operators.crawl import crawl_edges, crawl_pages, crawl_vertices
from linkloom.sinks.crawl_graph import write_crawl_graph
from linkloom.sources.crawl_metadata import read_crawl_metadata

GOOD = {
    "disposition": "SUCCESS",
    "http_result": 200,
    "mime_type": "text/html",
    "content_len": 17,
    "failure_reason": "not shown",
    "content": {
        "type": "html-doc",
        "links": [
            {"type": "a", "href": "x"},
            {"type": "img", "href": "y.png"},
            {"type": "img"},
            {"type": "a", "href": "javascript:void(0)"},
            {"type": "a", "href": "x"},
        ],
    },
}


def changed(**members):
    return json.dumps({**GOOD, **members})


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


FAILED = {"disposition": "FAILURE", "failure_reason": "dns", "failure_detail": "gone"}


def parse(spark, *texts, url="http://h/p"):
    data = [(i, url, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(data, "i INT, url STRING, json STRING")
    return crawl_pages(df.drop("i"))


def vertex(spark, text, **options):
    """The fields after url and id of the only vertex, or None."""
    found = crawl_vertices(parse(spark, text, **options)).collect()
    return tuple(found[0])[2:] if found else None



def test_success(spark):
    found = crawl_vertices(parse(spark, json.dumps(GOOD))).first()
    assert found.url == "h/p"
    assert vertex(spark, json.dumps(GOOD)) == (
        True, "html-doc", "200", "17", "text/html", None, None,
    )


@pytest.mark.parametrize(
    "text, expected",
    [
        (json.dumps(FAILED), (False, None, None, None, None, "dns", "gone")),
        (json.dumps({**GOOD, **FAILED}), (False, None, None, None, None, "dns", "gone")),
        ("{}", (False,) + (None,) * 6),
        (without("disposition"), (False, None, None, None, None, "not shown", None)),
        (changed(disposition="failure"), (True, "html-doc", "200", "17", "text/html", None, None)),
        (changed(disposition=7), (True, "html-doc", "200", "17", "text/html", None, None)),
        (without("content"), (True, None, "200", "17", "text/html", None, None)),
        (changed(content={}), (True, None, "200", "17", "text/html", None, None)),
        (changed(http_result=True), (True, "html-doc", "true", "17", "text/html", None, None)),
        ("{disposition: 'SUCCESS' /* odd */}", (True,) + (None,) * 6),
        # Members that are not used may be anything.
        (json.dumps({**FAILED, "content": "x", "http_result": None}), (False, None, None, None, None, "dns", "gone")),
        (changed(failure_detail=None, other=[None]), (True, "html-doc", "200", "17", "text/html", None, None)),
        # Text that looks like an object or like a null is still text.
        (json.dumps({**FAILED, "failure_reason": "{x", "failure_detail": "a: null"}), (False, None, None, None, None, "{x", "a: null")),
    ],
)
def test_vertex_fields(spark, text, expected):
    assert vertex(spark, text) == expected


@pytest.mark.parametrize(
    "text",
    [
        "",
        "nonsense",
        "null",
        "[]",
        "[{}]",
        '{"disposition": "SUCCESS"',
        changed(disposition=None),
        changed(disposition={"a": 1}),
        changed(http_result=None),
        changed(mime_type={"a": 1}),
        changed(content=None),
        changed(content="text"),
        changed(content=[1]),
        changed(content={"type": None}),
        changed(content={"type": [1]}),
        changed(content={"links": None}),
        changed(content={"links": {"a": 1}}),
        changed(content={"links": ["x"]}),
        changed(content={"links": [None]}),
        changed(content={"links": [{"href": "x"}]}),
        changed(content={"links": [{"type": "a"}]}),
        changed(content={"links": [{"type": None, "href": "x"}]}),
        json.dumps({**FAILED, "failure_detail": None}),
        json.dumps({**FAILED, "failure_reason": ["x", "y"]}),
    ],
)
def test_bad_json_sets_only_its_row_aside(spark, text):
    pages = parse(spark, json.dumps(GOOD), text, json.dumps(FAILED))
    outcomes = sorted(r.outcome for r in pages.select("outcome").collect())
    assert outcomes == ["ERROR_JSON", "OK", "OK"]
    assert crawl_vertices(pages).count() == 2
    assert crawl_edges(pages).count() == 2


def test_edges(spark, rows):
    found = rows(crawl_edges(parse(spark, json.dumps(GOOD), json.dumps(FAILED))))
    assert len(found) == 2 and found[0] == found[1]


def test_bad_page_url_comes_first(spark):
    pages = parse(spark, "nonsense", json.dumps(GOOD), url="nonsense")
    assert {r.outcome for r in pages.collect()} == {"ERROR_BAD_SOURCE_URL"}
    assert crawl_vertices(pages).count() == crawl_edges(pages).count() == 0


def test_sequence_files_and_both_text_tables(spark, tmp_path):
    data = [("http://h/p", json.dumps(GOOD)), ("http://h/é", json.dumps(FAILED)), ("bad", "{}")]
    meta = spark.createDataFrame(data, "url STRING, json STRING")
    paths = derive.write_sequence_file(meta, str(tmp_path / "in"))
    pages = crawl_pages(read_crawl_metadata(spark, paths))
    write_crawl_graph(pages, str(tmp_path / "out"))

    def lines(table):
        found = spark.read.text(f"{tmp_path}/out/table={table}").collect()
        return sorted(r.value for r in found)

    ids = {r.url: r.id for r in crawl_vertices(pages).collect()}
    page = ids["h/p"]
    assert lines("vertexes.out") == [
        f"h/p\t{page}\ttrue\thtml-doc\t200\t17\ttext/html\tnull\tnull",
        f"h/é\t{ids['h/é']}\tfalse\tnull\tnull\tnull\tnull\tdns\tgone",
    ]
    assert lines("edges.out") == sorted(f"{r.src}\t{r.dst}" for r in crawl_edges(pages).collect())
    assert len(lines("edges.out")) == 2


def test_metadata_stays_in_the_jvm(spark, tmp_path):
    rows = spark.createDataFrame([("http://h/p", json.dumps(GOOD))], "url string, json string")
    found = read_crawl_metadata(spark, derive.write_sequence_file(rows, str(tmp_path / "seq")))
    assert [tuple(r) for r in found.collect()] == [("http://h/p", json.dumps(GOOD))]
    classes, todo = set(), [found._jdf.queryExecution().toRdd()]
    while todo:
        rdd = todo.pop()
        classes.add(rdd.getClass().getSimpleName())
        deps = rdd.dependencies()
        todo.extend(deps.apply(i).rdd() for i in range(deps.size()))
    assert "HadoopRDD" in classes
    assert not any("Python" in name for name in classes), classes
