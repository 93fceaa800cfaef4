from pyspark.sql import functions as F

from linkloom.operators.graph import edges, vertices
from linkloom.operators.links import link_outcomes, links
from linkloom.operators.pages import page_outcomes, pages_from_table

PAGES = [
    ("http://H.com/a", "<a href=b>1</a><a href=b>2</a><a href=/a>me</a>"),
    ("https://h.com/a#x", "<a href='javascript:void(0)'><a href='mailto:j@b.org'>"),
    ("HTTP://h.com/b", "<a href='http://[zz]/'><a><a href='../../up?q#f'>"),
    ("nonsense:x", "<a href=c>"),
    (None, "<a href=c>"),
    ("http://h.com/null", None),
]


def table(spark):
    return spark.createDataFrame(PAGES, "url STRING, html STRING")


def test_pages_that_share_an_id_are_one_vertex(spark, rows):
    found = rows(vertices(pages_from_table(table(spark))), "url")
    assert found == [("h.com/a",), ("h.com/b",), ("h.com/null",)]


def test_links_in_page_order(spark):
    found = links(pages_from_table(table(spark).limit(3)))
    found = found.join(vertices(pages_from_table(table(spark))).select("id", F.col("url").alias("page")), F.col("src") == F.col("id"))
    result = [tuple(r) for r in found.select("page", "position", "href", "url", "outcome").collect()]
    bad = "ERROR_BAD_DEST_URL"
    assert sorted(result, key=str) == sorted(
        [
            ("h.com/a", 0, "b", "h.com/b", "OK"),
            ("h.com/a", 1, "b", "h.com/b", "OK"),
            ("h.com/a", 2, "/a", "h.com/a", "OK"),
            ("h.com/a", 0, "javascript:void(0)", None, bad),
            ("h.com/a", 1, "mailto:j@b.org", "j@b.org", "OK"),
            ("h.com/b", 0, "http://[zz]/", None, bad),
            ("h.com/b", 1, "../../up?q#f", "h.com/../../up?q", "OK"),
        ],
        key=str,
    )


def test_edges_are_a_bag_without_bad_links(spark):
    found = edges(links(pages_from_table(table(spark))))
    assert found.columns == ["src", "dst"]
    assert found.count() == 5
    assert found.where("src = dst").count() == 1
    assert found.distinct().count() == 4
    assert found.where("dst IS NULL").count() == 0


def test_counters_add_up(spark, rows):
    pages = pages_from_table(table(spark))
    counted = dict(rows(page_outcomes(pages)))
    assert counted == {"PAGES": 5, "ERROR_MISSING_TARGET": 1, "ERROR_BAD_SOURCE_URL": 1}
    good = pages.where("outcome = 'OK'").count()
    assert counted["PAGES"] == good + counted["ERROR_BAD_SOURCE_URL"]
    found = links(pages)
    of_links = dict(rows(link_outcomes(found)))
    assert of_links == {"LINKS": 5, "ERROR_BAD_DEST_URL": 2, "ERROR_PAYLOAD_PARSE": 1}
    assert sum(of_links.values()) == found.count()


def test_edges_need_no_shuffle_and_no_python(spark):
    found = edges(links(pages_from_table(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for operator in ("Exchange hashpartitioning", "EvalPython", "MapInArrow", "MapInPandas"):
        assert operator not in plan


def test_vertices_shuffle_merged_pages_once(spark):
    found = vertices(pages_from_table(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


def test_a_page_job_of_ones_own(spark, rows):
    def by_protocol(pages):
        return pages.where("outcome = 'OK'").groupBy("base.protocol").count()

    found = pages_from_table(table(spark)).transform(by_protocol)
    assert rows(found) == [("http", 3), ("https", 1)]


def test_vertices_read_no_html(spark):
    found = vertices(pages_from_table(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string>" in plan


def test_a_stored_length_stands_for_the_html(spark, rows):
    large = "<a href='/x'>" + "x" * (5 << 20)
    df = spark.createDataFrame([("http://h/a", large, 9), ("http://h/b", "<a href='/y'>", 7)], "url string, html string, n long")
    assert edges(links(pages_from_table(df))).count() == 2
    assert edges(links(pages_from_table(df, max_bytes=1000))).count() == 1
    assert edges(links(pages_from_table(df, max_bytes=8, length="n"))).count() == 1
