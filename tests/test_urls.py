import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions.urls import url_id, url_text, with_url_parts

PAGE = "http://Ex.com/a/b/c.html?q=1#f"
HARBOUR = "http://docs.harbour-lane.test:9090/guide?topic#anchor"

# spec, base, normalised URL (None: malformed)
GOLDEN = [
    ("https://tide.example.org/charts.php?week#top", None, "tide.example.org/charts.php?week"),
    ("notes.txt?v#x", HARBOUR, "docs.harbour-lane.test:9090/notes.txt?v"),
    ("#only", HARBOUR, "docs.harbour-lane.test:9090/guide?topic"),
    ("http://quay.example.net", None, "quay.example.net"),
    ("http://quay.example.net/menu.htm", None, "quay.example.net/menu.htm"),
    ("", PAGE, "ex.com/a/b/c.html?q=1"),
    ("  x.html  ", PAGE, "ex.com/a/b/x.html"),
    ("../d", PAGE, "ex.com/a/d"),
    ("../../../d", PAGE, "ex.com/../d"),
    ("./e/./f", PAGE, "ex.com/a/b/e/f"),
    ("foo/.", PAGE, "ex.com/a/b/foo/"),
    ("foo/..", PAGE, "ex.com/a/b/"),
    ("..", PAGE, "ex.com/a/"),
    ("/root/../z", PAGE, "ex.com/root/../z"),
    ("http://h/a/../b/./c", None, "h/a/../b/./c"),
    ("//OTHER.com/p", PAGE, "other.com/p"),
    ("?k=v", PAGE, "ex.com/a/b/?k=v"),
    ("#frag", PAGE, "ex.com/a/b/c.html?q=1"),
    ("http://h:80/x", PAGE, "h:80/x"),
    ("http://h:/x", PAGE, "h/x"),
    ("http://u:p@H.com/x", PAGE, "h.com/x"),
    ("http:rel.html", PAGE, "ex.com/a/b/rel.html"),
    ("https:rel.html", PAGE, "rel.html"),
    ("http:///p", PAGE, "/p"),
    ("HTTP://H.COM/A", PAGE, "h.com/A"),
    ("a b.html", PAGE, "ex.com/a/b/a b.html"),
    ("é.html", PAGE, "ex.com/a/b/é.html"),
    ("http://h/%41", PAGE, "h/%41"),
    ("a/b:c", PAGE, "ex.com/a/b/a/b:c"),
    ("http://h?x=1", None, "h?x=1"),
    ("http://h/p#a#b", None, "h/p"),
    ("http://h/p?a#b?c", None, "h/p?a"),
    ("rel", "http://h", "h/rel"),
    ("?q", "http://h", "h/?q"),
    ("mailto:a@b.com", PAGE, "a@b.com"),
    ("ftp://h/f", PAGE, "h/f"),
    ("file:///etc/x", PAGE, "/etc/x"),
    ("url:http://h/q", PAGE, "h/q"),
    ("http://[::1]:8/x", PAGE, "[::1]:8/x"),
    ("http://h:080/x", None, "h:80/x"),
    ("jar:http://h/x.jar!/a", PAGE, None),
    ("javascript:void(0)", PAGE, None),
    ("tel:123", PAGE, None),
    ("data:text/html,x", PAGE, None),
    ("x:y", PAGE, None),
    ("http://h:abc/x", PAGE, None),
    ("http://h:-2/x", PAGE, None),
    ("http://h:99999999999/x", PAGE, None),
    ("http://[zz]/x", PAGE, None),
    ("mailto:", PAGE, None),
    ("rel", None, None),
    ("", None, None),
    (None, None, None),
]


def resolve(spark, cases):
    """The normalised URL of each (spec, base), in order."""
    data = [(i, spec, base) for i, (spec, base) in enumerate(cases)]
    df = spark.createDataFrame(data, "i INT, spec STRING, base_url STRING")
    alone = with_url_parts(df.where("base_url IS NULL"), "spec", "parts")
    based = with_url_parts(df.where("base_url IS NOT NULL"), "base_url", "base")
    based = with_url_parts(based, "spec", "parts", base="base")
    columns = ("i", url_text(F.col("parts")).alias("url"))
    found = alone.select(*columns).union(based.select(*columns)).collect()
    return [url for _, url in sorted(map(tuple, found))]


def test_golden_vectors(spark):
    found = resolve(spark, [(spec, base) for spec, base, _ in GOLDEN])
    assert found == [expected for _, _, expected in GOLDEN]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("A", "bc1M4j2I4u6V"),
        ("tide.example.org/charts.php?week", "LwfrGn9wAv5n"),
        ("tide.example.org/é", "e2pSQOVc+zvp"),
    ],
)
def test_ids(spark, url, expected):
    df = spark.createDataFrame([(url,)], "url STRING")
    assert df.select(url_id(F.col("url"))).first()[0] == expected


def test_filters_on_the_result_do_not_copy_the_steps(spark):
    df = spark.range(1).select(F.lit(PAGE).alias("spec"), F.lit(HARBOUR).alias("page"))
    df = with_url_parts(with_url_parts(df, "page", "base"), "spec", "parts", base="base")
    found = df.where(url_text(F.col("parts")).isNotNull()).where("parts.host <> ''")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 100_000


def test_agrees_with_the_url_class_of_the_jvm(spark):
    """Random addresses against the parser whose rules these are."""
    pieces = (
        "http: https: HTTP: ftp: file: mailto: url: javascript: x é / // /// //// ? ?? # . .. "
        "/. /.. ../ ./ h.com H.Com :80 : @ u:p@ [::1] [zz] :+8 :-1 :-2 :080 q=1 & %41 ... ..x a"
    ).split() + [" ", "a b"]
    bases = [
        None,
        PAGE,
        HARBOUR,
        "http://h",
        "file:///x/y",
        "mailto:a@b",
        "https:rel/x?y",
        "http://a@b@c:9/x",
        "ftp://h:21/../../a/..//b",
        "http://[::1]:8/",
        "http:///a/b/",
    ]
    rnd = random.Random(7)
    cases = [
        ("".join(rnd.choices(pieces, k=rnd.randint(0, 7))), rnd.choice(bases)) for _ in range(600)
    ]
    java_url = spark._jvm.java.net.URL

    def expected(spec, base):
        try:
            url = java_url(spec) if base is None else java_url(java_url(base), spec)
        except Exception:
            return None
        port = url.getPort()
        return url.getHost().lower() + (f":{port}" if port != -1 else "") + url.getFile()

    found = resolve(spark, cases)
    differing = [
        (case, want, got)
        for case, got in zip(cases, found)
        if (want := expected(*case)) != got
    ]
    assert differing == []
