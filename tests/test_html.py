import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from linkloom.functions.html import decode_entities, href_attributes, href_value

CASES = [
    (
        "<html><body><h1>Ferry times</h1><p>Boats leave hourly.</p>"
        '<a href="north.html">North</a> and <A  HREF="south.html" >South pier</A></body></html>',
        ["north.html", "south.html"],
    ),
    ("<A HREF=x>", ["x"]),
    ("<a href='q'>", ["q"]),
    ("<a href>", [""]),
    ("<a href=>", [""]),
    ('<a href="">', [""]),
    ("<a\nhref\n=\n13>", ["13"]),
    ('<a href="25"class=x>', ["25"]),
    ('<a href=x">', ['x"']),
    ("<a =href=1 href=24>", ["24"]),
    ("<a/href=23>", ["23"]),
    ("<a hrefx=1 xhref=2 href=22 title='>'>", ["22"]),
    ("<a href=8 href=9>", ["8"]),
    ("<a href=10", []),
    ("<a title='unclosed <a href=1>", []),
    ("<abbr href=1><area href=2>< a href=3></a href=4>", []),
    ("<a href=1><b></a><a href=2></b></a>", ["1", "2"]),
    ("<div x='<a href=11>'><a href=12/>", ["12/"]),
    ("<!-- <a href=1> --><a href=2>", ["2"]),
    ("<!-- x --!><a href=14><!--><a href=15><!---><a href=16>", ["14", "15", "16"]),
    ("<!-- <a href=1>", []),
    ("<!DOCTYPE html><?php <a href=17> ?>x<a href=18>", ["18"]),
    ("</ <a href=20>><a href=21>", ["21"]),
    ("<script>'<a href=3>'</script ><a href=4>", ["4"]),
    ("<SCRIPT><a href=1></scriptx></Script><a href=26>", ["26"]),
    ("<style><a href=1></style><a href=2>", ["2"]),
    ("<title><a href=5></title><a href=6>", ["6"]),
    ("<textarea><a href=5></textarea><a href=6>", ["6"]),
    ("<iframe><a href=5></iframe><a href=6>", ["6"]),
    ("<xmp><a href=5></xmp><a href=6>", ["6"]),
    ("<noembed><a href=5></noembed><noframes><a href=6></noframes><a href=7>", ["7"]),
    ("<iframe><a href=7>", []),
    ("<plaintext><a href=1>", []),
    ("HTTP/1.1 200 OK\r\nX: <3\r\n\r\n<a href=1>", ["1"]),
    ("", []),
    ("no markup", []),
]


def links(spark, pages):
    df = spark.createDataFrame([(i, page) for i, page in enumerate(pages)], "i INT, html BINARY")
    found = df.select("i", href_attributes(F.col("html").cast("string")).alias("found"))
    found = found.select("i", F.posexplode("found").alias("position", "attribute"))
    found = found.select("i", "position", href_value("attribute").alias("raw"))
    found = found.selectExpr("i", "position", f"{decode_entities('raw')} AS href")
    result = [[] for _ in pages]
    for i, _, href in sorted(map(tuple, found.collect())):
        result[i].append(href)
    return result


def test_cases(spark):
    found = links(spark, [html.encode() for html, _ in CASES])
    assert list(zip((html for html, _ in CASES), found)) == CASES


def test_agrees_with_another_parser_on_random_markup(spark):
    class Links(HTMLParser):
        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.found += [value or "" for name, value in attrs if name == "href"][:1]

    def expected(page):
        parser = Links()
        parser.found = []
        parser.feed(page)
        parser.close()
        return parser.found

    pieces = [
        "<a href=x>", "<a href='y z'>", '<A HREF="q&amp;r">', '<a class="c" href = u >',
        "<a name=n>", "<a href>", "</a>", "<p>", "<p title='<a href=t>'>", "<div\nid=3>",
        "<br/>", "text ", "a<b ", "1 < 2 ", "<!-- c <a href=c> -->", "<!DOCTYPE html>",
        "<script>s='<a href=s>'</script>", "<style>a{}</style>", "<?pi <a href=p?>", '"', "'",
        ">", "&lt;a href=e&gt;", '<img alt="a>b" src=z>', "<a\thref='&eacute;&#65;' x>",
        "<a data-href=no>", "<a href=1 href=2>",
    ]
    rnd = random.Random(5)
    pages = ["".join(rnd.choices(pieces, k=rnd.randint(1, 12))) for _ in range(1000)]
    found = links(spark, [page.encode() for page in pages])
    assert [(p, expected(p)) for p in pages] == list(zip(pages, found))


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a&amp;b", "a&b"),
        ("&amp;amp;", "&amp;"),
        ("&eacute;&eacute", "éé"),
        ("?a=1&copy=2&copyx", "?a=1&copy=2&copyx"),
        ("&copy;=&lt;&gt", "©=<>"),
        ("&notit;&bogus;", "&notit;&bogus;"),
        ("&frac12;z&there4;", "½z∴"),
        ("&#233;&#xE9;&#Xe9 &#233", "éé" + "é é"),
        ("&#x1F600;&#128512;", "😀😀"),
        ("&#0;&#xD800;&#1114112;&#99999999999;&#x110000;", "\ufffd" * 5),
        ("&#00000000065;&#x0000000041;", "AA"),
        ("&;&#;&#x;&#xg&", "&;&#;&#x;&#xg&"),
        ("&\"'", "&\"'"),
    ],
)
def test_character_references(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw STRING")
    assert df.selectExpr(decode_entities("raw")).first()[0] == expected


def test_bytes_that_are_not_utf8_are_replaced(spark):
    page = b"\xff<a href='\xc3\xa9\xfe\xe2\x82'>"
    assert links(spark, [page]) == [["é\ufffd\ufffd"]]


@pytest.mark.parametrize(
    "page, n_links",
    [
        ("<" * 4_000_000, 0),
        ("<b>" * 1_300_000, 0),
        ("<a " + "x=1 " * 1_000_000 + "href=z>", 1),
        ("<a " * 1_300_000, 0),
        ('<a x="1" ' * 400_000, 0),
        ('<a href="' + "x" * 4_000_000, 0),
        ("<!--" * 1_000_000, 0),
        ("<script>" + "</" * 2_000_000, 0),
        ("<a href=x>" * 400_000, 400_000),
    ],
    ids=range(9),
)
def test_large_pages_neither_overflow_nor_stall(spark, page, n_links):
    df = spark.createDataFrame([(page,)], "html STRING")
    assert df.select(F.size(href_attributes(F.col("html")))).first()[0] == n_links
