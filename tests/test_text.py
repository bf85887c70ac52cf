"""Text and HTML functions, one job per table of cases."""

import pytest
from pyspark.sql import functions as F

from docmill.functions import entities, html, names, strings, tables
from docmill.operators import engines, plain, routing, sheets
from docmill.sources.delimited import parse_delimited
from tests.make import BOM

NBSP, REPLACED = chr(0xA0), chr(0xFFFD)

HTML = {
    "decoded before the last strip": ("<h1>a &lt;b&gt; c</h1>&amp;lt;", "# a  c\n\n&lt;"),
    "heading decodes twice": ("<h2>&amp;lt;</h2>", "## <"),
    "nested list ends at the first close": ("<ul><li>a<ul><li>b</li></ul></li></ul>", "- ab"),
    "ordered list loses numbers": ("<ol><li>x</li><li>y</li></ol>", "- x\n- y"),
    "nested table ends at the first close": (
        "<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table>",
        "| ab |\n| --- |",
    ),
    "label drops markup": ('<a href=" /u "><b>x</b></a>', "[x](/u)"),
    "image-only link vanishes": ('<a href="x"><img src="y" alt="z"></a>.', "."),
    "unquoted href": ("<a href=x>y</a>", "y"),
    "image without alt": ('a<img src="x">b<IMG alt = "c">', "ab![c]()"),
    "less than is a tag": ("a < b > c", "a  c"),
    "header is not head": ("<header>h</header><head><title>t</title></head>b", "h\n\nb"),
    "tag names end at a word": ("<presentation>x</presentation><bold>y</bold>", "xy"),
    "accented name": ("<pé>x", "x"),
    "pre keeps lines": ("<pre>\n\n<b>x</b>\n\n\n  y \n</pre>", "```\nx\n\n  y\n```"),
    "quote": ("<blockquote> a\n b </blockquote>", "> a\n> b"),
    "unclosed bold": ("<b>x <strong>y</strong> <i>z", "**x y** z".replace("**x y**", "x **y**")),
    "emphasis": ("<em>a</em><I>b</I><code>c</code>", "*a**b*`c`"),
    "mixed pair does not match": ("<b>x</strong>", "x"),
    "comment": ("a<!-- <p> -->b<!-- open", "ab<!-- open"),
    "script": ("<SCRIPT>var a='</p>'</script >x</SCRIPT>y", "y"),
    "rule and break": ("a<hr/>b<br>c", "a\n\n---\n\nb\nc"),
    "ragged table": ("<table><tr></tr><tr><td>a|b<td>c</td></tr><tr><th>d</th><td>e</td></tr></table>", "| a\\|bc |  |\n| --- | --- |\n| d | e |"),
    "empty table": ("x<table></table>y", "xy"),
    "blocks": ("<p>a<div>b</div><figcaption>c", "a\n\nb\n\nc"),
    "nothing": ("", ""),
}
ENTITIES = {
    "&#X6d;&#x4E;&#111;": "mNo",
    "&#12ab;": "\f",
    "&#ab;&#x;&;": "&#ab;&#x;&;",
    "&#00000000065;&#x0000000041;": "AA",
    "&#xD800;&#x110000;&#99999999999;": REPLACED + "&#x110000;&#99999999999;",
    "&AMP;lt;&nope;&nbsp;|": "&lt;&nope; |",
    "&#128512;&#233;&#0;": "\U0001f600é\0",
    "&szlig;&Eacute;&hellip;": "ßé…",
    "plain": "plain",
}
NORMAL = {
    "a \t\r\nb\rc": "a\nb\nc",
    "a\n\n\n\nb": "a\n\nb",
    NBSP + BOM + " a " + NBSP: "a",
    "a  b": "a  b",
    "a \x85b": "a \x85b",
    "a \u2028b": "a\u2028b",
    " \n ": "",
}
EXTENSIONS = {
    "a.TXT": "txt",
    "a#b.txt": "",
    "x/y.tar.gz?q=1.pdf": "gz",
    ".env": "",
    "d.x/.env": "",
    "Makefile": "",
    "C:\\d.e\\f": "",
    "C:\\d\\f.Md": "md",
    "a.": "",
    "..x": "x",
}


def run(spark, cases, convert):
    df = spark.createDataFrame(list(enumerate(cases)), "id int, t string")
    return [r.x for r in df.select("id", convert(F.col("t")).alias("x")).orderBy("id").collect()]


def test_html(spark):
    got = run(spark, [source for source, _ in HTML.values()], html.html_markdown)
    assert dict(zip(HTML, got)) == {name: want for name, (_, want) in HTML.items()}


@pytest.mark.parametrize(
    "cases, convert",
    [
        (ENTITIES, entities.decode_entities),
        (NORMAL, strings.normalize_markdown),
        (EXTENSIONS, names.extension_of),
        ({"a|b\r\nc ": "a\\|b c", "x\ry": "x\ry"}, tables.escape_cell),
        ({"x `` y \n": "```j\nx `` y\n```", "````": "`````j\n````\n`````"}, lambda t: strings.fence_text(t, "j")),
        ({"/a b.txt ": "a b.txt", "https://h/x/?q": "x", "http://h": "http://h", "a/b//": "b", " ": ""}, names.short_name),
        ({"https://h/a/b.html?x#y": "b.html", "http://h/d/": "index.html", "http://h?x=/y": "index.html"}, names.response_name),
        ({"<?x?><a>1</a><!-- b -->\n <c>&#x32;</c><d/>": "1\n2", "<![CDATA[x]]>y<![CDATA[a>b]]>": "y\nb]]>"}, plain.xml_to_text),
        ({"  Downloading x\nreal  \n\nnote: y\n note:z\nDownload": "real\n note:z\nDownload".strip()}, engines.filter_engine_noise),
        ({"A": 0, "Z": 25, "AA": 26, "XFD": 16383, "": -1, "AAAAAAAA": None}, sheets.column_index),
        ({"a.docx": True, "a.CSV": True, "a.pdf": False, "a.png": False, "a": False}, routing.supports_format),
    ],
)
def test_functions(spark, cases, convert):
    assert dict(zip(cases, run(spark, list(cases), convert))) == cases


def test_json(spark):
    cases = {
        '{"a":[1,2]}': '{\n  "a": [\n    1,\n    2\n  ]\n}',
        "[]": "[]",
        "NaN": "NaN",
        "1e999": "null",
        "9007199254740993": "9007199254740992",
        "[0.1,1E+2,-1.5e-8,123456789012345678901234]": "[\n  0.1,\n  100,\n  -1.5e-8,\n  1.2345678901234569e+23\n]",
        '{"b":1,"2":2,"01":3,"1":4,"b":5}': '{\n  "1": 4,\n  "2": 2,\n  "b": 5,\n  "01": 3\n}',
        '"\\u2028\\u0001\\/"': '"\u2028\\u0001/"',
        "[" * 5000: "[" * 5000,
        "01": "01",
    }
    assert dict(zip(cases, run(spark, list(cases), plain.pretty_json))) == cases


def test_delimited(spark):
    text = {
        1: 'oak,elm\r\n"bark\nleaf",ash\r\n',
        2: 'x"y,"z"w,"",""""\rq\n\n \n,\n"open,\n',
        3: BOM + "\t\n" + NBSP + "\n" + "x" * 200_000,
        4: "",
    }
    df = spark.createDataFrame(list(text.items()), "doc_id int, t string")
    got = {(r.doc_id, r.row_no): r.cells for r in parse_delimited(df, "t").collect()}
    assert got == {
        (1, 0): ["oak", "elm"],
        (1, 1): ["bark\nleaf", "ash"],
        (2, 0): ['x"y', "zw", "", '"'],
        (2, 1): ["q"],
        (2, 2): ["", ""],
        (2, 3): ["open,\n"],
        (3, 0): ["x" * 200_000],
    }


def test_binary_probe(spark):
    df = spark.createDataFrame(
        [(1, bytearray(b"x" * 8191 + b"\0")), (2, bytearray(b"x" * 8192 + b"\0")), (3, bytearray(b""))],
        "id int, b binary",
    )
    got = {r.id: r.x for r in df.select("id", routing.is_binary(F.col("b")).alias("x")).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_long_unclosed_markup_is_linear(spark):
    source = "<li><b>" * 60_000 + "<a href='x'>" * 20_000
    assert run(spark, [source], html.html_markdown) == [""]


@pytest.mark.parametrize(
    "source",
    ["<svg>" * 100_000 + "</style>", "<td>" * 100_000 + "</th>", "<table>" + "<tr><td>" * 50_000 + "</table>", "<b>" * 100_000 + "</strong>", "<li><b>" * 50_000 + "</i>", "<em>" * 100_000 + "</i>", "<a href='x'>" * 50_000],
)
def test_unclosed_tags_of_other_names_are_linear(spark, source):
    assert run(spark, [source], html.html_markdown) == [""]


def test_unclosed_tags_give_the_same_as_few(spark):
    parts = ["<b>x</b> <strong>y", "<svg>q</svg>r<svg>s", "<td>t<tr>u", "<li>v</li><li>w", "<a href='k'>z</a><a href='k'>l"]
    filler = "<i></i>" * 600
    few, many = run(spark, ["".join(parts), filler + "".join(parts)], html.html_markdown)
    assert many.replace("*", "") == few.replace("*", "") and "**x**" in many and "**x**" in few


def test_filters_over_converted_columns_stay_small(spark):
    """Moving a filter below the passes must not multiply them."""
    df = spark.createDataFrame([(1, "<h1>x</h1>"), (2, "")], "id int, html string")
    done = html.html_to_markdown(df).where("markdown <> ''").where("length(markdown) > 1")
    assert [r.markdown for r in done.collect()] == ["# x"]
    assert len(done._jdf.queryExecution().optimizedPlan().toString()) < 400_000
