"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import entities, html, names, strings, tables
from docmill.operators import assemble, ebook, engines, notebook, plain, results, routing, sheets, slides, word
from docmill.options import ENGINES, ConvertOptions
from docmill.plans import sources as S
from docmill.plans import write
from docmill.plans.convert import convert_documents, convert_inputs, listed
from docmill.plans.storage import shared_folder, stored
from docmill.sources import archive, delimited, files, inputs, responses
from docmill.streaming.documents import stream_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Size cap and length limit that some rows of the tables exceed.
MAX_BYTES = 12_000
MAX_CHARS = 2_000
PIECE_CHARS = 10_000
BOM = chr(0xFEFF)
NAMES = (*routing.NATIVE, *routing.PLAIN, *routing.UNSUPPORTED, "dat", "parquet")
CONTENT_TYPES = ("text/HTML; charset=utf-8", "application/json", "text/csv", "application/octet-stream", "")
PAGE_KEY = r"page_id=(\d+)"


def query(fn):
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def _pick(values, number: Column) -> Column:
    """Value at ``number`` modulo the length of a fixed list."""
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def _by_id(df: DataFrame, *columns) -> DataFrame:
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), *columns)


def _text_job(name: str, make: Callable[[Column], Column], convert: Callable[[Column], Column]) -> None:
    """Query that builds one markup per document and converts it within its row."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        built = S.documents(spark, folder).select("doc_id", make(F.col("text")).alias("built"))
        return built.select("doc_id", convert(F.col("built")).alias("result"))

    QUERIES[name] = run


def _page_job(name: str, convert: Callable[[Column], Column], tail: str = "") -> None:
    """Query that runs one step over raw pages."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = S.pages(spark, folder).select("page_id", F.concat("html", F.lit(tail)).alias("html"))
        return found.select("page_id", convert(F.col("html")).alias("result"))

    QUERIES[name] = run


# Scans, sources, sinks


@query
def scan_documents(spark, folder):
    path = shared_folder(spark, "landing")
    S.landed(S.pages(spark, folder), "page_id", "html", path)
    found = files.scan_documents(spark, path, glob="*.txt", max_bytes=MAX_BYTES)
    return found.select(
        F.regexp_extract("path", PAGE_KEY, 1).cast("bigint").alias("page_id"),
        "length",
        "status",
        F.md5("content").alias("digest"),
    )


@query
def resolve_manifest(spark, folder):
    listed = S.pages(spark, folder).select(
        F.concat(F.lit("file:/corpus/d"), S.word(F.col("page_id") % 7), F.lit("/"), "page_id", F.lit(".html")).alias("path"),
        F.octet_length("html").cast("bigint").alias("length"),
    )
    key = F.col("doc_id")
    group = S.word(key % 7)
    wanted = S.documents(spark, folder).select(
        "doc_id",
        F.when(key % 12 == 0, F.concat(F.lit(" file:///corp%75s/d"), group, F.lit("/"), key, F.lit(".html ")))
        .when(key % 12 == 4, F.concat(F.lit("/corpus/x/y/../../d"), group, F.lit("/"), key, F.lit(".html")))
        .when(key % 4 == 0, F.concat(F.lit("/corpus//./d"), group, F.lit("/"), key, F.lit(".html")))
        .when(key % 4 == 1, F.concat(F.lit("/corpus/d"), group, F.lit("/"), key, F.lit(".html")))
        .when(key % 4 == 2, F.concat(F.lit("/corpus/d"), S.word(key % 9), F.lit("/")))
        .otherwise(F.concat(F.lit("/elsewhere/"), key))
        .alias("input"),
    )
    return inputs.resolve_manifest(wanted, listed).select("doc_id", "input", "length", "status", "error")


@query
def classify_input(spark, folder):
    key, url = F.col("page_id"), F.col("url")
    raw = S.pages(spark, folder).select(
        "page_id",
        F.when(key % 6 == 0, F.concat(F.lit(" \t"), url, F.lit("\n")))
        .when(key % 6 == 1, F.concat(F.lit("HTTPS"), F.substr(url, F.instr(url, ":"))))
        .when(key % 6 == 2, F.concat(F.lit("file:///data/a%20b+c/"), key, F.lit(".txt")))
        .when(key % 6 == 3, F.concat(F.lit("/data/"), key))
        .when(key % 6 == 4, F.lit(" \n "))
        .otherwise(F.concat(F.lit("File://host/"), key))
        .alias("input"),
    )
    both = [inputs.classify_input(raw, on).withColumn("allow_urls", F.lit(on)) for on in (True, False)]
    return both[0].unionByName(both[1]).select("page_id", "allow_urls", "input", "kind", "target", "status", "error")


@query
def scan_responses(spark, folder):
    key = F.col("page_id")
    crawl = S.pages(spark, folder).select(
        "page_id",
        "url",
        F.col("html").alias("body"),
        _pick(CONTENT_TYPES, key).alias("content_type"),
        F.when(key % 10 == 3, 404).otherwise(200).alias("http_status"),
        F.when(key % 10 == 4, F.lit(2 * MAX_BYTES)).alias("declared_length"),
    )
    return responses.scan_responses(crawl, MAX_BYTES).select(
        "page_id", "name", "content_type", "length", "status", "error", F.md5("content").alias("digest")
    )


@query
def parse_delimited(spark, folder):
    built = S.documents(spark, folder).select("doc_id", S.csv_text(F.col("text")).alias("text"))
    return delimited.parse_delimited(built, "text").select(
        "doc_id",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.size("cells").cast("bigint").alias("n_cells"),
        F.array_join("cells", "¦").alias("cells"),
    )


@query
def scan_delimited(spark, folder):
    key = F.col("c_custkey")
    line = F.concat(
        S.word(key),
        F.lit(',"'),
        F.col("c_name"),
        F.lit(', ""'),
        F.col("c_mktsegment"),
        F.when(key % 3 == 0, F.lit("\n\nend")).otherwise(F.lit("")),
        F.lit('"""'),
        F.when(key % 7 == 0, F.lit("")).when(key % 7 == 1, F.lit(",,")).when(key % 7 == 2, F.lit(',"z"w,'))
        .otherwise(F.concat(F.lit(",,x"), S.word(F.col("c_nationkey")))),
    )
    path = shared_folder(spark, "delimited")
    S.table(spark, folder, "customer").select(line.alias("line")).write.text(path)
    found = delimited.scan_delimited(spark, path)
    return found.select(
        F.get("cells", F.lit(0)).cast("bigint").alias("c_custkey"),
        F.size("cells").cast("bigint").alias("n_cells"),
        F.array_join("cells", "¦").alias("cells"),
    )


@query
def explode_archive(spark, folder):
    found = S.pages(spark, folder).withColumnRenamed("page_id", "doc_id")
    name = F.concat(F.lit("a/page "), "doc_id", F.lit(".html"))
    entries = F.array(
        S.entry(F.lit("skip.png"), F.lit("not inflated")),
        S.entry(name, F.col("html")),
        S.entry(F.lit("dir/"), F.lit("")),
        S.entry(F.lit("url.txt"), F.col("url")),
    )
    packed = S.packed(found, entries, F.col("doc_id") % 7 == 0)
    parts = archive.explode_archive(packed, r"\.(html|txt)$")
    return _by_id(
        parts, F.col("entry_idx").cast("bigint").alias("entry_idx"), "part", F.md5("content").alias("digest"), "status"
    )


@query
def write_markdown(spark, folder):
    docs = S.documents(spark, folder)
    built = docs.select(
        S.word(F.col("doc_id")).alias("doc_id"),
        F.concat(F.lit("d"), "doc_id", F.lit(".txt")).alias("input"),
        F.lit("file").alias("kind"),
        F.lit("text").alias("format"),
        F.lit(results.BUILTIN_LABEL).alias("engine"),
        F.lit("ok").alias("status"),
        plain.plain_markdown(F.col("text")).alias("markdown"),
    )
    path = shared_folder(spark, "markdown")
    done = write.write_markdown(results.result_rows(results.truncate_result(built, 2**31 - 1)), path)
    kept = spark.read.parquet(path).select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("digest"))
    return _by_id(
        done.join(kept, "doc_id"),
        "format",
        "chars",
        "truncated",
        F.col("output_path").isNotNull().alias("has_path"),
        F.col("markdown").isNull().alias("body_left_out"),
        F.startswith("notes", F.lit("All of the Markdown was written to ")).alias("has_hint"),
        "digest",
    )


# Routing


def _names(spark, folder):
    key = F.col("doc_id")
    name = (
        F.when(key % 11 == 0, F.concat(F.lit("Makefile"), key))
        .when(key % 11 == 1, F.concat(F.lit("C:\\dir.d\\."), _pick(NAMES, key)))
        .when(key % 11 == 2, F.concat(F.lit("https://x.test/a.b/f"), key, F.lit("."), _pick(NAMES, key), F.lit("?q=1.pdf#x.y")))
        .when(key % 11 == 3, F.concat(F.lit("dir.x/a."), key, F.lit(".")))
        .otherwise(F.concat(F.lit("d/f"), key, F.lit("."), F.upper(_pick(NAMES, key))))
    )
    return S.documents(spark, folder).select("doc_id", name.alias("name"), "text")


@query
def extension_of(spark, folder):
    return _names(spark, folder).select("doc_id", "name", names.extension_of(F.col("name")).alias("extension"))


@query
def route_format(spark, folder):
    nul = F.when(F.col("doc_id") % 5 == 0, F.lit("\0")).otherwise(F.lit(""))
    found = _names(spark, folder).select("doc_id", "name", F.concat(nul, "text").cast("binary").alias("content"))
    return routing.route_format(found).select("doc_id", "name", "extension", "format", "family", "status", "error")


@query
def supports_format(spark, folder):
    return _names(spark, folder).select("doc_id", "name", routing.supports_format(F.col("name")).alias("supported"))


@query
def route_response(spark, folder):
    found = S.pages(spark, folder).select(
        "page_id",
        names.response_name(F.col("url")).alias("name"),
        _pick(CONTENT_TYPES, F.col("page_id")).alias("content_type"),
        F.col("html").cast("binary").alias("content"),
    )
    return routing.route_response(found).select("page_id", "name", "content_type", "format", "family", "status")


@query
def is_binary(spark, folder):
    key, nul = F.col("doc_id"), F.lit("\0")
    content = (
        F.when(key % 5 == 0, F.col("text"))
        .when(key % 5 == 1, F.concat(nul, "text"))
        .when(key % 5 == 2, F.concat("text", nul))
        .when(key % 5 == 3, F.concat(F.repeat(F.lit("x"), 8191), nul, "text"))
        .otherwise(F.concat(F.repeat(F.lit("x"), 8192), nul, "text"))
    )
    found = S.documents(spark, folder).select("doc_id", content.cast("binary").alias("content"))
    return found.select("doc_id", routing.is_binary(F.col("content")).alias("binary"))


@query
def short_name(spark, folder):
    key = F.col("page_id")
    value = (
        F.when(key % 4 == 0, F.concat(F.lit("/data/x y/"), key, F.lit(".txt ")))
        .when(key % 4 == 1, F.concat(F.lit("https://host"), key, F.lit(".test?q")))
        .when(key % 4 == 2, F.concat(F.lit("dir/sub"), key, F.lit("//")))
        .otherwise(F.col("url"))
    )
    found = S.pages(spark, folder).select("page_id", value.alias("input"))
    return found.select("page_id", "input", names.short_name(F.col("input")).alias("name"))


# Text


@query
def decode_text(spark, folder):
    bad = F.concat(F.lit(bytearray(b"\xff")), F.col("text").cast("binary"), F.lit(bytearray(b"\xc3")))
    return S.documents(spark, folder).select("doc_id", strings.decode_text(bad).alias("result"))


@query
def strip_bom(spark, folder):
    marked = F.concat(F.repeat(F.lit(BOM), (F.col("doc_id") % 3).cast("int")), "text")
    return S.documents(spark, folder).select("doc_id", strings.strip_bom(marked).alias("result"))


def _noisy(text: Column) -> Column:
    broken = F.replace(F.replace(text, F.lit("\n"), F.lit(" \t\r\n\r\n\r\n")), F.lit(". "), F.lit(".\t \r"))
    return F.concat(F.lit(BOM + " \n"), broken, F.lit("\n\n" + chr(0xA0)))


_text_job("normalize_markdown", _noisy, strings.normalize_markdown)


def _referenced(text: Column) -> Column:
    t = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for char, reference in ((".", "&#46;"), (",", "&#x2c;"), (" ", "&#0032;"), ("é", "&Eacute;"), ("\n", "&#Xa;")):
        t = F.replace(t, F.lit(char), F.lit(reference))
    return F.concat(t, F.lit("&bogus;&#x110000;&NBSP;&mdash;&#128512;&amp;lt;"))


_text_job("decode_entities", _referenced, entities.decode_entities)
_page_job("strip_tags", strings.strip_tags)
_text_job("escape_cell", lambda t: F.concat(F.lit(" |"), t, F.lit("\r\n")), tables.escape_cell)


@query
def fence_text(spark, folder):
    ticks = F.repeat(F.lit("`"), (F.col("doc_id") % 6).cast("int"))
    built = S.documents(spark, folder).select("doc_id", F.concat(ticks, "text", F.lit(" \n")).alias("text"))
    return built.select("doc_id", strings.fence_text(F.col("text"), "txt").alias("result"))


_text_job("xml_to_text", S.xml_document, lambda t: plain.xml_to_text(t))


@query
def plain_to_markdown(spark, folder):
    nul = F.when(F.col("doc_id") % 50 == 0, F.lit("\0")).otherwise(F.lit(""))
    built = S.documents(spark, folder).select(
        "doc_id", F.concat(F.lit(BOM), nul, F.replace("text", F.lit("\n"), F.lit(" \r\n\n\n"))).cast("binary").alias("content")
    )
    return plain.plain_to_markdown(built).select("doc_id", "status", "markdown")


@query
def json_to_markdown(spark, folder):
    found = S.spread(S.table(spark, folder, "events").select("event_id", F.col("props").alias("text")), "event_id")
    return plain.json_to_markdown(found).select("event_id", "markdown")


# HTML


_page_job("html_drop_blocks", html.html_drop_blocks)
_page_job("html_breaks", html.html_breaks, "<HR><br\n/>")
_page_job("html_blocks", html.html_blocks)


@query
def html_to_markdown(spark, folder):
    return html.html_to_markdown(S.pages(spark, folder)).select("page_id", "markdown")


@query
def html_inline(spark, folder):
    tail = '<img src="x" alt="pic"><STRONG>s</STRONG><i a>it</i><code>c</code><a href=\'/e\'><br></a><a href=x>y</a>'
    found = S.pages(spark, folder).select("page_id", F.concat("html", F.lit(tail)).alias("html"))
    return found.select("page_id", strings.in_turn(F.col("html"), html.INLINE_PASSES).alias("result"))


@query
def html_headings(spark, folder):
    level = S.word(F.col("doc_id") % 6 + 1)
    lines = S.lines_of(F.col("text"))
    built = S.documents(spark, folder).select(
        "doc_id",
        F.concat(
            F.lit("<H"), level, F.lit(' id="x"><b>'), S.escaped(F.get(lines, F.lit(0))), F.lit("</b></H"), level, F.lit(">"),
            S.escaped(F.col("text")),
        ).alias("html"),
    )
    return built.select("doc_id", html.html_headings(F.col("html")).alias("result"))


_text_job("html_tables", S.html_table, html.html_tables)
_text_job(
    "html_pre",
    lambda t: F.concat(F.lit("a<PRE x>\n\n<code>"), S.escaped(t), F.lit("</code>\n</PRE>b")),
    html.html_pre,
)
_text_job(
    "html_blockquote",
    lambda t: F.concat(F.lit("<blockquote><p>"), S.escaped(t), F.lit(" </p></blockquote>")),
    html.html_blockquote,
)
_text_job("html_lists", S.html_list, html.html_lists)
_text_job(
    "inline_text",
    lambda t: F.concat(
        F.lit("\n <i>"), S.escaped(F.get(S.lines_of(t), F.lit(0))), F.lit('</i> <a href=" /u ">'), S.escaped(t), F.lit("</a>")
    ),
    html.inline_text,
)


# Tables and spreadsheets


@query
def markdown_table(spark, folder):
    items = S.spread(S.table(spark, folder, "lineitem"), "l_orderkey")
    cells = F.array(S.word(F.col("l_linenumber")), F.concat("l_returnflag", F.lit("|"), "l_linestatus"), S.word(F.col("l_partkey")))
    kept = (F.col("l_linenumber") % 3 + 1).cast("int")
    rows = items.select(
        "l_orderkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("row_no"),
        F.slice(cells, F.lit(1), kept).alias("cells"),
    )
    return assemble.markdown_table(rows, ["l_orderkey"])


@query
def markdown_pieces(spark, folder):
    cells = F.array(S.word(F.col("l_orderkey")), F.concat("l_linestatus", F.lit("|")), S.word(F.col("l_partkey")))
    rows = S.table(spark, folder, "lineitem").select(
        "l_returnflag",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_no"),
        F.slice(cells, F.lit(1), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("cells"),
    )
    found = assemble.markdown_pieces(rows, ["l_returnflag"], max_chars=PIECE_CHARS)
    return found.select(
        "l_returnflag",
        F.col("piece_no").cast("bigint").alias("piece_no"),
        F.length("markdown").cast("bigint").alias("chars"),
        F.md5(F.col("markdown").cast("binary")).alias("digest"),
    )


@query
def csv_to_markdown(spark, folder):
    built = S.documents(spark, folder).select("doc_id", S.csv_text(F.col("text")).alias("text"))
    return plain.delimited_to_markdown(built, ",").select("doc_id", "markdown")


@query
def tsv_to_markdown(spark, folder):
    built = S.documents(spark, folder).select("doc_id", S.csv_text(F.col("text"), "", "\t").alias("text"))
    return plain.delimited_to_markdown(built, "\t").select("doc_id", "markdown")


@query
def ordered_parts(spark, folder):
    key = F.col("doc_id")
    tail = F.repeat(F.lit("3"), F.element_at(F.array(F.lit(0), F.lit(18), F.lit(398)), (key % 3 + 1).cast("int")))
    digit = F.when(key % S.BUCKET == 0, F.lit("")).otherwise(F.concat(S.word((key * 7) % S.BUCKET * 4), tail))
    parts = S.documents(spark, folder).select(
        F.floor(key / S.BUCKET).cast("bigint").alias("doc_id"),
        (key % S.BUCKET).cast("bigint").alias("entry_idx"),
        F.concat(F.lit("p2/slide"), digit, F.lit(".xml")).alias("part"),
        F.col("text").alias("content"),
    )
    return archive.ordered_parts(parts, r"slide\d*\.xml$").select(
        "doc_id", "entry_idx", "part", F.col("part_no").cast("string").alias("part_no"), F.col("pos").cast("bigint").alias("pos")
    )


def _workbooks(spark, folder):
    return S.workbook_parts(S.documents(spark, folder))


@query
def shared_strings(spark, folder):
    return _by_id(sheets.shared_strings(_workbooks(spark, folder)), "idx", "value")


@query
def sheet_names(spark, folder):
    found = sheets.sheet_names(_workbooks(spark, folder))
    return _by_id(found, F.col("pos").cast("bigint").alias("pos"), "name")


@query
def column_index(spark, folder):
    key = F.col("p_partkey")
    letter = lambda n: F.char(65 + n % 26)
    letters = (
        F.when(key % 5 == 0, letter(key))
        .when(key % 5 == 1, F.concat(letter(F.floor(key / 26)), letter(key)))
        .when(key % 5 == 2, F.concat(letter(F.floor(key / 676)), letter(F.floor(key / 26)), letter(key)))
        .when(key % 5 == 3, F.lit(""))
        .otherwise(F.lit("AAAAAAAAAA"))
    )
    found = S.table(spark, folder, "part").select("p_partkey", letters.alias("letters"))
    return found.select("p_partkey", "letters", sheets.column_index(F.col("letters")).alias("col_no"))


_CELL = ("sheet_pos", "row_no", "col_no")


def _cell_columns():
    return [F.col(c).cast("bigint").alias(c) for c in _CELL]


@query
def sheet_cells(spark, folder):
    found = sheets.sheet_cells(_workbooks(spark, folder))
    return _by_id(found, *_cell_columns(), F.col("cell_pos").cast("bigint").alias("cell_pos"), "type", "raw")


@query
def resolve_cells(spark, folder):
    parts = _workbooks(spark, folder)
    found = sheets.resolve_cells(sheets.sheet_cells(parts), sheets.shared_strings(parts))
    return _by_id(found, *_cell_columns(), F.col("cell_pos").cast("bigint").alias("cell_pos"), "value")


@query
def sheet_to_markdown(spark, folder):
    parts = _workbooks(spark, folder)
    cells = sheets.resolve_cells(sheets.sheet_cells(parts), sheets.shared_strings(parts))
    found = sheets.sheet_to_markdown(cells)
    return _by_id(found, F.col("sheet_pos").cast("bigint").alias("sheet_pos"), "markdown")


@query
def xlsx_to_markdown(spark, folder):
    parts = stored(_workbooks(spark, folder), "workbooks")
    return _by_id(sheets.xlsx_to_markdown(parts), "status", "markdown")


# Other documents


@query
def docx_blocks(spark, folder):
    found = word.docx_blocks(S.word_parts(S.documents(spark, folder)))
    return _by_id(found, F.col("block_no").cast("bigint").alias("block_no"), "kind", "markdown")


def _line_job(name: str, make, convert) -> None:
    """Query over every line of every document."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lines = S.documents(spark, folder).select("doc_id", F.posexplode(S.lines_of(F.col("text"))).alias("line_no", "line"))
        built = lines.select(
            "doc_id", F.col("line_no").cast("bigint").alias("line_no"), make(F.col("line"), F.col("line_no")).alias("xml")
        )
        return built.select("doc_id", "line_no", convert(F.col("xml")).alias("result"))

    QUERIES[name] = run


_line_job("docx_paragraph", S.word_paragraph, word.docx_paragraph)
_line_job(
    "docx_run_text",
    lambda line, _: F.concat(S.word_runs(line), F.lit("<w:r><w:tab/><w:t>&amp;lt;</w:t><w:br/></w:r>")),
    word.docx_run_text,
)
_text_job("docx_table", S.word_table, word.docx_table)


@query
def docx_to_markdown(spark, folder):
    return _by_id(word.docx_to_markdown(S.word_parts(S.documents(spark, folder))), "status", "markdown")


@query
def pptx_to_markdown(spark, folder):
    return _by_id(slides.pptx_to_markdown(S.deck_parts(S.documents(spark, folder))), "status", "markdown")


@query
def epub_spine(spark, folder):
    found = ebook.epub_spine(S.book_parts(S.pages(spark, folder)))
    return _by_id(found, F.col("pos").cast("bigint").alias("pos"), "part")


@query
def epub_to_markdown(spark, folder):
    parts = stored(S.book_parts(S.pages(spark, folder)), "books")
    return _by_id(ebook.epub_to_markdown(parts), "status", "markdown")


@query
def notebook_to_markdown(spark, folder):
    found = notebook.notebook_to_markdown(S.notebooks(spark, folder))
    return found.select("conv_id", F.col("part").cast("bigint").alias("part"), "status", "markdown")


# Whole jobs, engines, results


@query
def convert_documents_query(spark, folder):
    docs, found = S.documents(spark, folder), S.pages(spark, folder)
    events = S.spread(S.table(spark, folder, "events"), "event_id")
    name = lambda prefix, key, ext: F.concat(F.lit(prefix), key, F.lit(ext))

    def rows(df, prefix, key, given, content, kind=F.lit("")):
        return df.select(
            name(prefix, key, "").alias("doc_id"), given.alias("input"), kind.alias("content_type"), content.cast("binary").alias("content")
        )

    def boxed(fmt, parts):
        """Real files of containers, made of their parts."""
        entry = S.entry(F.col("part"), F.col("content"))
        whole = parts.groupBy(*[c for c in parts.columns if c in ("near", "doc_id")]).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        return S.packed(whole, F.col("entries")).withColumn("ext", F.lit(fmt))

    near = S.nearby(docs)
    kinds = {"docx": S.word_parts(near), "xlsx": S.workbook_parts(near), "pptx": S.deck_parts(near), "epub": S.book_parts(found)}
    packed = stored(reduce(DataFrame.unionByName, [boxed(fmt, parts) for fmt, parts in kinds.items()]), "containers", by="ext")
    text = F.col("text")
    books = S.notebooks(spark, folder).withColumn("name", F.concat_ws("-", "conv_id", S.word(F.col("part"))))
    every = (
        rows(docs, "txt", "doc_id", name("d/", "doc_id", ".txt"), F.col("text"))
        .unionByName(rows(docs, "pdf", "doc_id", name("d/", "doc_id", ".pdf"), F.col("text")))
        .unionByName(rows(found, "web", "page_id", F.col("url"), F.col("html"), F.lit("text/html")))
        .unionByName(rows(events, "json", "event_id", name("e/", "event_id", ".JSON"), F.col("props")))
        .unionByName(rows(docs, "csv", "doc_id", name("d/", "doc_id", ".csv"), S.csv_text(text)))
        .unionByName(rows(docs, "tsv", "doc_id", name("d/", "doc_id", ".tsv"), S.csv_text(text, "", "\t")))
        .unionByName(rows(docs, "xml", "doc_id", name("d/", "doc_id", ".xml"), S.xml_document(text)))
        .unionByName(rows(books, "ipynb", "name", name("n/", "name", ".ipynb"), text))
        .unionByName(
            packed.select(
                F.concat("ext", "doc_id").alias("doc_id"),
                F.concat(F.lit("w/"), "doc_id", F.lit("."), "ext").alias("input"),
                F.lit("").alias("content_type"),
                "content",
            )
        )
    )
    return convert_documents(every, truncate=False).select("doc_id", "kind", "format", "status", "chars", "truncated", "markdown")



@query
def convert_inputs_query(spark, folder):
    path = shared_folder(spark, "landing")
    S.landed(S.pages(spark, folder), "page_id", "html", path)
    listing = listed(spark, path)
    named = listing.select(
        F.regexp_extract("path", PAGE_KEY, 1).cast("bigint").alias("page_id"), F.regexp_replace("path", r"\Afile:/+", "/").alias("path")
    )
    key, file = F.col("doc_id"), F.col("path")
    tail = F.regexp_extract(file, r"([^/]+/[^/]+/[^/]+)\z", 1)
    folder_of = F.regexp_extract(file, r"\A(.*/)[^/]+/[^/]+/[^/]+\z", 1)
    given = [
        F.concat(F.lit(" "), file, F.lit("\t")),
        F.when(F.startswith(file, F.lit("/")), F.concat(F.lit("file://"), F.replace(file, F.lit("="), F.lit("%3D")))).otherwise(file),
        F.concat(folder_of, F.lit("x/.././/"), tail),
        F.regexp_extract(file, r"\A(.*/)[^/]+\z", 1),
        F.lit(" "),
        F.concat(folder_of, F.lit("none/"), key),
        F.concat(F.lit("https://absent.example/"), key),
        tail,
    ]
    wanted = S.documents(spark, folder).select("doc_id", F.floor(key / 4).cast("bigint").alias("page_id")).join(named, "page_id", "left")
    manifest = wanted.select("doc_id", F.get(F.array(*given), (key % len(given)).cast("int")).alias("input"))
    done = convert_inputs(spark, manifest, path, ConvertOptions(max_bytes=MAX_BYTES), base=path, listing=listing)
    return done.select(F.col("doc_id").cast("bigint").alias("doc_id"), "kind", "status", F.when(F.col("status") == "ok", F.col("format")).alias("format"), "chars", "markdown")


def _candidates(spark, folder):
    """One to three engines per document; every 13th best result is blank."""
    key = F.col("doc_id")
    have = F.filter(
        F.array(*map(F.lit, ENGINES)), lambda e, i: (i >= key % 4) & ((i + key) % 3 != 0) | (e == "builtin")
    )
    rows = S.documents(spark, folder).select("doc_id", "text", F.explode(have).alias("engine"))
    return rows.select(
        "doc_id",
        "engine",
        F.when(key % 13 == 0, F.lit(" \n"))
        .otherwise(F.concat(F.lit(BOM), "engine", F.lit(": "), "text", F.lit("  \n\n\n\nend")))
        .alias("markdown"),
        F.concat(F.lit("Downloading x\n"), F.lit("warn "), key, F.lit(" \n")).alias("stderr"),
    )


@query
def select_engine(spark, folder):
    rows = _candidates(spark, folder)
    auto = engines.select_engine(rows).withColumn("choice", F.lit("auto"))
    forced = engines.select_engine(rows, "uvx").withColumn("choice", F.lit("uvx"))
    return auto.unionByName(forced).select("doc_id", "choice", "engine", "status", "markdown", "stderr", "error")


@query
def clean_external_markdown(spark, folder):
    return engines.clean_external_markdown(_candidates(spark, folder)).select(
        "doc_id", "engine", "status", "markdown", "stderr", "error"
    )


def _noise(text: Column) -> Column:
    lines = F.transform(
        S.lines_of(text),
        lambda line, i: F.concat(
            _pick([f" {n} x" if n[-1].isalpha() else n + "y" for n in engines.NOISE], i),
            F.lit("\r\n> "),
            line,
            F.lit(" \n \n"),
        ),
    )
    return S.joined(lines)


_text_job("filter_engine_noise", _noise, engines.filter_engine_noise)


def _results(spark, folder):
    """Result rows of all documents; every third went to a path."""
    key = F.col("doc_id")
    return S.documents(spark, folder).select(
        "doc_id",
        F.concat(F.lit("d"), key, F.lit(".txt")).alias("input"),
        _pick(("text", "html"), key).alias("format"),
        _pick(ENGINES, key).alias("engine"),
        F.lit("ok").alias("status"),
        F.col("text").alias("markdown"),
        F.when(key % 3 == 0, F.concat(F.lit("/out/"), key, F.lit(".md"))).alias("output_path"),
        (key % 2 == 0).alias("tried_better"),
        F.when(key % 5 != 0, F.repeat(F.lit("e"), (key % 700).cast("int"))).alias("stderr"),
    )


@query
def truncate_result(spark, folder):
    found = results.truncate_result(_results(spark, folder), MAX_CHARS)
    return found.select("doc_id", "output_path", "chars", "truncated", "markdown")


@query
def compose_notes(spark, folder):
    return results.compose_notes(_results(spark, folder)).select("doc_id", "notes")


@query
def render_result(spark, folder):
    found = results.compose_notes(results.truncate_result(_results(spark, folder), MAX_CHARS))
    shown = found.withColumn("markdown", F.when(F.col("output_path").isNull(), F.col("markdown")))
    return shown.select("doc_id", results.render_result(shown, MAX_CHARS).alias("result"))


@query
def conversion_report(spark, folder):
    found = results.truncate_result(_results(spark, folder), MAX_CHARS)
    status = F.when(F.col("doc_id") % 7 == 0, "empty_output").otherwise("ok")
    return results.conversion_report(found.withColumn("status", status)).select(
        "engine", "format", "status", F.col("level").cast("bigint").alias("level"), "documents", "chars", "truncated"
    )


@query
def stream_documents_query(spark, folder):
    base = shared_folder(spark, "stream")
    S.landed(S.pages(spark, folder), "page_id", "html", f"{base}/in")
    run = stream_documents(
        spark, f"{base}/in", f"{base}/out", f"{base}/state", glob="*.txt", max_files=1_000
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        F.regexp_extract("doc_id", PAGE_KEY, 1).cast("bigint").alias("page_id"), "format", "status", "chars", "markdown"
    )

