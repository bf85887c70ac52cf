"""Documents of every format, derived from the tables a query is given.

A document is built within one row where possible. Where several rows make one document
they share a bucket of a unique key, so its size is bounded whatever the tables hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = 10
#: Folders below a landing directory. Spark starts a task for each folder of a level, up to 10,000, to list it.
LANDING_FOLDERS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Scan rows over all cores when the files give fewer tasks than cores.

    Text work costs far more than moving small tables. A large table has many more
    splits than cores and is left as it is, so at scale nothing is shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"), "page_id")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def escaped(text: Column) -> Column:
    t = F.replace(text, F.lit("&"), F.lit("&amp;"))
    t = F.replace(t, F.lit("<"), F.lit("&lt;"))
    t = F.replace(t, F.lit(">"), F.lit("&gt;"))
    return F.replace(t, F.lit('"'), F.lit("&quot;"))


def joined(pieces: Column, between: str = "") -> Column:
    return F.array_join(pieces, between)


def word(value: Column) -> Column:
    return value.cast("string")


def csv_text(text: Column, quote: str = '"', delimiter: str = ",") -> Column:
    """Line number and line as a record; every third one has a third cell, blanks in between."""

    def record(line: Column, i: Column) -> Column:
        cell = F.replace(line, F.lit('"'), F.lit('""')) if quote else F.replace(line, F.lit("\t"), F.lit(" "))
        return F.concat(
            word(i),
            F.lit(delimiter + quote),
            cell,
            F.lit(quote),
            F.when(i % 3 == 0, F.lit(delimiter + "extra")).otherwise(F.lit("")),
            F.when(i % 5 == 0, F.lit("\r\n  ")).otherwise(F.lit("")),
        )

    return joined(F.transform(lines_of(text), record), "\r\n")


def xml_document(text: Column) -> Column:
    rows = F.transform(
        lines_of(text), lambda line, i: F.concat(F.lit('<l n="'), word(i), F.lit('">'), escaped(line), F.lit(" </l>"))
    )
    return F.concat(F.lit('<?xml version="1.0"?>\n<d><!-- <l>no</l> -->'), joined(rows), F.lit("</d>"))


def html_table(text: Column) -> Column:
    """Line number and line; the first row uses header cells, every third has one cell."""

    def row(line: Column, i: Column) -> Column:
        tag = F.when(i == 0, F.lit("th")).otherwise(F.lit("td"))
        cell = lambda body: F.concat(F.lit("<"), tag, F.lit(" class='c'>"), body, F.lit("</"), tag, F.lit(">"))
        second = F.when(i % 3 != 2, cell(F.concat(F.lit(" <b>"), escaped(line), F.lit("</b>\n")))).otherwise(F.lit(""))
        return F.concat(F.lit("<TR>"), cell(word(i)), second, F.lit("</TR><tr></tr>"))

    return F.concat(
        F.lit('x<TABLE border="1">'), joined(F.transform(lines_of(text), row)), F.lit("</TABLE>y<table></table>")
    )


def html_list(text: Column) -> Column:
    """Every second line is a link."""

    def item(line: Column, i: Column) -> Column:
        plain = escaped(line)
        link = F.concat(F.lit('<a class="k" href="/'), word(i), F.lit('">'), plain, F.lit("</a>"))
        return F.concat(F.lit("<li>"), F.when(i % 2 == 1, link).otherwise(plain), F.lit("</li>"))

    return F.concat(F.lit("<ul>"), joined(F.transform(lines_of(text), item)), F.lit("</UL>"))


# Spreadsheets: one workbook per document. Sheet 1 holds the lines.


def shared_part(text: Column) -> Column:
    """Lines as shared strings, every second one as two runs."""

    def item(line: Column, i: Column) -> Column:
        run = lambda t: F.concat(F.lit('<t xml:space="preserve">'), escaped(t), F.lit("</t>"))
        halves = F.concat(
            F.lit("<r>"), run(F.substring(line, 1, 7)), F.lit("</r><r>"), run(F.substr(line, F.lit(8))), F.lit("</r>")
        )
        return F.concat(F.lit("<si>"), F.when(i % 2 == 1, halves).otherwise(run(line)), F.lit("</si>"))

    return F.concat(F.lit("<sst>"), joined(F.transform(lines_of(text), item)), F.lit("</sst>"))


def sheet_part(text: Column) -> Column:
    """Rows of number, shared line, gap, inline text; then noise a reader must drop.

    The number cell comes twice (the later one counts) and after the inline cell. Every
    fourth row is followed by an empty one; blank rows and a cell beyond the last column
    end the sheet.
    """

    def row(line: Column, i: Column) -> Column:
        at = word(i + 1)
        number = lambda v: F.concat(F.lit('<c r="A'), at, F.lit('"><v>'), v, F.lit("</v></c>"))
        return F.concat(
            F.lit('<row r="'),
            at,
            F.lit('"><c r="D'),
            at,
            F.lit('" t="inlineStr"><is><t>'),
            escaped(F.substring(line, 1, 5)),
            F.lit("</t></is></c>"),
            number(F.lit("0")),
            number(word(i + 1)),
            F.lit('<c r="B'),
            at,
            F.lit('" t="s"><v>'),
            word(i),
            F.lit("</v></c></row>"),
            F.when(i % 4 == 3, F.lit("<row></row>")).otherwise(F.lit("")),
        )

    tail = '<row><c r="Z1"><v> </v></c><c r="XFE1"><v>far</v></c></row><row><c r="A1" t="s"><v>999999999</v></c></row>'
    rows = joined(F.transform(lines_of(text), row))
    return F.concat(F.lit("<worksheet><sheetData>"), rows, F.lit(tail + "</sheetData></worksheet>"))


def workbook_part(text: Column) -> Column:
    first = F.get(lines_of(text), F.lit(0))
    return F.concat(F.lit('<workbook><sheets><sheet name="'), escaped(first), F.lit('" sheetId="1"/></sheets></workbook>'))


def as_parts(df: DataFrame, key: Column, *parts: tuple[Column, Column]) -> DataFrame:
    """One row per ``(name, text)`` of every document; a column ``near`` is kept."""
    entries = F.array(*[F.struct(n.alias("part"), t.cast("binary").alias("content")) for n, t in parts])
    kept = [c for c in df.columns if c == "near"]
    return df.select(*kept, word(key).alias("doc_id"), F.posexplode(entries).alias("entry_idx", "entry")).select(
        *kept,
        "doc_id",
        "entry_idx",
        "entry.part",
        "entry.content",
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


def workbook_parts(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return as_parts(
        docs,
        F.col("doc_id"),
        (F.lit("xl/workbook.xml"), workbook_part(text)),
        (F.lit("xl/worksheets/sheet10.xml"), sheet_part(text)),
        (F.lit("xl/worksheets/sheet2.xml"), F.lit("<worksheet><sheetData><row></row></sheetData></worksheet>")),
        (F.lit("xl/sharedStrings.xml"), shared_part(text)),
    )


# Word-processor documents: heading, paragraphs, a bullet every fourth line, one table.


def word_runs(line: Column) -> Column:
    run = lambda t: F.concat(F.lit('<w:r><w:t xml:space="preserve">'), escaped(t), F.lit("</w:t></w:r>"))
    return F.concat(run(F.substring(line, 1, 9)), run(F.substr(line, F.lit(10))))


def word_paragraph(line: Column, i: Column) -> Column:
    props = (
        F.when(i == 0, F.lit('<w:pPr><w:pStyle w:val="Heading1"/></w:pPr>'))
        .when(i % 4 == 1, F.lit('<w:pPr><w:numPr><w:ilvl w:val="0"/></w:numPr></w:pPr>'))
        .otherwise(F.lit(""))
    )
    return F.concat(F.lit('<w:p w:rsid="1">'), props, word_runs(line), F.lit("</w:p>"))


def word_table(text: Column) -> Column:
    cell = lambda t: F.concat(F.lit("<w:tc><w:p>"), word_runs(t), F.lit("</w:p></w:tc>"))
    rows = F.transform(
        lines_of(text), lambda line, i: F.concat(F.lit("<w:tr>"), cell(word(i)), cell(line), F.lit("</w:tr><w:tr/>"))
    )
    return F.concat(F.lit("<w:tbl><w:tblPr/>"), joined(rows), F.lit("</w:tbl>"))


def word_document(text: Column) -> Column:
    paragraphs = joined(F.transform(lines_of(text), word_paragraph))
    return F.concat(
        F.lit('<?xml version="1.0"?><w:document><w:body>'),
        paragraphs,
        F.lit("<w:p/>"),
        word_table(text),
        F.lit("<w:p><w:r><w:t>end</w:t><w:tab/><w:t>.</w:t></w:r></w:p></w:body></w:document>"),
    )


def word_parts(docs: DataFrame) -> DataFrame:
    return as_parts(
        docs,
        F.col("doc_id"),
        (F.lit("[Content_Types].xml"), F.lit("<Types/>")),
        (F.lit("word/document.xml"), word_document(F.col("text"))),
    )


# Presentations: one deck per bucket of documents, one slide per document plus an empty one.


def slide_number(key: Column) -> Column:
    return (key % BUCKET) * 3 + 1


def deck_parts(docs: DataFrame) -> DataFrame:
    key = F.col("doc_id")
    paragraphs = F.transform(
        lines_of(F.col("text")),
        lambda line: F.concat(F.lit('<a:p><a:pPr lvl="0"/><a:r><a:t>'), escaped(line), F.lit("</a:t></a:r></a:p>")),
    )
    slide = F.concat(F.lit("<p:sld>"), joined(paragraphs), F.lit("</p:sld>"))
    name = lambda n: F.concat(F.lit("ppt/slides/slide"), word(n), F.lit(".xml"))
    return as_parts(
        docs,
        F.floor(key / BUCKET),
        (name(slide_number(key)), slide),
        (name(slide_number(key) + 1), F.lit("<p:sld/>")),
    )


# E-books: one book per bucket of pages, read in reverse order.


def book_parts(pages: DataFrame) -> DataFrame:
    book = F.floor(F.col("page_id") / BUCKET)
    name = F.concat(F.lit("ch "), word(F.col("page_id")), F.lit(".xhtml"))
    chapters = as_parts(pages, book, (F.concat(F.lit("OEBPS/"), name), F.col("html")))
    item = F.concat(
        F.lit('<item id="i'), word(F.col("page_id")), F.lit('" href="'), F.replace(name, F.lit(" "), F.lit("%20")), F.lit('"/>')
    )
    ref = F.concat(F.lit('<itemref idref="i'), word(F.col("page_id")), F.lit('"/>'))
    lists = (
        pages.select(word(book).alias("book"), "page_id", item.alias("item"), ref.alias("ref"))
        .groupBy("book")
        .agg(F.sort_array(F.collect_list(F.struct("page_id", "item", "ref")), asc=False).alias("found"))
    )
    opf = F.concat(
        F.lit('<package><manifest><item id="bad" href="absent%.xhtml"/><item id="lost"/>'),
        joined(F.col("found.item")),
        F.lit('</manifest><spine><itemref idref="bad"/><itemref idref="lost"/>'),
        joined(F.col("found.ref")),
        F.lit("</spine></package>"),
    )
    container = '<container><rootfiles><rootfile full-path="OEBPS/content.opf"/></rootfiles></container>'
    frame = as_parts(
        lists,
        F.col("book"),
        (F.lit("META-INF/container.xml"), F.lit(container)),
        (F.lit("OEBPS/content.opf"), opf),
    )
    return chapters.unionByName(frame)


def notebooks(spark: SparkSession, folder: str) -> DataFrame:
    """Up to eight turns of a conversation as one notebook; assistant turns are code."""
    turns = spread(table(spark, folder, "conversations"), "conv_id")
    source = F.when(
        F.col("role") == "assistant",
        F.to_json(F.array(F.substring("text", 1, 20), F.substr(F.col("text"), F.lit(21)), F.lit(" \n"))),
    ).otherwise(F.get_json_object(F.to_json(F.struct(F.col("text").alias("t"))), "$"))
    quoted = F.regexp_extract(source, r'(?s)\A\{"t":(.*)\}\z', 1)
    kind = F.when(F.col("role") == "assistant", "code").otherwise("markdown")
    cell = F.concat(
        F.lit('{"cell_type":"'),
        kind,
        F.lit('","outputs":[{"source":"no"}],"source":'),
        F.when(F.col("role") == "system", F.lit('" \\n"')).when(F.col("role") == "assistant", source).otherwise(quoted),
        F.lit("}"),
    )
    part = F.floor(F.col("turn") / 8)
    return (
        turns.select("conv_id", part.alias("part"), "turn", cell.alias("cell"))
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "cell"))).alias("cells"))
        .select(
            "conv_id",
            "part",
            F.concat(F.lit('{"nbformat":4,"cells":['), joined(F.col("cells.cell"), ","), F.lit("]}")).alias("text"),
        )
    )


def nearby(docs: DataFrame) -> DataFrame:
    """Documents dealt by their bucket, in ``near``, so that what is made of them one by one or by bucket moves as text, once."""
    return docs.withColumn("near", F.floor(F.col("doc_id") / BUCKET)).repartition("near")


def packed(docs: DataFrame, entries: Column, cut: Column | None = None) -> DataFrame:
    """ZIP containers ``(doc_id, content)`` from an array of ``(name, data)``; ``cut`` spoils some."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        import pandas

        for frame in batches:
            out = []
            for found, spoiled in zip(frame["entries"], frame["cut"]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as z:
                    for i, entry in enumerate(found):
                        how = zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED
                        z.writestr(zipfile.ZipInfo(entry["name"]), entry["data"], how)
                data = buffer.getvalue()
                out.append(data[: len(data) // 2] if spoiled else data)
            yield pandas.DataFrame({"doc_id": frame["doc_id"], "content": out})

    rows = docs.select(
        word(F.col("doc_id")).alias("doc_id"),
        entries.alias("entries"),
        (F.lit(False) if cut is None else cut).alias("cut"),
    )
    return rows.mapInPandas(pack, "doc_id string, content binary")


def entry(name: Column, data: Column) -> Column:
    return F.struct(name.alias("name"), data.cast("string").alias("data"))


def landed(df: DataFrame, key: str, text: str, path: str) -> None:
    """One text file per key and task, a line per row, the key in its folder name: what a landing directory holds.

    Other programs put such files there, and so do the tasks here. Spark's writer starts a program for the
    permissions of each file on file systems without native support and has the driver move them one by one.
    """

    folders = LANDING_FOLDERS

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from contextlib import closing
        from itertools import groupby
        from urllib.parse import quote
        from zlib import crc32

        import pyarrow
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        part, files = TaskContext.get().partitionId(), 0
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for value, found in groupby(rows, lambda row: row[0]):
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe="")
            folder = f"{base}/folder={crc32(name.encode()) % folders}/{key}={name}"
            store.create_dir(folder)
            with closing(store.open_output_stream(f"{folder}/part-{part:05d}.txt")) as out:
                for _, line in found:
                    out.write((line or "").encode() + b"\n")
            files += 1
        yield pyarrow.RecordBatch.from_pydict({"files": [files]})

    df.select(key, text).sortWithinPartitions(key).mapInArrow(put, "files long").agg(F.sum("files")).collect()
