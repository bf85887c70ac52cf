"""Work that may not grow faster than the input: plans, tasks and memory."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from docmill.operators import word
from docmill.plans import convert, sources
from docmill.plans.convert import convert_inputs
from docmill.sources import files
from docmill.sources.delimited import _parser, parse_delimited
from docmill.sources.files import scan_documents


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_exploded_values_are_computed_once(spark):
    docs = spark.range(4).selectExpr("id AS doc_id", "concat('a,b\n', id) AS text").repartition(2)
    parsed = parse_delimited(docs, "text")
    assert optimized(parsed).count("ArrowEvalPython") == 1
    assert sorted((r.doc_id, r.row_no) for r in parsed.collect()) == [(i, n) for i in range(4) for n in (0, 1)]
    parts = spark.createDataFrame(
        [("d", word.DOCUMENT_PART, bytearray(b"<w:p><w:t>x</w:t></w:p>")), ("e", word.DOCUMENT_PART, bytearray(b"")), ("f", word.DOCUMENT_PART, None)],
        "doc_id string, part string, content binary",
    )
    blocks = word.docx_blocks(parts)
    assert "size(" not in "".join(line for line in optimized(blocks).splitlines() if "Filter" in line)
    assert [(r.doc_id, r.block_no, r.markdown) for r in blocks.collect()] == [("d", 0, "x")]


def test_records_of_a_batch_are_not_held_as_objects():
    text = "a,b,c\n" * 200_000
    texts = pa.array([text, None, "", "x"])
    tracemalloc.start()
    records = _parser(",")(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # As lists and strings the cells of this text take more than twenty times its size.
    assert peak < 12 * len(text)
    assert [None if r is None else len(r) for r in records.to_pylist()] == [200_000, None, 0, 1]


def test_landing_directory(spark, tmp_path):
    rows = [(1, "one"), (2, None), (3, "x\ny"), (3, "again")]
    df = spark.createDataFrame(rows, "page_id long, html string").coalesce(1)
    sources.landed(df, "page_id", "html", f"file://{tmp_path}/in")
    found = {r.path.split("page_id=")[1].split("/")[0]: bytes(r.content) for r in scan_documents(spark, str(tmp_path / "in")).collect()}
    assert found["1"] == b"one\n" and found["2"] == b"\n" and sorted(found["3"].split()) == [b"again", b"x", b"y"]
    # Few folders on each level: Spark lists those of a level by a task each.
    many = spark.range(1500).selectExpr("id AS page_id", "'x' AS html")
    sources.landed(many, "page_id", "html", str(tmp_path / "many"))
    assert len(list((tmp_path / "many").iterdir())) <= 256 and scan_documents(spark, str(tmp_path / "many")).count() == 1500


def test_scans_of_small_files_take_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SCANS_A_CORE", 1)
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text("x" * (1 + i % 2 * 50))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        found = scan_documents(spark, str(tmp_path), max_bytes=20)
        assert found.rdd.getNumPartitions() < 80
        assert {(r.status, r["count"]) for r in found.groupBy("status").count().collect()} == {("ok", 150), ("too_large", 150)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_many_requested_files_are_not_named_in_the_plan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(convert, "FETCH_NAMES", 2)
    for i in range(40):
        (tmp_path / f"file{i}.txt").write_text(f"text {i}")
    manifest = spark.range(30).select(F.col("id").cast("string").alias("doc_id"), F.format_string("file%d.txt", "id").alias("input"))
    done = convert_inputs(spark, manifest, str(tmp_path), base=str(tmp_path))
    assert "file29.txt" not in optimized(done)
    assert {r.doc_id: (r.status, r.markdown) for r in done.collect()} == {str(i): ("ok", f"text {i}") for i in range(30)}
