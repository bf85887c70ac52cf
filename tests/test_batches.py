"""What a batch of a stream costs besides its files."""

from pyspark.sql import functions as F

from docmill import ConvertOptions
from docmill.plans.convert import convert_documents, convert_files, formats_of
from docmill.streaming.documents import LISTINGS_A_CORE, stream_documents
from tests.make import docx, pptx


def test_batches_list_files_in_few_tasks_and_skip_absent_formats(spark, tmp_path):
    n = 70
    (tmp_path / "in").mkdir()
    for i in range(n):
        (tmp_path / "in" / f"{i}.txt").write_text(f"text {i}")
    query = stream_documents(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), max_files=35)
    query.awaitTermination()
    assert {r.markdown for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {f"text {i}" for i in range(n)}
    track = spark.sparkContext.statusTracker()
    jobs = track.getJobIdsForGroup(str(query.runId))
    tasks = [track.getStageInfo(s).numTasks for j in jobs for s in track.getJobInfo(j).stageIds if track.getStageInfo(s)]
    assert tasks and max(tasks) <= LISTINGS_A_CORE * spark.sparkContext.defaultParallelism < 35
    # Listing, formats (two stages under adaptive execution) and results, for each of two batches, and once the id of the query.
    assert len(jobs) <= 2 * 4 + 1


def test_only_formats_that_occur_are_planned(spark):
    names = ["a.txt", "b.MD", "c.html", "d.json", "e.pdf", "none", "f.docx", None]
    df = spark.createDataFrame([(str(i), n, bytearray(b"[1]")) for i, n in enumerate(names)], "doc_id string, input string, content binary")
    assert formats_of(df) == {"text", "html", "json", "unsupported", "unknown", "docx"}
    typed = df.withColumns({"input": F.lit("https://x.test/a.txt"), "content_type": F.lit("text/csv")})
    assert formats_of(typed) == {"csv"}
    plain = df.where("input IN ('a.txt', 'b.MD', 'e.pdf', 'none') OR input IS NULL")
    some = convert_documents(plain, formats=formats_of(plain))
    assert "Python" not in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, some.collect())) == sorted(map(str, convert_documents(plain).collect()))
    assert sorted(map(str, convert_documents(df, formats=formats_of(df)).collect())) == sorted(map(str, convert_documents(df).collect()))


def test_stream_of_mixed_formats(spark, tmp_path):
    files = {
        "a.txt": b"one", "b.html": b"<h1>Two</h1>", "c.csv": b"x,y\n1,2", "d.json": b'{"k": [1]}', "e.ipynb": b"{}", "g.docx": b"no zip",
        "f.docx": docx(), "h.pptx": pptx([(1, ["eight"])]), "i.exe": b"MZ", "j.pdf": b"%",
    }
    (tmp_path / "in").mkdir()
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    stream_documents(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), ConvertOptions(), max_files=3).awaitTermination()
    columns = ["input", "format", "status", "error", "chars", "markdown"]
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    whole = convert_files(spark, str(tmp_path / "in"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(whole) and whole.count() == len(files)
