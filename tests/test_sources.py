import os
from collections import defaultdict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from docpipe.operators.extract import ExpressionModel, extract_fields
from docpipe.operators.flatten import flatten_documents
from docpipe.sources.files import (
    decoded_text, extract_text, file_manifest, packed_ranges, read_file_ranges, read_files,
)
from docpipe.sources.pages import PAGE, html_text, page_json, page_manifest


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    (root / "sub").mkdir()
    (root / "a.pdf").write_bytes(b"%PDF-1.4 \x00\xff")
    (root / "b.txt").write_text("Remarks: ü\n")
    (root / "sub" / "c.pdf").write_bytes(b"%PDF second")
    return str(root)


def test_manifest(spark, folder):
    one_level = file_manifest(spark, folder, "*.pdf")
    assert [(r.name, r.length) for r in one_level.collect()] == [("a.pdf", 11)]
    assert file_manifest(spark, folder, "*.pdf", recursive=True).count() == 2
    assert file_manifest(spark, folder).count() == 2
    assert "content" not in plan_of(one_level)


def test_bytes_are_unchanged(spark, folder):
    row = read_files(spark, folder, "a.pdf").head()
    assert bytes(row.content) == b"%PDF-1.4 \x00\xff"


def test_decoded_text(spark, folder):
    row = decoded_text(read_files(spark, folder, "*.txt")).head()
    assert (row.name, row.text, row.error) == ("b.txt", "Remarks: ü\n", None)


def test_one_bad_byte_costs_one_row(spark, folder):
    for charset, error in (("utf-8", "NOT_IN_CHARSET"), ("ascii", "UnicodeDecodeError")):
        rows = {r.name: r for r in decoded_text(read_files(spark, folder), charset).collect()}
        assert rows["a.pdf"].text is None and rows["a.pdf"].error.startswith(error)
        assert "content" not in decoded_text(read_files(spark, folder), charset).columns
    latin = {r.name: r.text for r in decoded_text(read_files(spark, folder), "latin-1").collect()}
    assert latin["a.pdf"].endswith("\xff")


def test_page_manifest(spark):
    urls = ["http://a/x/p.html?q=1", "http://b/p.html#top", "http://b/", None, "http://c/z"]
    df = spark.createDataFrame([(i, u, "é" if i else None) for i, u in enumerate(urls)],
                               "page_id int, url string, html string")
    rows = [tuple(r) for r in page_manifest(df).orderBy("page_id").collect()]
    assert rows == [(0, "p.html", None, 2), (1, "p.html", 2, 2), (2, None, 2, None),
                    (3, None, 2, None), (4, "z", 2, 1)]


def pdf_parser():
    def parse(content):
        if b"second" in content:
            raise ValueError("page 2 is missing")
        return content[:8].decode()
    return parse


def test_parser_errors_stay_with_their_file(spark, folder):
    files = read_files(spark, folder, "*.pdf", recursive=True)
    rows = {r.name: r for r in extract_text(files, pdf_parser).collect()}
    assert (rows["a.pdf"].text, rows["a.pdf"].error) == ("%PDF-1.4", None)
    assert (rows["c.pdf"].text, rows["c.pdf"].error) == (None, "ValueError: page 2 is missing")
    assert "content" not in extract_text(files, pdf_parser).columns


PAGE_TEXT = (
    '<!DOCTYPE html><HTML class="x" lang="en"><head><title> A &amp; B\n</title>'
    "<style>p{margin:0}</style><script>var t='</p>';</script></head><body><!-- <p>no</p> -->"
    "<h1>Head</h1><p class='a'>one <b>two</b>&nbsp;&lt;3<br/>four\t five<pre>six</pre></body></html>"
)


def test_html_text(spark):
    df = spark.createDataFrame([(PAGE_TEXT,), ("plain",), ("",), (None,)], "html string")
    texts = [r.t for r in df.select(html_text(F.col("html")).alias("t")).collect()]
    assert texts == ["A & B\nHead\none two <3\nfour fivesix", "plain", "", None]


def test_page_record(spark):
    df = spark.createDataFrame(
        [(1, PAGE_TEXT), (2, "<p>bare</p>"), (3, None)], "page_id int, html string"
    )
    records = extract_fields(df, ExpressionModel(page_json), text="html")
    rows = flatten_documents(records, PAGE, ("page_id", "error")).orderBy("page_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, None, "A &amp; B", "en", "Head"),
        (2, None, None, None, None),
        (3, "NULL_INPUT", None, None, None),
    ]


def whole(rows):
    """Ranges put together again, by name; they have to cover each file once."""
    pieces = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == sum(map(len, pieces[r.name])) and os.path.basename(r.path) == r.name
        pieces[r.name].append(bytes(r.content))
        assert r.length >= r.start + len(r.content)
    return {name: b"".join(p) for name, p in pieces.items()}


def test_a_file_beyond_the_largest_row_is_read_by_several_tasks(spark, tmp_path):
    content = {"large.bin": os.urandom(1_000_007), "exact.bin": os.urandom(200_000), "empty.bin": b"", "é x.bin": b"1"}
    for name, value in content.items():
        (tmp_path / name).write_bytes(value)
    (tmp_path / "_hidden.bin").write_bytes(b"no")
    (tmp_path / "other.txt").write_bytes(b"no")
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "500000")
    try:
        with pytest.raises(Exception, match="(?i)exceed|max"):
            read_files(spark, str(tmp_path), "large.bin").collect()
        for path in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
            df = read_file_ranges(spark, path, "*.bin", range_bytes=100_000, task_bytes=250_000)
            rows = df.withColumn("task", F.spark_partition_id()).collect()
            assert whole(rows) == content
            assert max(len(r.content) for r in rows) == 100_000
            assert len({r.task for r in rows if r.name == "large.bin"}) >= 4
    finally:
        spark.conf.unset(limit)


def test_ranges_of_folders(spark, folder):
    names = lambda df: sorted(r.name for r in df.collect())
    assert names(read_file_ranges(spark, folder)) == ["a.pdf", "b.txt"]
    assert names(read_file_ranges(spark, folder, "*.pdf", recursive=True)) == ["a.pdf", "c.pdf"]
    assert names(read_file_ranges(spark, f"{folder}/b.txt")) == ["b.txt"]
    assert names(read_file_ranges(spark, folder, "*.none")) == []
    with pytest.raises(Exception, match="FileNotFoundError|not found|No such"):
        read_file_ranges(spark, f"{folder}/nowhere").collect()
    with pytest.raises(ValueError):
        read_file_ranges(spark, folder, range_bytes=0)


def test_tasks_are_packed_by_size():
    small = [(f"f{i}", 10) for i in range(1000)]
    tasks = list(packed_ranges([*small, ("g", 1000)], 160, 320))
    assert sum(len(t) for t in tasks) == 1000 + 7
    assert all(sum(r[3] + 10 for r in t) <= 320 for t in tasks) and len(tasks) < 80
    assert list(packed_ranges([], 160, 320)) == []
    # a range above the size of a task is a task of its own
    assert [len(t) for t in packed_ranges([("g", 1000)], 500, 100)] == [1, 1]


def test_a_task_holds_one_range_at_a_time(tmp_path):
    """Every range is handed over before the next one is read."""
    from docpipe.sources.files import _Ranges, _RangeReader

    (tmp_path / "a.bin").write_bytes(bytes(range(256)) * 40)
    reader = _RangeReader({"path": str(tmp_path), "range_bytes": "1000"})
    tasks = reader.partitions()
    batches = [b for task in tasks for b in reader.read(task)]
    assert [b.num_rows for b in batches] == [1] * 11 and max(b["content"][0].as_py().__len__() for b in batches) == 1000
    assert b"".join(b["content"][0].as_py() for b in batches) == bytes(range(256)) * 40
    assert list(reader.read(_Ranges(()))) == []
