import csv

import pytest
from pyspark.sql import functions as F

from recordmill.sources import catalog, pipe_csv, sinks


def write_raw(path, text, bom=True):
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))
    return str(path)


def test_scan_is_string_safe(spark, tmp_path):
    raw = 'id|name|amount\n007|" a ""q"" "|\n||NA\n8|"two\nlines"|"x|y"\n'
    df = pipe_csv.read_pipe_csv(spark, write_raw(tmp_path / "t.csv", raw), ["id"], multi_line=True)
    assert df.columns == ["id", "name", "amount"] and set(dict(df.dtypes).values()) == {"string"}
    assert [tuple(r) for r in df.collect()] == [("007", ' a "q" ', ""), ("", "", "NA"), ("8", "two\nlines", "x|y")]
    filled = pipe_csv.read_pipe_csv(spark, str(tmp_path / "t.csv"), [], multi_line=True, missing_texts=pipe_csv.MISSING_TEXTS)
    assert [r.amount for r in filled.collect()] == ["", "", "x|y"]


def test_missing_file_is_an_empty_table(spark, tmp_path):
    assert pipe_csv.try_read_pipe_csv(spark, str(tmp_path / "none.csv")) is None
    empty = pipe_csv.read_pipe_csv(spark, str(tmp_path / "none.csv"), ["a", "b"])
    assert empty.columns == ["a", "b"] and empty.isEmpty()
    assert catalog.read_catalog(spark, {"x": str(tmp_path / "none.csv")}) == {}


@pytest.mark.parametrize("multi_line", [True, False])
def test_file_order_is_input_order(spark, tmp_path, multi_line):
    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for part in range(5):
        lines = [f"{part}-{i:05d}" for i in range(2000)]
        expected += lines
        write_raw(folder / f"p{part}.csv", "k|v\n" + "".join(f"{x}|y\n" for x in lines), bom=part % 2 == 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = pipe_csv.try_read_pipe_csv(spark, str(folder), multi_line=multi_line, file_order=True)
        got = [r.k for r in df.orderBy(pipe_csv.FILE_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == expected


def test_header_probe(spark, tmp_path):
    path = write_raw(tmp_path / "h.csv", "a|b\n1|2\n")
    assert pipe_csv.header_line(spark, path) == "a|b" and pipe_csv.has_pipe_header(spark, path)
    assert not pipe_csv.has_pipe_header(spark, write_raw(tmp_path / "c.csv", "a,b\n"))


def test_sink_round_trip(spark, tmp_path):
    rows = [("a|b", 'q"r', 12800000.0, True, "x"), (" lead ", "", None, None, "é"), ("line\nbreak", None, 2.5, False, "NA")]
    df = spark.createDataFrame(rows, "s string, t string, d double, b boolean, u string")
    out = str(tmp_path / "out")
    sinks.write_pipe_csv(df.coalesce(1), out, columns=["s", "t", "d", "b"])
    (part,) = (tmp_path / "out").glob("part-*.csv")
    with part.open(encoding="utf-8", newline="") as stream:
        plain = list(csv.reader(stream, delimiter="|"))
    expected = [["s", "t", "d", "b"], ["a|b", 'q"r', "12800000.0", "True"], [" lead ", "", "", ""], ["line\nbreak", "", "2.5", "False"]]
    assert plain == expected
    again = pipe_csv.read_pipe_csv(spark, out, [], multi_line=True)
    assert [list(r) for r in again.collect()] == expected[1:]


def test_empty_output_is_skipped(spark, tmp_path):
    empty = pipe_csv.empty_table(spark, ["a"])
    assert not sinks.write_unless_empty(empty, str(tmp_path / "no")) and not (tmp_path / "no").exists()
    assert sinks.write_unless_empty(spark.range(1), str(tmp_path / "yes")) and (tmp_path / "yes").exists()


def test_index_keeps_columns_without_rows(spark, tmp_path):
    path = str(tmp_path / "index")
    sinks.write_index(spark.createDataFrame([], "a string, n int, b string"), path, ["a", "n"])
    assert spark.read.parquet(path).dtypes == [("a", "string"), ("n", "int")]


TABLES = {
    "a_t1.csv": [['q"r', "a|b"], ["x"], None, ["line\nbreak", None]],
    "a_t2.csv": [[None], [], ["z"]],
    "word.csv": [None],  # a document of one word: rows without any cell
    "b.csv": [["", "", ""]],
}


def tables_of(spark):
    rows = [("a.pdf", name, cells) for name, cells in TABLES.items()]
    return spark.createDataFrame(rows, "source_file string, table_file string, cells array<array<string>>")


def test_each_table_has_a_headerless_file(spark, tmp_path):
    index = sinks.write_table_files(tables_of(spark), str(tmp_path / "t")).collect()
    assert sorted(r.table_file for r in index) == sorted(TABLES)
    for row in index:
        assert row.path == str(tmp_path / "t" / row.table_file)
        with open(row.path, encoding="utf-8", newline="") as stream:
            got = list(csv.reader(stream, delimiter="|"))
        width = max(len(r or []) for r in TABLES[row.table_file])
        filled = [[c or "" for c in [*(r or []), *[None] * width][:width]] for r in TABLES[row.table_file]]
        assert got == filled and (row.n_rows, row.width) == (len(TABLES[row.table_file]), width)
    with pytest.raises(FileExistsError):
        sinks.write_table_files(tables_of(spark), str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["_index", *sorted(TABLES)]
    twice = sinks.write_table_files(tables_of(spark).withColumn("table_file", F.lit("same.csv")), str(tmp_path / "s")).collect()
    assert [(r.table_file, r.n_rows) for r in twice] == [("same.csv", 4)]
    none = sinks.write_table_files(tables_of(spark).limit(0), str(tmp_path / "none"))
    assert none.collect() == []


def test_table_files_are_read_by_their_index(spark, tmp_path):
    many = spark.range(300).selectExpr("concat(id, '.csv') AS table_file", "array(array(string(id), 'a'), array('b'), null) AS cells")
    index = sinks.write_table_files(many.union(tables_of(spark).drop("source_file")), str(tmp_path / "t"))
    read = sinks.read_table_files(index)
    plain = spark.read.text(str(tmp_path / "t")).select(F.col("_metadata.file_name").alias("table_file"), "value")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, plain.collect()))
    assert read.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tmp_path / "t" / "stray.csv").write_text("x\n")  # not in the index
    assert read.filter("table_file = 'stray.csv'").isEmpty()


def test_tables_share_files_by_lines(spark, tmp_path):
    sinks.write_table_lines(tables_of(spark).filter("table_file <> 'a_t1.csv'"), str(tmp_path / "t"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert sorted(lines) == ['a_t2.csv|1|""', 'a_t2.csv|2|""', "a_t2.csv|3|z", "b.csv|1|||", "word.csv|1|"]


def test_a_version_becomes_current_when_it_is_whole(spark, tmp_path):
    place = str(tmp_path)
    assert sinks.read_current(spark, place, "index", ["a"]).columns == ["a"]
    first = sinks.save_version(spark.range(3), place, "index")
    bad = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.save_version(bad, place, "index")
    assert sinks.current_version(spark, place, "index") == first
    assert sorted(r.id for r in sinks.read_current(spark, place, "index", []).collect()) == ["0", "1", "2"]
    reader = sinks.read_current(spark, place, "index", [])
    second = sinks.save_version(spark.range(5), place, "index")
    assert sinks.current_version(spark, place, "index") == second != first
    assert reader.count() == 3 and sinks.read_current(spark, place, "index", []).count() == 5


def test_large_files_are_split(spark, tmp_path):
    path = write_raw(tmp_path / "big.csv", "k|v\n" + "".join(f"{i}|y\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert pipe_csv.try_read_pipe_csv(spark, path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_list_files(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"12")
    listed = catalog.list_files(spark, str(tmp_path))
    assert [(r.file_name, r.length) for r in listed.collect()] == [("a.pdf", 2), ("b.pdf", 2)]
    assert "content" not in listed.columns


def test_page_sources(spark, tmp_path):
    spark.createDataFrame([("f", 1, None)], "source_file string, page int, text string").write.parquet(str(tmp_path / "t"))
    assert [tuple(r) for r in catalog.read_page_text(spark, str(tmp_path / "t")).collect()] == [("f", 1, "")]
    pages = catalog.read_pages(spark, "/root/testdata/sf0.001/pages.parquet")
    assert pages.columns == ["page_id", "url", "html"] and pages.agg(F.count("*")).first()[0] > 0
