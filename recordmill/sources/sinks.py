"""Pipe-delimited text tables, written so that a plain reader gets the same values."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType

from recordmill.functions.staging import let
from recordmill.functions.text import plain_number
from recordmill.operators.documents import table_width
from recordmill.sources.pipe_csv import empty_table, read_pipe_csv


def as_text(df: DataFrame) -> DataFrame:
    """Doubles as plain decimals, booleans as True and False; null stays null."""
    cells = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            value = plain_number(value)
        elif isinstance(field.dataType, BooleanType):
            value = F.initcap(value.cast("string"))
        cells.append(value.alias(field.name))
    return df.select(*cells)


def write_pipe_csv(
    df: DataFrame,
    path: str,
    columns: list[str] | None = None,
    header: bool = True,
    partition_by: list[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write ``columns`` (all by default) with ``|``; null and '' are both empty cells."""
    chosen = df if columns is None else df.select(*columns)
    writer = as_text(chosen).write.mode(mode).options(
        sep="|", header=header, quote='"', escape='"', emptyValue="", nullValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_unless_empty(df: DataFrame, path: str, **options) -> bool:
    """Write the table if it has a row; tells whether it did."""
    if df.isEmpty():
        return False
    write_pipe_csv(df, path, **options)
    return True


def write_index(df: DataFrame, path: str, columns: list[str], mode: str = "errorifexists") -> None:
    """Write as Parquet, which keeps the columns of a table without rows."""
    df.select(*columns).write.mode(mode).parquet(path)


def table_lines(cells: Column) -> Column:
    """The lines of a table as delimited text without a header, as ``write_pipe_csv`` quotes them.

    Short rows, and null ones, end in as many delimiters as they miss cells to the
    table's width; a row of one empty cell is a pair of quotes, so that it is no
    blank line. A table without any cell has blank lines.
    """
    quoted = lambda c: F.when(
        F.rlike(c, F.lit(r'[|"\r\n]')), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    ).otherwise(c)

    def line(row: Column, width: Column) -> Column:
        have = F.coalesce(F.size(row), F.lit(0))
        text = F.coalesce(F.array_join(F.transform(row, lambda c: quoted(F.coalesce(c, F.lit("")))), "|"), F.lit(""))
        missing = width - F.greatest(have, F.lit(1))
        return F.when((width == 1) & (text == ""), F.lit('""')).otherwise(
            F.concat(text, F.repeat(F.lit("|"), F.greatest(missing, F.lit(0))))
        )

    return let(table_width(cells), lambda width: F.transform(cells, lambda row: line(row, width)))


_INDEX = pa.schema(
    [("table_file", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("n_rows", pa.int32()), ("width", pa.int32())]
)


def _place(path: str) -> tuple:
    """The file system of a path and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^([a-z0-9]+):/+(?=[^/])", r"\1:///", path) if path.startswith("file:") else path)


def _write_files(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """A file per name, of the last row that has it (rows come ordered by name).

    A file gets its name when it is whole, so a task that runs again just writes it again.
    """
    system, root = _place(path)

    def written(name: str, text: str) -> int:
        data = f"{text}\n".encode()
        begun = f"{root}/.{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(begun) as out:
            out.write(data)
        system.move(begun, f"{root}/{name}")
        return len(data)

    def index(rows: list[dict]) -> pa.RecordBatch:
        made = [r | {"path": f"{path}/{r['table_file']}", "length": written(r["table_file"], r.pop("value"))} for r in rows]
        return pa.RecordBatch.from_pylist(made, _INDEX)

    held = None
    for batch in batches:
        rows = batch.to_pylist()
        before = [held, *rows] if held else rows
        last = [r for r, after in zip(before, before[1:], strict=False) if r["table_file"] != after["table_file"]]
        held = before[-1] if before else None
        if last:
            yield index(last)
    if held:
        yield index([held])


def write_table_files(tables: DataFrame, path: str) -> DataFrame:
    """One headerless pipe text per table, named as the table, all in the new folder ``path``; returns the file index.

    ``tables`` has ``(table_file, cells)``, a row per table. A table's text is made in
    that row, so no row of a table is shuffled, sorted or padded with cells; the tables
    are dealt by name, and of tables that share a name the longest stays. Spark's own text sink makes a folder for each name and can't name
    files, so a function over Arrow batches writes them, by the file systems that Arrow
    knows (local, HDFS, S3, GCS). The index ``(table_file, path, length, n_rows, width)``
    is written behind the files to ``_index`` in the folder, where readers of the folder
    do not see it; it names whole files only.
    """
    system, root = _place(path)
    from pyarrow import fs

    if system.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    system.create_dir(root, recursive=True)
    text = F.array_join(table_lines(F.col("cells")), "\n")
    rows = tables.select(
        "table_file", text.alias("value"), F.size("cells").alias("n_rows"), table_width(F.col("cells")).alias("width")
    )
    dealt = rows.repartition("table_file").sortWithinPartitions("table_file", "n_rows", F.xxhash64("value"))
    schema = "table_file string, path string, length long, n_rows int, width int"
    index = dealt.mapInArrow(lambda batches: _write_files(batches, path), schema)
    index.write.parquet(f"{path}/_index")
    return table_file_index(tables.sparkSession, path)


def table_file_index(spark: SparkSession, path: str) -> DataFrame:
    """The files that ``write_table_files`` wrote to a folder."""
    return spark.read.parquet(f"{path}/_index")


_LINES = pa.schema([("table_file", pa.string()), ("value", pa.string())])
#: Bytes of text that a task reads before it passes their lines on.
_READ = 4 << 20


def _read_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of the files named, ended as Spark's text source ends them."""
    for batch in batches:
        names, lines, size = [], [], 0
        for row in batch.to_pylist():
            system, place = _place(row["path"])
            with system.open_input_stream(place) as file:
                data = file.read()
            own = data.removeprefix(b"\xef\xbb\xbf").splitlines()
            names += [row["table_file"]] * len(own)
            lines += own
            size += len(data)
            if size >= _READ:
                yield _lines(names, lines)
                names, lines, size = [], [], 0
        if lines:
            yield _lines(names, lines)


def _lines(names: list[str], lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.binary()).cast(pa.string())], schema=_LINES)


def read_table_files(index: DataFrame) -> DataFrame:
    """``(table_file, value)``: the lines of the files that an index of ``write_table_files`` names.

    The index is dealt over the tasks, and each opens the files of its rows. Nothing lists
    the folder, and no task is made for a few files, as Spark's text source does.
    """
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.select("table_file", "path").repartition(n, "path")
    return dealt.mapInArrow(_read_files, "table_file string, value string")


def write_table_lines(tables: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All tables as pipe text in as many files as there are tasks: each line begins with its table and row number."""
    rows = F.posexplode_outer(table_lines(F.col("cells"))).alias("_at", "_line")
    lines = tables.select("table_file", rows).select(F.concat_ws("|", "table_file", F.col("_at") + 1, "_line").alias("value"))
    lines.write.mode(mode).text(path)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The Java path, its configuration and file system."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, conf, place.getFileSystem(conf)


def save_version(df: DataFrame, folder: str, name: str, columns: list[str] | None = None) -> str:
    """Write a table as a new version under ``folder/name`` and make it the current one; returns its path.

    The version has a folder of its own. Only when it is whole is the pointer file
    ``current`` replaced, by one rename, so a reader gets the old table or the new
    one and never a part of either, and a write that fails changes nothing.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    path = f"{folder}/{name}/{version}"
    write_pipe_csv(df, path, columns)
    begun, conf, system = _hadoop(spark, f"{folder}/{name}/.current-{version}")
    out = system.create(begun, True)
    out.write(bytearray(version.encode()))
    out.close()
    pointer, _, _ = _hadoop(spark, f"{folder}/{name}/current")
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf).rename(begun, pointer, options)
    return path


def current_version(spark: SparkSession, folder: str, name: str) -> str | None:
    """Path of the current version; None before the first."""
    pointer, _, system = _hadoop(spark, f"{folder}/{name}/current")
    if not system.exists(pointer):
        return None
    return f"{folder}/{name}/{spark.read.text(f'{folder}/{name}/current').first().value}"


def read_current(spark: SparkSession, folder: str, name: str, columns: list[str], **options) -> DataFrame:
    """The current version of a table as ``read_pipe_csv`` reads it; without one an empty table with ``columns``."""
    path = current_version(spark, folder, name)
    return empty_table(spark, columns) if path is None else read_pipe_csv(spark, path, columns, **options)
