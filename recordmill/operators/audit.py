"""Data-quality audit, exit flag and gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.text import strip_ws
from recordmill.operators.columns import merge_by_name

ISSUE_COLUMNS = ["file_name", "severity", "check", "details"]
URL_COLUMNS = ("document_url", "article_url", "source_url")

# Columns each collected table must have, in checking order.
REQUIRED_COLUMNS = {
    "resource_index_seed": ("council", "category", "document_title_raw", "document_url", "source_page"),
    "resource_index": ("council", "category", "document_title_raw", "document_url", "source_page"),
    "news": ("council", "title_raw", "article_url", "source_listing_page"),
    "news_seed": ("council", "title_raw", "article_url", "source_listing_page"),
    "cdf_projects_seed": ("council", "ward_raw", "project_name_raw", "source_url"),
    "cdf_activities_seed": ("council", "activity_type_raw", "description_raw", "source_url"),
}


@dataclass(frozen=True)
class Collected:
    """A collected table under audit; ``rows`` is None where its file is missing."""

    file_name: str
    rows: DataFrame | None
    required: tuple[str, ...] = ()

    def missing_columns(self) -> list[str]:
        return sorted(set(self.required) - set(self.rows.columns))

    def url_column(self) -> str | None:
        return next((name for name in URL_COLUMNS if name in self.rows.columns), None)

    def urls_are_unique(self) -> bool:
        """One document may prove many projects; only indexes and news list a URL once."""
        return "resource_index" in self.file_name or "news" in self.file_name


def _issue(file_name: str, severity: Column | str, check: str, details: Column | str) -> Column:
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(
        F.lit(file_name).alias("file_name"),
        text(severity).alias("severity"),
        F.lit(check).alias("check"),
        text(details).alias("details"),
    )


def _url_counts(table: Collected) -> DataFrame:
    """One row: rows, rows without a URL, URLs that occur more than once."""
    name = table.url_column()
    if name is None:
        return table.rows.agg(F.count("*").alias("n"), F.lit(0).alias("blank"), F.lit(0).alias("repeated"))
    url = strip_ws(F.col(name))
    if not table.urls_are_unique():
        return table.rows.agg(
            F.count("*").alias("n"), F.count_if(url == "").alias("blank"), F.lit(0).alias("repeated")
        )
    by_url = table.rows.groupBy(url.alias("u")).agg(F.count("*").alias("c"))
    return by_url.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("u") == "", F.col("c"))), F.lit(0)).alias("blank"),
        F.count_if((F.col("u") != "") & (F.col("c") > 1)).alias("repeated"),
    )


# Fixed values below: names of the checks, severities and wording of the details.
def audit_table(spark: SparkSession, table: Collected) -> DataFrame:
    """Issues of one table. A missing file, missing columns or no rows end the checks."""
    name = table.file_name
    if table.rows is None:
        only = _issue(name, "error", "file_exists", "Expected file is missing")
        return spark.range(1).select(only.alias("i")).select("i.*")
    missing = table.missing_columns()
    if missing:
        only = _issue(name, "error", "required_columns", f"Missing: {', '.join(missing)}")
        return spark.range(1).select(only.alias("i")).select("i.*")

    n, blank, repeated = F.col("n"), F.col("blank"), F.col("repeated")
    url = table.url_column() or ""
    severity = "warning" if name.endswith("_seed.csv") else "error"
    empty = F.array(_issue(name, severity, "row_count", "No data rows found"))
    found = F.array(
        F.when(
            blank > 0,
            _issue(name, "warning", "provenance_url", F.format_string(f"%d/%d rows have no {url}", blank, n)),
        ),
        F.when(
            repeated > 0,
            _issue(name, "warning", "duplicate_url", F.format_string(f"%d repeated {url} value(s)", repeated)),
        ),
        _issue(name, "pass", "row_count", F.format_string("%d data row(s) read with pipe delimiter", n)),
    )
    checks = F.when(n == 0, empty).otherwise(F.filter(found, lambda i: i.isNotNull()))
    return _url_counts(table).select(F.inline(checks))


def audit(spark: SparkSession, tables: list[Collected]) -> DataFrame:
    """Issue table over all collected tables, in their order."""
    return merge_by_name([audit_table(spark, table) for table in tables]).select(*ISSUE_COLUMNS)


def contract_table(spark: SparkSession, contract: dict[str, tuple[str, ...]], prefix: str = "") -> DataFrame:
    """The contract as a table: a row per kind of file, in checking order, with what is asked of it."""
    rows = [
        (
            place, kind, f"{prefix}{kind}.csv", list(required), "warning" if kind.endswith("_seed") else "error",
            "resource_index" in kind or "news" in kind,
        )
        for place, (kind, required) in enumerate(contract.items())
    ]
    schema = "place int, kind string, expected_file string, required array<string>, empty_severity string, urls_are_unique boolean"
    return spark.createDataFrame(rows, schema)


def file_headers(files: DataFrame, lines: DataFrame) -> DataFrame:
    """``file_name, names``: the column names of each listed file, none where it has no line.

    ``lines`` has ``(file_name, at, value)``, ``at`` ordering the lines of a file.
    """
    first = lines.groupBy("file_name").agg(F.min_by("value", "at").alias("header"))
    cells = F.split(F.regexp_replace("header", r"^\x{feff}", ""), r"\|")
    names = F.transform(cells, lambda c: F.regexp_replace(c, '^"(.*)"$', "$1"))
    return files.join(first, "file_name", "left").select("file_name", F.coalesce(names, F.array().cast("array<string>")).alias("names"))


def file_contracts(headers: DataFrame, contract: DataFrame, prefix: str = "") -> DataFrame:
    """Each kind's files with what they lack and the place of their URL column; a kind without a file has one row, unread."""
    kind = F.regexp_extract("file_name", rf"^{prefix}(.+?)(?:[-_.]\d+)?\.csv$", 1)
    url = F.get(F.filter(F.array(*map(F.lit, URL_COLUMNS)), lambda u: F.array_contains("names", u)), F.lit(0))
    named = headers.withColumns({"kind": kind, "url": url})
    found = F.broadcast(contract).join(named, "kind", "left")  # the contract has a row per kind
    return found.select(
        "place",
        F.coalesce("file_name", "expected_file").alias("file_name"),
        F.col("file_name").isNotNull().alias("is_there"),
        F.array_sort(F.array_except("required", F.coalesce("names", F.array().cast("array<string>")))).alias("missing"),
        "empty_severity",
        "urls_are_unique",
        "url",
        (F.array_position("names", F.col("url")) - 1).cast("int").alias("url_at"),
    )


def file_counts(rows: DataFrame, contracts: DataFrame) -> DataFrame:
    """Per file: rows, rows without a URL, URLs that occur more than once. ``rows`` has ``(file_name, cells)``.

    Files whose URLs may repeat are counted by blank and filled alone. What is asked of
    the files, a row each, goes to the rows: these are dealt by file and URL, never by file.
    """
    wanted = contracts.filter("is_there AND size(missing) = 0").select("file_name", "urls_are_unique", "url_at")
    cell = F.when(F.col("url_at").isNull(), F.lit(None)).otherwise(strip_ws(F.coalesce(F.get("cells", F.col("url_at")), F.lit(""))))
    key = F.when(F.col("urls_are_unique") | (cell == ""), cell).otherwise(F.lit("filled"))
    by_url = rows.join(F.broadcast(wanted), "file_name").groupBy("file_name", "urls_are_unique", key.alias("u")).agg(F.count("*").alias("c"))
    return by_url.groupBy("file_name").agg(
        F.sum("c").alias("n"),
        F.coalesce(F.sum(F.when(F.col("u") == "", F.col("c"))), F.lit(0)).alias("blank"),
        F.count_if(F.col("urls_are_unique") & (F.col("u") != "") & (F.col("c") > 1)).alias("repeated"),
    )


# As in ``audit_table``.
def contract_issues(contracts: DataFrame, counts: DataFrame) -> DataFrame:
    """The issue table of any number of files, from one row per file."""
    zero = F.lit(0).cast("long")
    every = contracts.join(counts, "file_name", "left").select(
        *contracts.columns, *[F.coalesce(c, zero).alias(c) for c in ("n", "blank", "repeated")]
    )

    def issue(severity: Column | str, check: str, details: Column | str) -> Column:
        text = lambda v: F.lit(v) if isinstance(v, str) else v
        return F.struct(text(severity).alias("severity"), F.lit(check).alias("check"), text(details).alias("details"))

    found = F.array(
        F.when(F.col("blank") > 0, issue("warning", "provenance_url", F.format_string("%d/%d rows have no %s", "blank", "n", "url"))),
        F.when(F.col("repeated") > 0, issue("warning", "duplicate_url", F.format_string("%d repeated %s value(s)", "repeated", "url"))),
        issue("pass", "row_count", F.format_string("%d data row(s) read with pipe delimiter", "n")),
    )
    missing = F.concat(F.lit("Missing: "), F.array_join("missing", ", "))
    checks = (
        F.when(~F.col("is_there"), F.array(issue("error", "file_exists", "Expected file is missing")))
        .when(F.size("missing") > 0, F.array(issue("error", "required_columns", missing)))
        .when(F.col("n") == 0, F.array(issue(F.col("empty_severity"), "row_count", "No data rows found")))
        .otherwise(F.filter(found, lambda i: i.isNotNull()))
    )
    return every.select("file_name", F.inline(checks)).select(*ISSUE_COLUMNS)


def audit_exit(issues: DataFrame) -> DataFrame:
    """One row: errors, warnings, and the exit flag 1 where there is any error."""
    error = F.col("severity") == "error"
    return issues.agg(
        F.count_if(error).alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    ).withColumn("exit_flag", (F.col("errors") > 0).cast("int"))


def without_failed(records: DataFrame, issues: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Records of the tables that have no error.

    The failed list has at most one row per audited table, so it is broadcast.
    """
    failed = issues.filter(F.col("severity") == "error").select(F.col("file_name").alias(file_name)).distinct()
    return records.join(F.broadcast(failed), file_name, "left_anti")


@dataclass(frozen=True)
class Published:
    """A published table under its gate; ``header`` is the first line of its file."""

    dataset: str
    rows: DataFrame
    url_column: str
    expected_rows: int
    expected_columns: int
    header: str | None = None


def publication_gate(tables: list[Published]) -> DataFrame:
    """Per published table: delimiter, index columns, shape and provenance."""
    checked = []
    for table in tables:
        names = table.rows.columns
        no_index = not any(name.lower().startswith("unnamed") for name in names)
        counted = table.rows.agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.coalesce(F.col(table.url_column).cast("string"), F.lit("")) == "").alias("missing_urls"),
        )
        checked.append(
            counted.select(
                F.lit(table.dataset).alias("dataset"),
                F.col("n_rows"),
                F.lit(len(names)).alias("n_columns"),
                F.lit("|" in (table.header or "|".join(names))).alias("pipe_delimiter"),
                F.lit(no_index).alias("no_exported_index"),
                ((F.col("n_rows") == table.expected_rows) & F.lit(len(names) == table.expected_columns)).alias(
                    "shape_correct"
                ),
                F.lit(table.url_column).alias("source_field"),
                F.col("missing_urls"),
            )
        )
    return merge_by_name(checked)


def gate_passes(gate: DataFrame) -> DataFrame:
    """One row: whether every check of every table holds."""
    return gate.agg(
        F.bool_and("pipe_delimiter").alias("pipe_delimiter"),
        F.bool_and("no_exported_index").alias("no_exported_index"),
        F.bool_and("shape_correct").alias("shape_correct"),
        F.bool_and(F.col("missing_urls") == 0).alias("provenance"),
    )
