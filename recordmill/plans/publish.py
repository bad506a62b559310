"""Collected files to published files, with audit, gate and run log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.operators.audit import (
    ISSUE_COLUMNS,
    REQUIRED_COLUMNS,
    Collected,
    Published,
    audit,
    audit_exit,
    contract_issues,
    contract_table,
    file_contracts,
    file_counts,
    file_headers,
    publication_gate,
)
from recordmill.operators.columns import merge_by_name
from recordmill.operators.joins import live_then_seed
from recordmill.plans.curation import CurationSpec, collected, curate_with_log, log_lines
from recordmill.plans.published import Place, news_spec, projects_spec, resources_spec
from recordmill.session import release, settle, settled_tables
from recordmill.sources.catalog import read_catalog
from recordmill.sources.pipe_csv import (
    FILE_ORDER,
    first_lines,
    header_line,
    listed_tables,
    read_all_tables,
    read_pipe_csv,
    try_read_pipe_csv,
)
from recordmill.sources.sinks import write_pipe_csv, write_unless_empty


@dataclass(frozen=True)
class Sources:
    """Raw tables of one published table: dataset name, its name in the log, constant tags, in order.

    ``seed`` names the dataset that stands in for what a live table lacks, and the column that tells.
    """

    spec: CurationSpec
    inputs: tuple[tuple[str, str, dict[str, str]], ...]
    seed: tuple[str, str] | None = None


def default_sources(place: Place) -> dict[str, Sources]:
    return {
        "cdf_projects": Sources(
            projects_spec(place),
            (
                ("cdf_projects_seed", "projects seed", {"record_kind": "project"}),
                ("cdf_activities_seed", "activities seed", {"record_kind": "activity"}),
            ),
        ),
        "council_resources": Sources(
            resources_spec(place), (("resource_index", "resources", {}),), ("resource_index_seed", "document_url")
        ),
        "news": Sources(news_spec(place), (("news", "news", {}),), ("news_seed", "article_url")),
    }


def audit_files(
    spark: SparkSession,
    pattern: str,
    contract: dict[str, tuple[str, ...]] = REQUIRED_COLUMNS,
    prefix: str = "",
    **read_options,
) -> DataFrame:
    """Issue table over all files that match a path pattern, any number of each kind of the contract.

    A file is of the kind its name says: ``prefix``, the kind, a number if there are several,
    ``.csv``. Files of no kind are not audited, a kind without a file is an issue. The headers
    come from one scan of the files' first blocks, the counts from one scan of all rows, so
    the plan is the same for one file and for very many. The headers are settled.
    """
    asked = contract_table(spark, contract, prefix)
    files = listed_tables(spark, pattern)
    if files is None:
        none = spark.createDataFrame([], "file_name string, names array<string>")
        return contract_issues(file_contracts(none, asked, prefix), spark.createDataFrame([], _COUNTS))
    headers = settle(file_headers(files, first_lines(spark, pattern)))
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0  # one number
    contracts = file_contracts(headers, asked, prefix)
    return contract_issues(contracts, file_counts(read_all_tables(spark, pattern, width, **read_options), contracts))


_COUNTS = "file_name string, n long, blank long, repeated long"


def audit_folder(spark: SparkSession, folder: str, prefix: str = "", **read_options) -> DataFrame:
    """Issue table over the expected files of a raw folder; file names begin with ``prefix``."""
    return audit_files(spark, f"{folder}/{prefix}*.csv", prefix=prefix, **read_options)


def audit_report(spark: SparkSession, folder: str, report: str, prefix: str = "", **read_options) -> int:
    """Audit a raw folder, write the issues as pipe text to ``report``, return the exit flag."""
    write_pipe_csv(audit_folder(spark, folder, prefix, **read_options).coalesce(1), report, ISSUE_COLUMNS)
    return audit_exit(read_pipe_csv(spark, report, ISSUE_COLUMNS)).first()["exit_flag"]


def raw_tables(spark: SparkSession, folder: str, datasets: list[str], prefix: str = "", **read_options) -> dict[str, DataFrame]:
    """The raw files that exist by dataset, with their file order. Each is read once and settled as a table."""
    found = {d: try_read_pipe_csv(spark, f"{folder}/{prefix}{d}.csv", file_order=True, **read_options) for d in datasets}
    return {dataset: settle(rows) for dataset, rows in found.items() if rows is not None}


def frames_of(tables: dict[str, DataFrame], sources: Sources, seed_fallback: bool = False) -> dict[str, DataFrame]:
    """The raw tables that exist by their name in the log, in their order, ready for curation.

    With ``seed_fallback`` the seed's rows that have a URL, and one that the live table
    does not hold, follow the live rows; a live table without rows, or none, leaves all of them.
    """
    frames = {}
    for rank, (dataset, name, tags) in enumerate(sources.inputs):
        if dataset in tables:
            frames[name] = collected(tables[dataset], F.col(FILE_ORDER), rank, **tags).drop(FILE_ORDER)
    if seed_fallback and sources.seed and sources.seed[0] in tables and sources.seed[1] in tables[sources.seed[0]].columns:
        dataset, key = sources.seed
        seed = collected(tables[dataset], F.col(FILE_ORDER), len(sources.inputs)).drop(FILE_ORDER).filter(F.col(key) != "")
        name = sources.inputs[0][1]
        live = frames.get(name)
        frames[name] = seed if live is None or key not in live.columns else live_then_seed(live, seed, key)
    return frames


def raw_frames(
    spark: SparkSession, folder: str, sources: Sources, prefix: str = "", seed_fallback: bool = False, **read_options
) -> dict[str, DataFrame]:
    """``frames_of`` over the files of a folder."""
    datasets = [dataset for dataset, _, _ in sources.inputs]
    if seed_fallback and sources.seed:
        datasets.append(sources.seed[0])
    return frames_of(raw_tables(spark, folder, datasets, prefix, **read_options), sources, seed_fallback)


def issues_of(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "") -> DataFrame:
    """The audit of raw tables already read."""
    return audit(
        spark,
        [Collected(f"{prefix}{d}.csv", rows.drop(FILE_ORDER), REQUIRED_COLUMNS.get(d, ())) for d, rows in tables.items()],
    )


def failed_files(issues: DataFrame) -> dict[str, str]:
    """The audited files with an error, and what it says: at most one per expected file."""
    errors = issues.filter(F.col("severity") == "error").groupBy("file_name").agg(F.min("details").alias("details"))
    return {row.file_name: row.details for row in errors.collect()}


def publish(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    place: Place,
    issues: DataFrame | None = None,
    mode: str = "errorifexists",
    prefix: str = "",
    gate: bool = True,
    seed_fallback: bool = False,
    **read_options,
) -> DataFrame:
    """Curate each table whose raw files exist, write the non-empty ones and the run log, return the log.

    Each raw file is read once. ``gate`` audits what was read: a table whose raw file fails
    its contract is left out with a line that says so; a file without rows has its usual
    lines and writes nothing. The ``issues`` of an audit made before, if given, decide in
    its place: tables with any error in one of their files are left out. ``seed_fallback``
    is explained at ``frames_of``. Raw files and published tables are named with ``prefix``,
    ``read_options`` go to ``try_read_pipe_csv``. The log is ``(seq, line)``, also written
    as text to ``cleaning_log`` in ``out_folder``. Tables settled on the way are deleted.
    """
    begun, logs, wanted = settled_tables(), [], default_sources(place)
    failed = {} if issues is None else failed_files(issues)
    wanted = {
        name: (rank, sources)
        for rank, (name, sources) in enumerate(wanted.items())
        if not failed.keys() & {f"{prefix}{dataset}.csv" for dataset, _, _ in sources.inputs}
    }
    datasets = [dataset for _, sources in wanted.values() for dataset, _, _ in sources.inputs]
    if seed_fallback:
        datasets += [sources.seed[0] for _, sources in wanted.values() if sources.seed]
    tables = raw_tables(spark, raw_folder, datasets, prefix, **read_options)
    if gate and issues is None and tables:
        failed = failed_files(issues_of(spark, tables, prefix).filter(F.col("check") != "row_count"))
    for name, (rank, sources) in wanted.items():
        bad = [file for dataset, _, _ in sources.inputs if (file := f"{prefix}{dataset}.csv") in failed]
        if bad:
            line = f"GATE {sources.spec.table}: left out, {bad[0]}: {failed[bad[0]]}"
            logs.append(spark.createDataFrame([(1000 * rank, line)], "seq int, line string"))
            continue
        usable = {d: rows for d, rows in tables.items() if f"{prefix}{d}.csv" not in failed}
        frames = frames_of(usable, sources, seed_fallback)
        if frames:
            table, log = curate_with_log(frames, sources.spec)
            write_unless_empty(table, f"{out_folder}/{prefix}{name}", mode=mode)
        else:
            log = log_lines(frames, sources.spec)
        logs.append(log.withColumn("seq", F.col("seq") + 1000 * rank))
    if not logs:
        return spark.createDataFrame([], "seq int, line string")
    lines = merge_by_name(logs).orderBy("seq").collect()  # a few lines per table
    log = spark.createDataFrame([tuple(r) for r in lines], "seq int, line string").coalesce(1)
    log.sortWithinPartitions("seq").select("line").write.mode(mode).text(f"{out_folder}/{prefix}cleaning_log")
    release(spark, begun)
    return log


def gate_folder(
    spark: SparkSession, folder: str, expected: dict[str, tuple[str, int, int]], prefix: str = ""
) -> DataFrame:
    """``publication_gate`` over a published folder: tables are read back, their first line is probed.

    ``expected``: per table its source column, rows and columns.
    """
    paths = {label: f"{folder}/{prefix}{label}" for label in expected}
    tables = read_catalog(spark, paths)
    return publication_gate(
        [
            Published(label, rows, *expected[label], header=header_line(spark, paths[label]))
            for label, rows in tables.items()
        ]
    )
