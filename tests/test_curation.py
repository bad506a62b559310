import csv
import re

import pytest
from pyspark.sql import functions as F

from recordmill.plans.curation import ORDER, collected, curate, curate_with_log, log_lines
from recordmill.operators.columns import merge_by_name
from recordmill.operators.dedupe import distinct_rows
from recordmill.plans.publish import audit_folder, audit_report, default_sources, frames_of, gate_folder, publish, raw_frames, raw_tables
from recordmill.plans.published import Place, news_spec, projects_spec, resources_spec
from recordmill.sources.pipe_csv import read_pipe_csv

PLACE = Place(town="Rivertown", council="Rivertown Town Council", constituency="Lake Constituency")
PROJECTS = """council|constituency|serial_number_raw|ward_raw|project_name_raw|status_raw|year_raw|funding_source_raw|amount_zmw_raw|source_title|source_url|extraction_note
Rivertown TC||1|kasaba|Paint   2×2 hall|Completed / ready|FY2025|||MINUTES 2025|https://r.example/m.pdf|table
Rivertown TC||1|kasaba|Paint 2×2 hall|Completed / ready|FY2025|||MINUTES 2025|https://r.example/m.pdf|table
Other Council|Hill|2|all wards|Road|ONGOING|1998/99|World fund|K2,800,000|||table
||3||||||||||
"""
ACTIVITIES = """council|activity_type_raw|year_raw|description_raw|amount_zmw_raw|quantity_raw|ward_raw|source_type|source_url
|road works / district-wide|2026|Roads opened|>3000000|4 bridges|A; B; hill side|Council news|https://r.example/?p=1
"""
RESOURCES = """council|category|year_raw|document_title_raw|document_url|file_type|source_page|retrieved_at_utc
x rivertown|community_projects|2025|List 2025|https://r.example/l.pdf|PDF|https://r.example/?page_id=1|2026-09-11T15:58:03+00:00
x rivertown|community_projects|2025|List 2025|https://r.example/l.pdf|PDF|https://r.example/?page_id=1|2026-09-11T15:58:11+00:00
"""
NEWS = """council|title_raw|published_date_raw|excerpt_raw|article_url|source_listing_page|article_text_raw|linked_document_urls|retrieved_at_utc
|Grants|September 3, 2026|short|https://r.example/?p=9|https://r.example/?cat=1|A 7.5-million-kwacha prize|a;b|2026-09-11T23:30:00-02:00
"""


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in {"cdf_projects_seed": PROJECTS, "cdf_activities_seed": ACTIVITIES, "resource_index": RESOURCES, "news": NEWS}.items():
        (folder / f"{name}.csv").write_bytes(b"\xef\xbb\xbf" + text.encode("utf-8"))
    return str(folder)


def test_projects_golden(spark, raw):
    sources = default_sources(PLACE)["cdf_projects"]
    frames = raw_frames(spark, raw, sources)
    out = curate(list(frames.values()), sources.spec)
    assert len(out.columns) == 30 and out.columns[:2] == ["record_id", "record_kind"]
    got = [r.asDict() for r in out.orderBy("record_id").collect()]
    clean = [
        "record_id", "record_kind", "council_clean", "constituency_clean", "ward_clean", "project_name_clean", "project_type_clean",
        "status_clean", "year_clean", "amount_zmw_raw_kept", "amount_zmw", "funding_source_clean", "source_title_clean", "source_url_clean",
    ]
    fund = "Constituency Development Fund (CDF)"
    assert [tuple(r[c] for c in clean) for r in got] == [
        ("CDF0001", "project", PLACE.council, PLACE.constituency, "Kasaba", "Paint 2×2 hall", "", "Unknown", "2025", "", None, fund,
         "MINUTES 2025", "https://r.example/m.pdf"),
        ("CDF0002", "project", "Other Council", "Hill", "All Wards", "Road", "", "In progress", "1998", "K2,800,000", 2800000.0,
         "World fund", "", ""),
        ("CDF0003", "activity", PLACE.council, PLACE.constituency, "A; B; Hill Side", "Roads opened", "Road Works / District-Wide",
         "Unknown", "2026", ">3000000", 3000000.0, fund, "Council news", "https://r.example/?p=1"),
    ]
    assert got[0]["project_name_raw"] == "Paint 2×2 hall" and got[0]["quantity_raw"] is None and got[2]["extraction_note"] is None
    log = [r.line for r in log_lines(frames, sources.spec).orderBy("seq").collect()]
    assert log == [
        "CDF projects: loaded projects seed (4 rows)", "CDF projects: loaded activities seed (1 rows)",
        "CDF projects: dropped 1 unusable row(s).", "CDF projects: removed 1 exact duplicate row(s).",
        "WROTE cdf_projects (3 rows x 30 cols)",
    ]


def test_distinct_rows_of_files_are_hash_aggregated(spark, raw):
    """The order of rows in files is a number, so no wide row is sorted for it."""
    sources = default_sources(PLACE)["cdf_projects"]
    merged = merge_by_name(list(raw_frames(spark, raw, sources).values()))
    plan = distinct_rows(merged, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_new_fetch_is_no_duplicate(spark, raw):
    sources = default_sources(PLACE)["council_resources"]
    out = curate(list(raw_frames(spark, raw, sources).values()), sources.spec).orderBy("record_id").collect()
    assert len(out[0]) == 17 and [r.record_id for r in out] == ["RES0001", "RES0002"]
    assert out[0].retrieved_at_utc_clean == "2026-09-11T15:58:03Z" and out[0].category_clean == "Community Projects"
    assert (out[0].file_type_clean, out[0].council_clean) == ("pdf", PLACE.council)


def test_news_golden(spark, raw):
    sources = default_sources(PLACE)["news"]
    (row,) = curate(list(raw_frames(spark, raw, sources).values()), sources.spec).collect()
    assert len(row) == 20
    assert (row.record_id, row.published_date_clean, row.mentioned_amount_zmw, row.retrieved_at_utc_clean) == (
        "NEWS0001", "2026-09-03", 7500000.0, "2026-09-12T01:30:00Z",
    )


def test_publish_writes_plain_files_and_is_repeatable(spark, raw, tmp_path):
    logs = [publish(spark, raw, str(tmp_path / f"out{i}"), PLACE).collect() for i in range(2)]
    assert logs[0] == logs[1] and [r.line for r in logs[0]][-1] == "WROTE news (1 rows x 20 cols)"
    written = [p for p in (tmp_path / "out0" / "cleaning_log").glob("part-*") if p.stat().st_size]
    assert "".join(p.read_text() for p in written).splitlines() == [r.line for r in logs[0]]

    def read(i):
        lines = []
        for part in sorted((tmp_path / f"out{i}" / "cdf_projects").glob("part-*.csv")):
            with part.open(encoding="utf-8", newline="") as stream:
                lines += list(csv.DictReader(stream, delimiter="|"))
        return sorted(lines, key=lambda r: r["record_id"])

    assert read(0) == read(1)
    assert [r["amount_zmw"] for r in read(0)] == ["", "2800000.0", "3000000.0"]
    again = read_pipe_csv(spark, str(tmp_path / "out0" / "cdf_projects"), [])
    assert again.filter("amount_zmw <> '' and try_cast(amount_zmw as double) is null").isEmpty()


def test_missing_and_empty_inputs(spark, tmp_path):
    (tmp_path / "news.csv").write_text(NEWS.splitlines()[0] + "\n", encoding="utf-8")
    log = publish(spark, str(tmp_path), str(tmp_path / "out"), PLACE)
    assert [r.line for r in log.orderBy("seq").collect()] == [
        "No CDF source files found - skipping.", "Council resources: no live file found.", "News: loaded 0 rows.",
        "News: dropped 0 unusable row(s).", "News: removed 0 exact duplicate row(s).", "SKIP news: no rows.",
    ]
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["cleaning_log"]
    assert publish(spark, str(tmp_path / "nowhere"), str(tmp_path / "out2"), PLACE).count() == 3


def test_files_may_have_a_prefix(spark, tmp_path):
    (tmp_path / "p-news.csv").write_text(NEWS, encoding="utf-8")
    log = publish(spark, str(tmp_path), str(tmp_path / "out"), PLACE, prefix="p-")
    assert "WROTE news (1 rows x 20 cols)" in [r.line for r in log.collect()]
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"p-news", "p-cleaning_log"}
    assert audit_report(spark, str(tmp_path), str(tmp_path / "report"), prefix="p-") == 1
    gate = gate_folder(spark, str(tmp_path / "out"), {"news": ("article_url_clean", 1, 20)}, prefix="p-").first()
    assert gate.shape_correct and gate.pipe_delimiter and gate.no_exported_index and gate.missing_urls == 0


def test_tables_with_an_error_are_not_published(spark, raw, tmp_path):
    (tmp_path / "news.csv").write_text(NEWS.splitlines()[0] + "\n", encoding="utf-8")
    (tmp_path / "resource_index.csv").write_text(RESOURCES, encoding="utf-8")
    log = publish(spark, str(tmp_path), str(tmp_path / "out"), PLACE, issues=audit_folder(spark, str(tmp_path)))
    assert all(r.line.startswith(("Council resources", "WROTE council_resources")) for r in log.collect())
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"council_resources", "cleaning_log"}


def test_raw_files_that_fail_their_contract_are_left_out_by_default(spark, raw, tmp_path):
    (tmp_path / "news.csv").write_text(NEWS.replace("article_url", "address"), encoding="utf-8")
    (tmp_path / "resource_index.csv").write_text(RESOURCES, encoding="utf-8")
    log = [r.line for r in publish(spark, str(tmp_path), str(tmp_path / "out"), PLACE).orderBy("seq").collect()]
    assert log[-1] == "GATE news: left out, news.csv: Missing: article_url"
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"council_resources", "cleaning_log"}
    publish(spark, str(tmp_path), str(tmp_path / "all"), PLACE, gate=False)
    assert {p.name for p in (tmp_path / "all").iterdir()} == {"council_resources", "news", "cleaning_log"}


def test_seed_rows_stand_in_for_missing_live_rows(spark, tmp_path):
    head = RESOURCES.splitlines()[0].split("|")
    place = {n: k for k, n in enumerate(head)}

    def lines(*rows):
        made = []
        for title, url in rows:
            cells = [""] * len(head)
            cells[place["document_title_raw"]], cells[place["document_url"]] = title, url
            made.append("|".join(cells))
        return "\n".join(["|".join(head), *made]) + "\n"

    (tmp_path / "resource_index.csv").write_text(lines(("Live", "u1"), ("No url", "")), encoding="utf-8")
    (tmp_path / "resource_index_seed.csv").write_text(lines(("Old", "u1"), ("Seed", "u2"), ("Unproven", "")), encoding="utf-8")

    def titles(out, **options):
        log = publish(spark, str(tmp_path), str(tmp_path / out), PLACE, **options)
        path = tmp_path / out / "council_resources"
        rows = read_pipe_csv(spark, str(path), []).orderBy("record_id").collect() if path.exists() else []
        return [r.document_title_clean for r in rows], [r.line for r in log.collect() if "loaded" in r.line]

    assert titles("a")[0] == ["Live", "No url"]
    assert titles("b", seed_fallback=True) == (["Live", "No url", "Seed"], ["Council resources: loaded 3 rows."])
    (tmp_path / "resource_index.csv").write_text(lines(), encoding="utf-8")
    assert titles("c", seed_fallback=True)[0] == ["Old", "Seed"]
    (tmp_path / "resource_index.csv").unlink()
    assert titles("d", seed_fallback=True)[0] == ["Old", "Seed"] and titles("e")[0] == []


def test_publishing_reads_each_raw_file_once(spark, raw, tmp_path, monkeypatch):
    from recordmill.plans import publish as plan

    settled, real = [], plan.settle
    monkeypatch.setattr(plan, "settle", lambda df: settled.append(df.inputFiles()) or real(df))
    publish(spark, raw, str(tmp_path / "out"), PLACE)
    files = [f for own in settled for f in own]
    assert len(files) == len(set(files)) == 4
    # what follows reads settled tables alone
    tables = raw_tables(spark, raw, ["news"])
    table, log = curate_with_log(frames_of(tables, default_sources(PLACE)["news"]), default_sources(PLACE)["news"].spec)
    assert not any(f.endswith(".csv") for f in [*table.inputFiles(), *log.inputFiles()])


def test_the_first_records_come_from_the_first_ranges(spark):
    base = spark.range(5000).select("id", F.concat(F.lit("T "), F.col("id").cast("string")).alias("document_title_raw"), F.lit("").alias("document_url"))
    raw_rows = collected(base.repartition(20), F.col("id")).drop("id")
    few = curate([raw_rows], resources_spec(PLACE), first=10)
    assert sorted((r.record_id, r.document_title_clean) for r in few.collect()) == [(f"RES{i + 1:04d}", f"T {i}") for i in range(10)]
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "_range" in plan
    assert curate([raw_rows.limit(0)], resources_spec(PLACE), first=10).collect() == []


def test_audit_of_a_folder(spark, raw):
    found = {(r.file_name, r.severity, r.check): r.details for r in audit_folder(spark, raw).collect()}
    assert found[("resource_index.csv", "warning", "duplicate_url")] == "1 repeated document_url value(s)"
    assert found[("cdf_projects_seed.csv", "warning", "provenance_url")] == "2/4 rows have no source_url"
    assert found[("news_seed.csv", "error", "file_exists")] == "Expected file is missing"
    assert found[("news.csv", "pass", "row_count")] == "1 data row(s) read with pipe delimiter"


@pytest.mark.parametrize("partitions", [1, 200])
def test_curation_does_not_depend_on_partitions(spark, partitions):
    base = spark.range(500).select(
        "id", F.lit(" the  Council").alias("council"), F.concat(F.lit("T "), (F.col("id") % 300).cast("string")).alias("document_title_raw"),
        F.lit("").alias("document_url"), F.lit("2025").alias("year_raw"), F.lit("a_b").alias("category"),
    )
    raw = collected(base.repartition(partitions), F.col("id")).drop("id")
    out = curate([raw], resources_spec(PLACE)).orderBy("record_id").collect()
    assert [(r.record_id, r.document_title_clean) for r in out] == [(f"RES{i + 1:04d}", f"T {i}") for i in range(300)]
    assert all(re.fullmatch(r"|\d{4}", r.year_clean) for r in out)


def test_specs_allow_absent_columns(spark):
    only = collected(spark.createDataFrame([("t", 1)], "title_raw string, o int"), F.col("o")).drop("o")
    (row,) = curate([only], news_spec(PLACE)).collect()
    assert (row.title_clean, row.article_url_clean, row.mentioned_amount_zmw) == ("t", "", None)
    (project,) = curate([collected(only.drop("_input_order").withColumn("project_name_raw", F.lit("p")).withColumn("o", F.lit(1)),
                                   F.col("o"), record_kind="project")], projects_spec(PLACE)).collect()
    assert (project.status_clean, project.project_name_clean) == ("Unknown", "p")
