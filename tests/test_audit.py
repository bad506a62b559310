from pyspark.sql import functions as F

from recordmill.operators import audit as A
from recordmill.operators.audit import REQUIRED_COLUMNS, Collected, Published

RESOURCE = "council string, category string, document_title_raw string, document_url string, source_page string"


def issues(spark, *tables):
    return [tuple(r) for r in A.audit(spark, list(tables)).collect()]


def resource(spark, urls):
    return spark.createDataFrame([("c", "k", "t", u, "p") for u in urls], RESOURCE)


def test_missing_file_and_columns_end_the_checks(spark):
    short = spark.createDataFrame([("a",)], "council string")
    assert issues(
        spark,
        Collected("news.csv", None, REQUIRED_COLUMNS["news"]),
        Collected("cdf_projects_seed.csv", short, REQUIRED_COLUMNS["cdf_projects_seed"]),
    ) == [
        ("news.csv", "error", "file_exists", "Expected file is missing"),
        ("cdf_projects_seed.csv", "error", "required_columns", "Missing: project_name_raw, source_url, ward_raw"),
    ]


def test_no_rows_is_an_error_but_a_warning_for_seeds(spark):
    empty = resource(spark, [])
    required = REQUIRED_COLUMNS["resource_index"]
    assert issues(spark, Collected("resource_index.csv", empty, required), Collected("resource_index_seed.csv", empty, required)) == [
        ("resource_index.csv", "error", "row_count", "No data rows found"),
        ("resource_index_seed.csv", "warning", "row_count", "No data rows found"),
    ]


def test_provenance_and_duplicates(spark):
    df = resource(spark, ["u", " u ", "v", "v", "v", "w", "", None, "  "])
    assert issues(spark, Collected("resource_index.csv", df, REQUIRED_COLUMNS["resource_index"])) == [
        ("resource_index.csv", "warning", "provenance_url", "3/9 rows have no document_url"),
        ("resource_index.csv", "warning", "duplicate_url", "2 repeated document_url value(s)"),
        ("resource_index.csv", "pass", "row_count", "9 data row(s) read with pipe delimiter"),
    ]
    projects = df.select(F.col("council"), F.lit("w").alias("ward_raw"), F.lit("n").alias("project_name_raw"), F.col("document_url").alias("source_url"))
    assert issues(spark, Collected("cdf_projects_seed.csv", projects, REQUIRED_COLUMNS["cdf_projects_seed"])) == [
        ("cdf_projects_seed.csv", "warning", "provenance_url", "3/9 rows have no source_url"),
        ("cdf_projects_seed.csv", "pass", "row_count", "9 data row(s) read with pipe delimiter"),
    ]


def test_exit_flag_and_gate(spark):
    found = A.audit(spark, [Collected("news.csv", None), Collected("resource_index.csv", resource(spark, ["u", ""]))])
    assert [tuple(r) for r in A.audit_exit(found).collect()] == [(1, 1, 1)]
    records = spark.createDataFrame([("news.csv", 1), ("resource_index.csv", 2)], "file_name string, n int")
    assert [tuple(r) for r in A.without_failed(records, found).collect()] == [("resource_index.csv", 2)]
    clean = A.audit(spark, [Collected("resource_index.csv", resource(spark, ["u"]))])
    assert [tuple(r) for r in A.audit_exit(clean).collect()] == [(0, 0, 0)]
    assert A.without_failed(records, clean).count() == 2


def test_publication_gate(spark):
    good = spark.createDataFrame([("a", "u"), ("b", "v")], "name string, url string")
    bad = spark.createDataFrame([(1, "", "x"), (2, None, "y")], "`Unnamed: 0` int, url string, z string")
    gate = A.publication_gate(
        [Published("good", good, "url", 2, 2, header="name|url"), Published("bad", bad, "url", 3, 3, header="a,b")]
    )
    got = {r.dataset: r.asDict() for r in gate.collect()}
    assert got["good"]["shape_correct"] and got["good"]["missing_urls"] == 0 and got["good"]["pipe_delimiter"]
    assert not got["bad"]["shape_correct"] and got["bad"]["missing_urls"] == 2
    assert not got["bad"]["no_exported_index"] and not got["bad"]["pipe_delimiter"]
    assert tuple(A.gate_passes(gate).first()) == (False, False, False, False)
    assert tuple(A.gate_passes(gate.filter("dataset = 'good'")).first()) == (True, True, True, True)


def test_many_files_are_audited_by_one_plan(spark, tmp_path):
    from recordmill.plans.publish import audit_files

    head = "council|category|document_title_raw|document_url|source_page"
    texts = {
        "resource_index.csv": "\ufeff" + head + '\nc|k|"a|""b"|u1|p\nc|k|t| u1 |p\nc|k|t||p\n',
        "resource_index_01.csv": "source_page|document_url|document_title_raw|category|council\np|u1|t|k|c\n",
        "resource_index_02.csv": "council|category\nc|k\n",
        "resource_index_seed.csv": head + "\n",
        "resource_index-7.csv": "",
        "cdf_projects_seed.csv": "council|ward_raw|project_name_raw|source_url\nc|w|p|u\nc|w|q|u\nc|w|r|  \n",
        "news.csv": "council|title_raw|article_url|source_listing_page\nc|t|u|l\n\n",
        "notes.csv": "a\n1\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = sorted(tuple(r) for r in audit_files(spark, f"{tmp_path}/*.csv").collect())
    every = "Missing: category, council, document_title_raw, document_url, source_page"
    assert got == sorted([
        ("resource_index.csv", "warning", "provenance_url", "1/3 rows have no document_url"),
        ("resource_index.csv", "warning", "duplicate_url", "1 repeated document_url value(s)"),
        ("resource_index.csv", "pass", "row_count", "3 data row(s) read with pipe delimiter"),
        ("resource_index_01.csv", "pass", "row_count", "1 data row(s) read with pipe delimiter"),
        ("resource_index_02.csv", "error", "required_columns", "Missing: document_title_raw, document_url, source_page"),
        ("resource_index-7.csv", "error", "required_columns", every),
        ("resource_index_seed.csv", "warning", "row_count", "No data rows found"),
        ("cdf_projects_seed.csv", "warning", "provenance_url", "1/3 rows have no source_url"),
        ("cdf_projects_seed.csv", "pass", "row_count", "3 data row(s) read with pipe delimiter"),
        ("news.csv", "pass", "row_count", "1 data row(s) read with pipe delimiter"),
        ("news_seed.csv", "error", "file_exists", "Expected file is missing"),
        ("cdf_activities_seed.csv", "error", "file_exists", "Expected file is missing"),
    ])

    def nodes():
        plan = audit_files(spark, f"{tmp_path}/*.csv")._jdf.queryExecution().optimizedPlan().toString()
        return len(plan.splitlines())

    few = nodes()
    for k in range(40):
        (tmp_path / f"news_{k}.csv").write_text(texts["news.csv"], encoding="utf-8")
    assert nodes() == few
    assert audit_files(spark, f"{tmp_path / 'none'}/*.csv").count() == 6


def test_rows_of_one_file_are_dealt_by_url(spark):
    rows = spark.range(0, 1000, 1, 8).selectExpr("if(id % 2 = 0, 'x_news.csv', 'x_news_seed.csv') AS file_name", "array(concat('u', id % 400)) AS cells")
    headers = spark.createDataFrame([("x_news.csv", ["article_url"]), ("x_news_seed.csv", ["article_url"])], "file_name string, names array<string>")
    asked = {"news": ("article_url",), "news_seed": ("article_url",)}
    contracts = A.file_contracts(headers, A.contract_table(spark, asked, "x_"), "x_")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = A.file_counts(rows, contracts)
        assert sorted(tuple(r) for r in counts.collect()) == [("x_news.csv", 500, 0, 200), ("x_news_seed.csv", 500, 0, 200)]
        plan = counts._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "Join" in line and "Inner" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
