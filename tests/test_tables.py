from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordmill.operators import columns, dedupe, filters, joins, listing, numbering, summary
from recordmill.session import release, settle, settled_tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_by_name_keeps_the_first_order(spark):
    a = spark.createDataFrame([("x", "1")], "name string, n string")
    b = spark.createDataFrame([("t", "y")], "extra string, name string")
    merged = columns.merge_by_name([a, b])
    assert merged.columns == ["name", "n", "extra"]
    assert sorted(map(str, rows(merged))) == sorted(map(str, [("x", "1", None), ("y", None, "t")]))
    assert columns.leading(merged, ["extra"]).columns == ["extra", "name", "n"]


def test_normalise_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(" a  b ", 1, None)], "s string, n int, t string")
    assert rows(columns.normalise_strings(df)) == [("a b", 1, "")]
    assert spark.range(1).select(columns.column_or_empty(df, "absent")).first()[0] == ""


def test_drop_unusable_keeps_either(spark):
    df = spark.createDataFrame([("a", ""), ("", "u"), ("", ""), ("b", "v")], "name string, url string")
    assert rows(filters.drop_unusable(df, "name", "url")) == [("", "u"), ("a", ""), ("b", "v")]


def test_distinct_rows_keep_first_order_and_equal_nulls(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", None, 2), ("a", "x", 9), ("b", None, 1)], "k string, v string, o int")
    kept = [tuple(r) for r in dedupe.distinct_rows(df, "o").orderBy("o").collect()]
    assert kept == [("b", None, 1), ("a", None, 2), ("a", "x", 9)]
    assert rows(dedupe.distinct_counts(df, "o")) == [(4, 3, 1)]


def test_first_by_key_drops_blank_keys(spark):
    data = [("u", 3, "late"), ("u", 1, "first"), ("", 0, "blank"), (None, 0, "null"), ("v", 2, "only")]
    df = spark.createDataFrame(data, "url string, o int, what string")
    assert rows(dedupe.first_by_key(df, "url", ["o"])) == [("u", 1, "first"), ("v", 2, "only")]
    assert rows(dedupe.repeated_keys(df, F.coalesce("url", F.lit("")))) == [(1,)]


LONG = [(1, "a", None), (2, "b", "x"), (3, "a", None), (4, None, "a"), (5, "b", "x"), (6, "c", "y"), (7, "", "z"), (8, None, "a"), (9, "b", "w")]


@pytest.mark.parametrize("collide", [False, True])
def test_long_rows_by_digest(spark, collide, monkeypatch):
    df = spark.createDataFrame(LONG, "o int, s string, t string").repartition(3)
    same = (lambda names: [F.lit(0).cast("long"), F.lit(0).cast("long")]) if collide else dedupe.digest_128
    first = sorted((r.o, r.s, r.t) for r in dedupe.distinct_long_rows(df, "o", same).collect())
    assert first == [(1, "a", None), (2, "b", "x"), (4, None, "a"), (6, "c", "y"), (7, "", "z"), (9, "b", "w")]
    keyed = sorted((r.o, r.s) for r in dedupe.first_by_long_key(df, "s", ["o"], same).collect())
    assert keyed == [(1, "a"), (2, "b"), (6, "c")]
    monkeypatch.setattr(dedupe, "SENT_DIGESTS", 0)
    assert dedupe.distinct_long_rows(df, "o", same).count() == 6


def test_rows_that_are_alone_are_not_shuffled(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("pad"), (F.col("id") % 97).cast("string").alias("text"))
    alone, shared = dedupe._parted(df, ["text"], dedupe.digest_128)
    assert (alone.count(), shared.count()) == (94, 6)
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_first_by_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.first_by_key(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:], plan


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_numbers_are_dense_whatever_the_partitions(spark, partitions):
    n = 12_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k")).repartition(partitions)
    numbered = numbering.add_record_id(df, "R", ["k"])
    assert numbered.columns == ["record_id", "k"]
    got = dict((r.k, r.record_id) for r in numbered.collect())
    assert got == {k: f"R{k + 1:04d}" for k in range(n)}


def test_numbers_spread_a_tied_order(spark):
    """A third of the rows share one order value; they are numbered by content over several ranges."""
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("o"), "id")
    numbered = numbering.number_rows(df, ["o"], "n")
    assert numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, n, n)
    ordered = numbered.agg(F.max(F.when(F.col("o") == 0, F.col("n"))), F.min(F.when(F.col("o") > 0, F.col("n")))).first()
    assert ordered[0] == n // 3 and ordered[1] == n // 3 + 1


def test_settled_table_is_columnar_and_equal(spark):
    df = spark.createDataFrame([(1, "a", None)], "n int, s string, d double")
    again = settle(df)
    assert again.schema.simpleString() == df.schema.simpleString() and rows(again) == rows(df)
    assert "ReadSchema: struct<n:int>" in again.select("n")._jdf.queryExecution().executedPlan().toString()
    assert settle(df.limit(0)).isEmpty()


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_lookup_join_with_a_hot_key(spark, how):
    """One key holds a third of the rows, and blank keys match nothing."""
    n = 6000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    facts = spark.range(n).select(key.alias("k"), "id")
    lookup = spark.createDataFrame([("hot", "H"), ("k1", "one"), ("k2", None), ("unused", "x")], "k string, v string")
    found = joins.lookup_join(facts, lookup, "k", how)
    plain = facts.join(lookup, "k", how).select(*found.columns)
    assert found.count() == plain.count() and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


@pytest.mark.parametrize("value", ["", None])
def test_blank_keys_are_spread_over_tasks(spark, value):
    """Without broadcasts and run-time splitting no task of the join holds more than a small part of them."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 30_000
        facts = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(F.col("id").cast("string")).alias("k"), "id")
        lookup = facts.select("k").distinct().withColumn("v", F.lit(1))
        joined = joins.lookup_join(facts, lookup, "k")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == n and max(sizes) < n / 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_join_reads_the_facts_once(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) as k", "id").write.parquet(str(tmp_path / "facts"))
    lookup = spark.createDataFrame([("1", "one")], "k string, v string")
    joined = joins.lookup_join(spark.read.parquet(str(tmp_path / "facts")), lookup, "k")
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_enrich_keeps_one_row_per_record(spark):
    records = spark.createDataFrame([("a", "x"), ("", "y"), ("", "y")], "url string, t string")
    details = spark.createDataFrame([("a", "2"), ("a", "1"), ("", "none")], "url string, body string")
    assert rows(joins.enrich(records, details, "url")) == [("", "y", ""), ("", "y", ""), ("a", "x", "1")]


def test_settled_tables_are_deleted(spark):
    begun = settled_tables()
    path = settle(spark.range(3)).inputFiles()[0]
    assert Path(path.removeprefix("file://")).exists() and settled_tables() == begun + 1
    release(spark, begun)
    assert not Path(path.removeprefix("file://")).exists() and settled_tables() == begun


def test_enrich_leaves_blanks(spark):
    records = spark.createDataFrame([("a", "", "x"), ("b", "", "y")], "url string, body string, t string")
    details = spark.createDataFrame([("a", "text")], "url string, body string")
    got = joins.enrich(records, details, "url")
    assert got.columns == ["url", "t", "body"] and rows(got) == [("a", "x", "text"), ("b", "y", "")]


def test_live_then_seed(spark):
    live = spark.createDataFrame([("u1", "live"), ("", "live")], "url string, o string")
    seed = spark.createDataFrame([("u1", "s1"), ("u2", "s2"), ("", "s3")], "url string, o string")
    assert rows(joins.live_then_seed(live, seed, "url")) == [("", "live"), ("", "s3"), ("u1", "live"), ("u2", "s2")]


def test_take_while_stops_before_the_first_hit(spark):
    log = spark.createDataFrame(
        [("a", 1, 5, False), ("a", 2, 0, False), ("a", 3, 4, False), ("b", 1, 0, False), ("c", 1, 2, False),
         ("c", 2, 2, True), ("d", 1, 1, False), ("d", 2, 1, False), ("d", 11, 1, False), ("e", 1, 1, False), ("e", 11, 0, True)],
        "listing string, page int, n_records int, failed boolean",
    )
    expected = [("a", 1), ("c", 1), ("d", 1), ("d", 2), ("d", 11), ("e", 1)]
    assert rows(listing.listing_pages(log).select("listing", "page")) == expected
    bounded = listing.listing_pages(log, 10).select("listing", "page")
    assert rows(bounded) == [r for r in expected if r[1] <= 10]


def test_summaries(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "x"), ("b", ""), (None, "2")], "k string, v string")
    assert [tuple(r) for r in summary.value_distribution(df, F.col("k")).collect()] == [("a", 2), ("b", 1), (None, 1)]
    assert rows(summary.numeric_summary(df, F.col("v"))) == [(2, 4, 3.5, "3.50")]
    assert rows(summary.dataset_summary({"L": ("f", df)})) == [("L", "f", 4, 2)]
    meta = summary.run_metadata(df, df.limit(0), "C", ["a", "b"], "n", run_at=F.lit("now"))
    assert rows(meta) == [("now", "C", 4, 0, "a;b", "n")]
    ids = spark.createDataFrame([("R10000",), ("R9999",), ("R0001",)], "record_id string")
    assert [r[0] for r in summary.preview(ids, ["record_id"], 2).collect()] == ["R0001", "R9999"]
