import pytest

from recordmill.functions import amounts, dates

AMOUNTS = {
    "2256000": 2256000.0,
    ">3000000": 3000000.0,
    "K2,800,000": 2800000.0,
    "2.8 million": 2800000.0,
    "K2.8 million": 2800000.0,
    "2.8-million-kwacha": None,
    "5k": 5000.0,
    "5 k": 5.0,
    "K2.8m": 2.8,
    "17 projects; 19 classrooms": 1719.0,
    "5 thousand": 5.0,
    "2024-2025": None,
    "1.2.3": None,
    "--": None,
    "2 m": 2e6,
    "1 billion": 1e9,
    "ZMW 500": 500.0,
    "5m million": 5e12,
    "k k": None,
    "-.": None,
    "5.": 5.0,
    ".5": 0.5,
    "-7": -7.0,
    "": None,
    None: None,
    "not stated": None,
    "1 billion million": 1e9,
    "Zambian   Kwacha 7": 7.0,
}
MENTIONS = {
    "a 2.8-million-kwacha fund": 2800000.0,
    "2,800,000 kwacha": 800000.0,
    "3 BILLION  Kwacha": 3e9,
    "2,8 kwacha": 28.0,
    "5 - - million - kwacha": 5e6,
    "K30 million": None,
    "kwacha": None,
    "12 groups shared 7 kwacha": 7.0,
    "": None,
    None: None,
}
STAMPS = {
    "2026-09-11T15:58:03+00:00": "2026-09-11T15:58:03Z",
    "2026-09-11T23:30:00-02:00": "2026-09-12T01:30:00Z",
    "2026-09-11T00:10:00+0530": "2026-09-10T18:40:00Z",
    "2026-09-11 10:00": "2026-09-11T10:00:00Z",
    "2026-09-11T10:00:00.987Z": "2026-09-11T10:00:00Z",
    "2026-03-29T02:30:00": "2026-03-29T02:30:00Z",
    "2026-09-11": "2026-09-11T00:00:00Z",
    "September 3, 2026": "2026-09-03T00:00:00Z",
    "sep 3, 2026": "2026-09-03T00:00:00Z",
    "3 September 2026": "2026-09-03T00:00:00Z",
    "3 Sept 2026": "2026-09-03T00:00:00Z",
    "03/09/2026": "2026-03-09T00:00:00Z",
    "13/09/2026": "2026-09-13T00:00:00Z",
    "13-09-2026": "2026-09-13T00:00:00Z",
    "9-3-2026": "2026-09-03T00:00:00Z",
    "2024-02-29": "2024-02-29T00:00:00Z",
    "2026-02-29": "",
    "32/13/2026": "",
    "3/9-2026": "",
    "soon": "",
    "Foo 3, 2026": "",
    "": "",
    None: "",
}


def test_parse_amount(apply):
    assert apply(amounts.parse_amount, list(AMOUNTS)) == list(AMOUNTS.values())


def test_mentioned_amount(apply):
    assert apply(amounts.mentioned_amount, list(MENTIONS)) == list(MENTIONS.values())


def test_mentioned_amount_on_long_runs(apply):
    text = "1" * 20000 + " " * 20000 + "- " * 5000 + "kwacha"
    assert apply(amounts.mentioned_amount, ["9" * 30000 + " no unit", text]) == [None, float("1" * 20000)]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, apply, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(dates.timestamp_iso, list(STAMPS)) == list(STAMPS.values())
        assert apply(dates.date_iso, list(STAMPS)) == [v[:10] for v in STAMPS.values()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_retrieval_stamp_is_one_value_per_query(spark):
    rows = spark.range(0, 1000, 1, 8).select(dates.retrieval_stamp().alias("s")).distinct().collect()
    assert len(rows) == 1 and rows[0].s.endswith("+00:00") and len(rows[0].s) == 25
