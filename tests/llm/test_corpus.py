"""Classifier, mixture, URL lists, the registered queries and the pipeline."""

from __future__ import annotations

import datetime
import random
from collections import Counter, defaultdict

import brute
import pytest
from parity import compare, connect

import corpus_pipeline
from recordmill.llm import quality_classifier, queries, source_mix, url_filter

FOLDER = "/root/testdata/sf0.001"


def judged(n):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = brute.prose(rng, 80, 300)
        if not good:
            text = " ".join(w + rng.choice(["%%%", "&&&"]) for w in text.upper().split())
        rows.append((i, text, rng.choice(["en", "de"]), f"s{rng.randrange(4)}", len(text)))
        labels.append((i, int(good)))
    return rows, labels


def test_classifier_on_held_out_documents(spark):
    rows, labels = judged(900)
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    known = spark.createDataFrame(labels[:300], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.score(docs, known, labelled=300, growth=0.2).collect()}
    right = sum(got[i].kept == bool(q) for i, q in labels[300:])
    assert len(got) == 900 and right >= 0.98 * 600
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got.values())
    kept = quality_classifier.accepted(docs, known, labelled=300, growth=0.2).collect()
    assert {r.doc_id for r in kept} == {i for i, r in got.items() if r.kept}


def test_all_other_documents_are_labelled_for_the_other_view(spark, monkeypatch):
    """Quantiles are those of all margins, whatever their number, and slopes are those of one plain sum."""
    rows, labels = judged(600)
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    known = spark.createDataFrame(labels[:100], "doc_id long, quality int")
    bounds, slopes = [], []
    real_bounds, real_refit = quality_classifier._bounds, quality_classifier.refit

    def seen_bounds(margins, taken, good):
        found = real_bounds(margins, taken, good)
        bounds.append((margins.toPandas(), taken, good, found))
        return found

    def seen_refit(views, own, y, pseudo, counts, steps):
        slopes.append((list(views), pseudo.toArrow().to_batches(), counts))
        return real_refit(views, own, y, pseudo, counts, steps)

    monkeypatch.setattr(quality_classifier, "_bounds", seen_bounds)
    monkeypatch.setattr(quality_classifier, "refit", seen_refit)
    quality_classifier.train(docs, known, rounds=2, growth=0.1, steps=2)
    assert [len(b[0]) for b in bounds] == [500, 500] and [b[1] for b in bounds] == [0.1, 0.2]
    for table, taken, good, found in bounds:
        for view, (low, high, n_bad, n_good) in enumerate(found):
            m = table[f"m{view}"]
            assert (int((m <= low).sum()), int((m >= high).sum())) == (n_bad, n_good)
            assert n_good >= min(taken * good * 500, (m > 0).sum()) and n_bad >= min(taken * (1 - good) * 500, (m < 0).sum())
            assert low < 0 < high
    views, batches, counts = slopes[0]
    shares = [(0.5 / (1 + b), 0.5 / (1 + g)) for b, g in counts]
    whole = list(quality_classifier._slopes(batches, views, shares))
    parts = [list(quality_classifier._slopes([batch.slice(k, 1)], views, shares)) for batch in batches for k in range(batch.num_rows)]
    total = Counter()
    for part in parts:
        for b in part:
            for r in b.to_pylist():
                total[r["view"], r["at"]] += r["units"]
    assert {(r["view"], r["at"]): r["units"] for b in whole for r in b.to_pylist()} == {k: v for k, v in total.items() if v}
    assert sum(len(b) for b in batches) == len({i for b in batches for i in b.column("doc_id").to_pylist()}) > 80


def test_repeated_ids_and_labels_have_one_result(spark):
    rows, labels = judged(200)
    again = [(i, rows[(i + 1) % 200][1], *rows[i][2:]) for i in range(0, 200, 5)]
    known = spark.createDataFrame(labels[:120] + [(i, 0) for i in range(0, 120, 7)], "doc_id long, quality int")
    got = [
        sorted(map(str, quality_classifier.score(spark.createDataFrame(t, brute.SCHEMA).repartition(n), known, growth=0.1).collect()))
        for t, n in ((rows + again, 2), (again[::-1] + rows[::-1], 5))
    ]
    assert got[0] == got[1] and len(got[0]) == 240


def test_classifier_of_odd_tables(spark, rows, docs, clashing, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (41, None)], "doc_id long, quality int")
    one = sorted(map(str, quality_classifier.score(docs, labels).collect()))
    assert len(one) == len(rows) and sorted(map(str, quality_classifier.score(clashing, labels).collect())) == one
    assert quality_classifier.score(none, labels).collect() == []
    single = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = quality_classifier.score(docs, single).collect()
    texts = {r[0]: r[1] for r in rows}
    assert all(r.score == (0.5 if brute.WORD.findall(texts[r.doc_id] or "") else 0.0) for r in got)


def mixture(spark, sizes, **options):
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    rows = [(k, *r) for k, r in enumerate(rows)]
    table = spark.createDataFrame([(k, s) for k, _, s in rows], "doc_id long, source string")
    return source_mix.source_mix(table, **options).collect()


@pytest.mark.parametrize(
    "sizes, targets",
    [({"a": 700, "b": 90, "c": 33, None: 20}, None), ({"a": 500, "b": 100}, {"a": 0.3, "b": 0.7}), ({"a": 64, "b": 64, "c": 64}, {"a": 0.5})],
)
def test_every_prefix_is_within_one_block(spark, sizes, targets):
    period, block = 100, 8
    got = mixture(spark, sizes, targets=targets, block=block)
    assert {r.doc_id for r in got} == set(range(sum(sizes.values())))
    slots = defaultdict(set)
    for r in got:
        assert r.release <= r.slot < r.deadline and r.place < block
        slots[r.slot].add((r.source, r.epoch, r.block) if targets is None or r.source in targets else ("rest", r.epoch, r.block))
    assert set(slots) == set(range(max(slots) + 1)) and all(len(s) == 1 for s in slots.values())
    if targets is None:
        weights = {s: n**0.9 for s, n in sizes.items()}
    else:
        weights = targets | ({"rest": 1 - sum(targets.values())} if sum(targets.values()) < 1 else {})
    share = source_mix.shares({str(s): w for s, w in weights.items()}, period)
    done = Counter()
    for t in range(len(slots)):
        done[str(next(iter(slots[t]))[0])] += 1
        for s, c in share.items():
            assert abs(done[s] - (t + 1) * c / period) < 1
    copies = Counter((r.doc_id, r.epoch) for r in got)
    assert set(copies.values()) == {1}


def test_prefixes_follow_the_true_targets(spark):
    """Targets that no whole number of slots of a period meets, over several periods."""
    targets = {"a": 0.0145, "b": 0.1337, "c": 0.8518}
    got = mixture(spark, {"a": 60, "b": 250, "c": 900}, targets=targets, block=1)
    order = dict(sorted({r.slot: r.source for r in got}.items()))
    done = Counter()
    assert len(order) > 4000
    for t, source in order.items():
        done[source] += 1
        assert all(abs(done[s] - (t + 1) * w) < 1 for s, w in targets.items())


def test_small_sources_are_scheduled_together(spark):
    got = mixture(spark, {"big": 900} | {f"s{i:02}": 1 for i in range(60)}, block=4)
    assert {r.doc_id for r in got} == set(range(960))


@pytest.mark.parametrize("targets", [None, {"big": 0.6}])
def test_small_sources_are_mixed_by_their_own_weight(spark, targets):
    """Each source of a long tail, far below a slot of a period, keeps to its weight in every prefix."""
    sizes = {"big": 400} | {f"s{i:03}": 1 + i % 5 for i in range(120)}
    got = mixture(spark, sizes, targets=targets, block=2)
    assert {r.doc_id for r in got} == set(range(sum(sizes.values())))
    raw = {s: n**0.9 for s, n in sizes.items() if not targets or s not in targets}
    weights = {s: w / sum(raw.values()) * (1 - sum((targets or {}).values())) for s, w in raw.items()} | (targets or {})
    blocks = {(r.slot, r.source) for r in got}
    assert sorted(slot for slot, _ in blocks) == list(range(len(blocks)))
    done = Counter()
    for slot, source in sorted(blocks):
        done[source] += 1
        assert all(abs(done[s] - (slot + 1) * w) < 1 + 1e-9 for s, w in weights.items())


def test_mixture_of_odd_tables(rows, docs, clashing, none):
    got = source_mix.mixed_documents(docs).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} and len(got) >= len(rows)
    assert Counter(map(str, (tuple(r) for r in got))).keys() == Counter(map(str, rows)).keys()
    assert sorted(map(str, source_mix.mixed_documents(clashing).collect())) == sorted(map(str, got))
    assert source_mix.source_mix(none).collect() == []


def test_list_entries_as_of_the_fetch(spark):
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    entries = [
        ("block", "host", "bad.example", "add", day(10)), ("block", "host", "bad.example", "remove", day(20)),
        ("block", "host", "bad.example", "add", day(80)), ("allow", "host", "good.bad.example", "add", day(15)),
        ("block", "url", "x.example/page", "add", day(5)), ("block", "url", "x.example/page", "add", day(6)),
        ("block", "host", "y.example", "add", day(5)), ("block", "host", "y.example", "remove", day(5)),
        (None, "host", "z.example", "add", day(0)), ("block", "host", None, "add", day(0)), ("block", "host", "z.example", "add", None),
    ]
    cases = [
        ("http://bad.example/", 9, (0, 0)), ("http://bad.example/", 10, (1, 0)), ("HTTPS://u@WWW.Bad.Example:80/x", 19, (1, 0)),
        ("http://bad.example/", 20, (0, 0)), ("http://bad.example", 500, (1, 0)), ("http://notbad.example/", 12, (0, 0)),
        ("http://good.bad.example/", 14, (1, 0)), ("http://a.good.bad.example/", 15, (1, 1)), ("http://x.example/page/?q#f", 5, (1, 0)),
        ("http://x.example/page/", 4, (0, 0)), ("http://x.example/other", 9, (0, 0)), ("http://y.example/", 6, (1, 0)),
        ("http://z.example/", 6, (0, 0)), (None, 10, (0, 0)), ("no url", 10, (0, 0)), ("http://bad.example/", None, (0, 0)),
    ]
    captures = [(i, u, None if d is None else day(d)) for i, (u, d, _) in enumerate(cases)]
    listed = spark.createDataFrame(entries, "list string, kind string, pattern string, action string, dated date")
    table = spark.createDataFrame(captures + captures[:2], "page_id long, url string, fetched_on date").selectExpr("*", "1 as month", "2 as URL")
    got = url_filter.url_filter(table, listed).collect()
    assert len(got) == len(cases) + 2
    for r in got:
        assert (r.n_block, r.n_allow) == cases[r.page_id][2], cases[r.page_id]
        assert r.blocked == (r.n_block > 0 and r.n_allow == 0)
    assert url_filter.url_filter(table.limit(0), listed).collect() == []
    assert not any(r.blocked for r in url_filter.url_filter(table, listed.limit(0)).collect())


def test_url_filter_runs_no_python(spark):
    df = queries.QUERIES["op8_url_filter"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), name, FOLDER) == ""


def test_pipeline_by_stage(spark):
    """Each stage on its own input, against brute force."""
    docs = queries.table(spark, FOLDER, "documents")
    labels = {r.doc_id: r.quality for r in queries.table(spark, FOLDER, "labels").collect()}
    items = [(r.item_id, r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[1] == "MinHash near-dedup"
    good = [tuple(r) for r in corpus_pipeline.good_quality(spark, docs, FOLDER).collect()]
    kept = {r[0] for r in good}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.95 * len(labels)
    one = spark.createDataFrame(good, brute.SCHEMA)
    apart = [tuple(r) for r in corpus_pipeline.without_near_duplicates(spark, one, FOLDER).collect()]
    groups = brute.near_groups(good, 5, 80)
    assert sorted(r[0] for r in apart) == sorted(i for i, (_, c) in groups.items() if i == c)
    two = spark.createDataFrame(apart, brute.SCHEMA)
    clean = [tuple(r) for r in corpus_pipeline.without_test_items(spark, two, FOLDER).collect()]
    held = {d for d, *_ in brute.contained(apart, items)}
    assert sorted(r[0] for r in clean) == sorted(r[0] for r in apart if r[0] not in held)
    three = spark.createDataFrame(clean, brute.SCHEMA)
    mixed = [tuple(r) for r in corpus_pipeline.mixed_sources(spark, three, FOLDER).collect()]
    assert set(mixed) == set(clean)
    assert corpus_pipeline.run(spark, FOLDER).count() == len(mixed)


def test_pipeline_of_odd_and_empty_tables(spark, rows, docs, clashing, none):
    for source in (docs, clashing, none):
        made = source
        for name, stage in corpus_pipeline.STAGES:
            before = made
            made = stage(spark, before, FOLDER)
            if name != "token-ID / binary output":
                assert made.columns == ["doc_id", "text", "lang", "source", "n_chars"]
                made = spark.createDataFrame(made.collect(), brute.SCHEMA)
        ids = [r.doc_id for r in made.collect()]
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in before.collect())
        texts = {r[0]: r[1] for r in rows}
        assert all(brute.WORD.findall(texts[i] or "") for i in ids) and bool(ids) == (source is not none)


def test_pipeline_leaves_one_stage_behind(spark):
    from recordmill.session import release, settled_tables

    begun = settled_tables()
    left = corpus_pipeline.run(spark, FOLDER)
    assert settled_tables() - begun <= 6  # the last stage's input, its records and their index
    assert left.count() > 0
    release(spark, begun)
