"""Operators that compare documents: near duplicates, substrings, test items, components."""

from __future__ import annotations

import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordmill.llm import components, decontaminate, near_duplicates, substring_dedup


@pytest.mark.parametrize("size, percent", [(4, 80), (5, 80)])
def test_near_duplicates(rows, docs, size, percent):
    expected = brute.near_groups(rows, size, percent)
    assert len({c for _, c in expected.values()}) < len(expected) - 15
    for row in near_duplicates.near_duplicates(docs, size=size, percent=percent).collect():
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.n_shingles, row.component_id) == expected[row.doc_id]
            assert row.kept == (row.component_id == row.doc_id)


def test_large_nodes_lose_no_link(spark):
    """Hundreds of copies with few words changed, far over the limit of a node."""
    rng = random.Random(3)
    base = brute.prose(rng, 120, 5000)
    texts = [base] + [brute.edited(rng, base, rng.randrange(1, 4)) for _ in range(250)]
    texts += [brute.prose(rng, 100, 5000) for _ in range(50)]
    rows = [(i, t, None, None, None) for i, t in enumerate(rng.sample(texts, len(texts)))]
    table = spark.createDataFrame(rows, brute.SCHEMA)
    expected = brute.near_groups(rows, 4, 80)
    got = near_duplicates.near_duplicates(table, size=4, limit=8).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_pairs_in_a_template_family(spark):
    """Hundreds of unlinked classes around one passage, at 0.79: the 60 pairs among them, at 0.816, are to be found."""
    rng = random.Random(5)
    passage = brute.prose(rng, 177, 10**6).split(" ")
    texts = []
    for k in range(400):
        own = [f"o{k}-{i}" for i in range(23)]
        texts.append(" ".join(passage + own))
        if k < 60:
            texts.append(" ".join(passage + own[:3] + [f"c{k}-{i}" for i in range(20)]))
    rows = [(i, t, None, None, None) for i, t in enumerate(rng.sample(texts, len(texts)))]
    expected = brute.near_groups(rows, 4, 80)
    assert len({c for _, c in expected.values()}) == 400
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, brute.SCHEMA), size=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_near_duplicates_of_rows_that_repeat_an_id(spark):
    """Every row by its own words: rows are numbered for the brute force, groups named by their smallest id."""
    rng = random.Random(6)
    bases = [brute.prose(rng, 90, 10**6) for _ in range(30)]
    rows = []
    for k, base in enumerate(bases):
        rows += [(k, base), (200 + k, brute.edited(rng, base, 2)), (200 + (k + 1) % 30, base), (k, brute.edited(rng, bases[(k + 7) % 30], 1))]
    rows += [(3, rows[12][1]), (50, "alone"), (50, "by itself"), (51, None), (51, ""), (52, None), (52, bases[0])]
    groups = brute.near_groups([(n, t) for n, (_, t) in enumerate(rows)], 4, 80)
    least = {}
    for n, (size, c) in groups.items():
        if size:
            least[c] = min(least.get(c, 10**9), rows[n][0])
    expected = sorted((rows[n][0], size, least[c] if size else rows[n][0]) for n, (size, c) in groups.items())
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_duplicates.near_duplicates(table, size=4, limit=8).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_tables(docs, clashing, none):
    plain = sorted(map(str, near_duplicates.near_duplicates(docs).collect()))
    assert sorted(map(str, near_duplicates.near_duplicates(clashing).collect())) == plain
    assert near_duplicates.near_duplicates(none).collect() == []
    assert near_duplicates.deduplicated(none).collect() == []


def test_one_document_of_each_group_stays(rows, docs):
    expected = brute.near_groups(rows, 5, 80)
    got = near_duplicates.deduplicated(docs).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(i for i, (_, c) in expected.items() if i == c)
    assert sum(r.doc_id is None for r in got) == 1 and list(got[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=40))
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    table = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components.components(table).collect()} == {x: find(x) for x in parent}


def test_substrings(rows, docs, clashing, none):
    expected = brute.substring(rows)
    assert sum(n for _, n, _ in expected.values()) > 500
    for table in (docs, clashing):
        got = substring_dedup.substring_dedup(table).collect()
        assert len(got) == len(rows)
        for row in got:
            assert (row.n_words, row.n_removed, row.kept_sha256) == expected[row.doc_id], row.doc_id
    assert substring_dedup.substring_dedup(none).collect() == []


def test_factors_are_copies_of_smaller_ids(rows, docs):
    words = {r[0]: brute.WORD.findall(r[1] or "") for r in rows}
    factors = 0
    for row in substring_dedup.substring_dedup(docs).collect():
        end = 0
        for f in row.factors:
            assert f.ref < row.doc_id and f.start >= end
            assert words[row.doc_id][f.start : f.start + f.n] == words[f.ref][f.ref_start : f.ref_start + f.n]
            end, factors = f.start + f.n, factors + 1
    assert factors > 20


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=8))
def test_substrings_of_few_words(spark, texts):
    """Two words only: seeds and windows repeat within and across documents."""
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, brute.SCHEMA)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(table).collect()}
    assert got == brute.substring(rows)


def test_rows_that_repeat_an_id_keep_their_own_words(spark):
    rng = random.Random(21)
    first, other = brute.prose(rng, 60, 10**6), brute.prose(rng, 70, 10**6)
    tail = brute.prose(rng, 9, 10**6)
    rows = [(1, first), (5, f"{first} {tail}"), (5, other), (7, other), (7, f"{tail} {first}"), (5, other), (None, first), (7, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(table).collect())
    assert got == sorted([
        (1, 60, 0, first), (5, 69, 60, tail), (5, 70, 0, other), (5, 70, 0, other), (7, 70, 70, ""), (7, 69, 60, tail), (-1, 60, 0, first), (7, 0, 0, ""),
    ])


def items_of(rows):
    rng = random.Random(9)
    long = next(r for r in rows if r[1] and len(r[1]) > 100_000)
    words = long[1].split(" ")
    items = [(0, " ".join(words[20_000:20_014])), (1, " ".join(words[5:95])), (2, " ".join(words[50:53])), (3, None), (4, "")]
    items += [(5, ", ".join(words[777:800]).upper() + "!"), (6, brute.prose(rng, 40, 10**6))]
    items += [(7, " ".join([*words[100:120], *words[9000:9020]])), (8, brute.edited(rng, " ".join(words[3000:3060]), 2))]
    return [*items, (9, items[0][1]), (10, " ".join(words[:400]))]


@pytest.mark.parametrize("block", [10_000, 3])
def test_items_in_documents(spark, rows, docs, clashing, block):
    items = items_of(rows)
    expected = brute.contained(rows, items)
    assert {i for _, i, *_ in expected} >= {0, 1, 5, 9, 10}
    table = spark.createDataFrame(items, "item_id long, text string")
    for source in (docs, clashing):
        got = decontaminate.contaminated(source, table, block=block).collect()
        assert {tuple(r)[:4] for r in got} == expected
    held = {d for d, *_ in expected}
    clean = decontaminate.decontaminate(docs, table, block=block).collect()
    assert sorted(map(str, (tuple(r) for r in clean))) == sorted(str(r) for r in rows if r[0] not in held)


def test_items_of_one_to_twelve_words(spark):
    rng = random.Random(12)
    texts = [brute.prose(rng, 120, 60) for _ in range(150)] + [None, "", "w1", "w1 w2"]
    rows = [(i % 140, t, "en", "s", 1) for i, t in enumerate(texts)]  # ids that repeat with another text
    words = [t.split(" ") for t in texts if t]
    items = []
    for n in range(1, 13):
        for k in range(12):
            own = rng.choice(words[:150])
            at = rng.randrange(len(own) - n)
            part = own[at : at + n]
            if k % 3 == 2:
                part[rng.randrange(n)] = "x"
            items.append((len(items), " ".join(part)))
    items += [(999, "..."), (1000, "w1 w1 w1 w1 w1 w1 w1 w1")]
    docs, table = spark.createDataFrame(rows, brute.SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    expected = brute.contained(rows, items)
    assert {len(items[i][1].split(" ")) for _, i, *_ in expected} >= set(range(1, 13))
    assert {tuple(r)[:4] for r in decontaminate.contaminated(docs, table).collect()} == expected
    # a document goes by its own text, also where another row has its id
    some = [(i, t) for i, t in items if len(t.split(" ")) > 6]
    clean = [r for r in rows if not brute.contained([r], some)]
    got = decontaminate.decontaminate(docs, spark.createDataFrame(some, "item_id long, text string")).collect()
    assert 20 < len(clean) < 150 and sorted(map(str, map(tuple, got))) == sorted(map(str, clean))


def test_many_items_go_in_blocks(spark):
    rng = random.Random(13)
    texts = [brute.prose(rng, 300, 10**6) for _ in range(40)]
    items = [(k, brute.prose(rng, rng.randrange(1, 30), 10**6)) for k in range(25_000)]
    for k in range(0, 25_000, 500):
        own = texts[k // 500 % 40].split(" ")
        items[k] = (k, " ".join(own[k // 500 : k // 500 + 20]))
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    docs, table = spark.createDataFrame(rows, brute.SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(table, 10_000))
    assert len(blocks) == 3 and sum(len(b.ids) for b in blocks) == 25_000 and max(len(b.ids) for b in blocks) < 9000
    assert {tuple(r)[:4] for r in decontaminate.contaminated(docs, table).collect()} == brute.contained(rows, items)


def test_no_items_and_no_documents(spark, rows, docs, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, empty).collect() == []
    assert decontaminate.decontaminate(docs, empty).count() == len(rows)
    table = spark.createDataFrame(items_of(rows), "item_id long, text string")
    assert decontaminate.contaminated(none, table).collect() == []
