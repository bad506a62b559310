"""Periodic runs against plain searches."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordmill.llm import periodic_runs, queries


def plain_runs(words, repeats=4, least=6):
    """(start, length, period): every stretch of every period; of equal stretches the least period."""
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(least, repeats * q):
                found.setdefault((begin, i + q - begin), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def fast_runs(texts):
    names = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    codes = np.array([names[w] for t in texts for w in t], np.int64)
    got = periodic_runs.runs_of(codes, np.cumsum([0, *map(len, texts)]))
    return [[(b, e - b, q) for b, e, q in got.get(i, [])] for i in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=4))
def test_words_of_two_letters(texts):
    assert fast_runs(texts) == [plain_runs(t) for t in texts]


def repeated(rng, n):
    """Runs inside runs, runs side by side, and runs broken by one word."""
    words = []
    while len(words) < n:
        stretch = [rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 31, 64]))]
        if rng.random() < 0.3:
            stretch = stretch * rng.randrange(2, 7) + [rng.choice("abc")]
        words += stretch * rng.choice([1, 3, 4, 5, 9])
        words = words[: len(words) - rng.randrange(3)]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "x"
    return words


def test_runs_of_many_periods():
    rng = random.Random(7)
    texts = [repeated(rng, n) for n in (30, 200, 700, 1500) for _ in range(12)] + [["a"] * 3000, ["a", "b"] * 900 + ["a"] * 700]
    assert fast_runs(texts) == [plain_runs(t) for t in texts]
    assert sum(map(len, fast_runs(texts))) > 200


def test_sums_are_zero_exactly_where_words_agree():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(0, 2, (50, size)) * 900_000
        windows = rng.integers(0, 2, (50, 2 * size)) * 900_000
        windows[::3, size // 2 : size // 2 + size] = blocks[::3]
        got = periodic_runs.zero_sums(blocks, windows)
        for r in range(50):
            assert got[r].tolist() == [(windows[r, k : k + size] == blocks[r]).all() for k in range(size)]


def test_a_sum_that_one_prime_divides_is_not_zero():
    prime = periodic_runs.PRIMES[0][0]
    total, sides = prime, []
    while total:  # a sum of squares that is the first prime
        sides.append(int(total**0.5))
        total -= sides[-1] ** 2
    blocks = np.zeros((1, 8), np.int64)
    windows = np.zeros((1, 16), np.int64)
    windows[0, : len(sides)] = sides
    assert not periodic_runs.zero_sums(blocks, windows)[0, 0]


def test_transforms_invert_each_other():
    rows = np.random.default_rng(2).integers(0, 10**9, (3, 64)).astype(np.uint64)
    for prime, generator in periodic_runs.PRIMES:
        got = periodic_runs.backward(periodic_runs.forward(rows % prime, prime, generator), prime, generator)
        assert (got == rows % prime).all()


def expected(doc_id, text):
    words = brute.WORD.findall(text or "")
    tail = queries.repeating_tail(doc_id, len(words))
    if tail:
        a, p = tail
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (-1 if doc_id is None else doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_reports(spark, rows, docs, none, clashing):
    rng = random.Random(9)
    some = [r for r in rows if len(r[1] or "") < 20_000]
    more = [(2000 + k, "  ".join(repeated(rng, 300)), None, None, None) for k in range(40)]
    table = spark.createDataFrame(some + more, brute.SCHEMA)
    got = periodic_runs.report(periodic_runs.periodic_runs(table, tail=queries.repeating_tail)).collect()
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in got), key=order) == sorted((expected(r[0], r[1]) for r in some + more), key=order)
    assert sum(r.n_runs > 1 for r in got) > 20
    assert len(periodic_runs.periodic_runs(clashing).collect()) == len(rows)
    assert periodic_runs.report(periodic_runs.periodic_runs(none)).collect() == []


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.int64), np.array([0, 9]), repeats=3)
