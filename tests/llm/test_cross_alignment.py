"""Alignment of two tokenizers against whole-text encodings and plain counts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordmill.llm import cross_alignment
from recordmill.llm.shared import slices

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a ", "a  ", " a", "x▁y z", "▁", "日本語 テスト 🎉 é\x00b\x1c c", "<s>a</s> <|endoftext|> <unk> <0x41>",
       "line\nline \n  line\t;\r {\r", "    code(  )   ;", "a" * 500, "É é é́ don't  we'll 12३\x85 \xa0　ﬁ", "é ́x"]


@pytest.fixture(scope="module")
def model():
    return cross_alignment.Aligner(A, B)


def plain(model, text):
    """Groups and links of a text from whole encodings, byte by byte."""
    text = text or ""
    data = f" {text}".encode()
    ids = [model.first.encode(f" {text}", add_special_tokens=False).ids, model.second.encode(text)]
    of = cross_alignment.byte_characters()
    tokens = [[bytes(of[c] for c in model.first.id_to_token(i)) for i in ids[0]],
              [cross_alignment.piece_bytes(model.second.id_to_piece(i)) for i in ids[1]]]
    if not text or any(b"".join(t) != data for t in tokens):
        return [], []
    ends = [np.cumsum([len(t) for t in own]).tolist() for own in tokens]
    owner = [[k for k, t in enumerate(own) for _ in t] for own in tokens]
    links = sorted({(owner[0][p], owner[1][p]) for p in range(len(data))})
    groups, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        upto = [own.index(end, k) + 1 for own, k in zip(ends, at)]
        groups.append("|".join(",".join(map(str, x[a:b])) for x, a, b in zip(ids, at, upto)))
        at = upto
    return groups, [(ids[0][x], ids[1][y]) for x, y in links]


def expected(model, rows):
    found = [(r[0], *plain(model, r[1])) for r in rows]
    count = Counter(link for _, _, links in found for link in links)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc_id, groups, links in found:
        text = ";".join(groups)
        n = [sum(len(g.split("|")[side].split(",")) for g in groups) for side in (0, 1)]
        best = sum(count[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((-1 if doc_id is None else doc_id, *n, len(groups), len(links), best, sum(count[x] for x in links), digest))
    return sorted(out), count, highest


def given_back(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\r\t'ae0;{▁é")), max_size=40), max_size=4))
def test_pieces_are_those_of_whole_texts(texts):
    model = cross_alignment.aligner(A, B)
    found, codes, starts = model.pieces(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, starts, starts[1:]):
        own = [found[c] for c in codes[a:b]]
        groups, links = plain(model, text)
        assert b"".join(x[2] for x in own) == "".join(f"{g};" for g in groups).encode()
        got = np.frombuffer(b"".join(x[1] for x in own), np.uint64).tolist()
        assert [(x % model.a.size, x // model.a.size) for x in got] == links


def test_alignment(spark, rows, docs, none, clashing, model):
    want, count, highest = expected(model, rows)
    for table in (docs, clashing):
        assert given_back(cross_alignment.cross_alignment(table, A, B)) == want
    assert cross_alignment.cross_alignment(none, A, B).collect() == []
    pairs = cross_alignment.pair_counts(docs, A, B, radix=3).collect()
    assert {(r.a, r.b): r["count"] for r in pairs} == count
    assert all(r.best == (r["count"] == highest[r.b]) for r in pairs)


def test_odd_texts_and_repeated_ids(spark, model):
    rows = [(i % 7, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert given_back(cross_alignment.cross_alignment(table, A, B)) == expected(model, rows)[0]
    got = sorted(r.groups for r in cross_alignment.groups(table, A, B).collect())
    assert got == sorted(";".join(plain(model, t)[0]) for _, t in rows)


def test_many_splits_runs_and_frames(spark, model, monkeypatch):
    """The merge alone: small frames, pairs that go on behind a frame, one pair in every run."""
    rng = random.Random(2)
    monkeypatch.setattr(cross_alignment, "FRAME", 5)
    runs, every = [], []
    for _ in range(7):
        own = sorted((rng.choice([34, rng.randrange(60)]), rng.randrange(50), rng.randrange(1, 4)) for _ in range(rng.randrange(1, 60)))
        every += own
        pairs, documents, times = (np.array(x, np.uint64) for x in zip(*own))
        runs.append(cross_alignment.packed(pairs, documents, times))
    got = [tuple(map(int, r)) for frame in cross_alignment.merged(runs) for r in zip(*frame)]
    assert [r[0] for r in got] == sorted(r[0] for r in every) and sorted(got) == sorted(every)
    key = (pa.scalar(1), pa.scalar(0))
    table = cross_alignment._count(key, pa.table({"run": pa.array(runs, pa.binary())})).to_pydict()
    total = Counter()
    for pair, _, times in every:
        total[pair] += times
    assert dict(zip(table["pair"], table["n"])) == total and len(table["n"]) == len(total)
    marks = pa.table({"pair": table["pair"], "count": table["n"], "best": [n % 2 == 0 for n in table["n"]]})
    shares = cross_alignment._share(key, pa.table({"run": pa.array(runs, pa.binary())}), marks).to_pydict()
    want, best = Counter(), Counter()
    for pair, document, times in every:
        want[document] += times * total[pair]
        best[document] += times * (total[pair] % 2 == 0)
    assert dict(zip(shares["document"], shares["count_sum"])) == want
    assert {d: n for d, n in zip(shares["document"], shares["n_best"]) if n} == {d: n for d, n in best.items() if n}


def test_small_slices_and_caches(spark, rows, docs, model, monkeypatch):
    """Many slices and splits in one task give the same rows."""
    monkeypatch.setattr(cross_alignment, "SLICES", 2)
    monkeypatch.setattr(cross_alignment, "KEPT", 50)
    monkeypatch.setattr(cross_alignment, "_BATCH", 30)
    monkeypatch.setattr(cross_alignment, "slices", lambda batches, limit: slices(batches, limit=3000))
    texts = [(r[0], r[1]) for r in rows if len(r[1] or "") < 5000]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([t[0] for t in texts], pa.int64()), "text": [t[1] for t in texts]})
    monkeypatch.setattr(cross_alignment.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))
    made = pa.Table.from_batches(cross_alignment._encode([batch], A, B, 3)).to_pylist()
    documents = [r for r in made if r["radix"] is None]
    assert len(documents) == len(texts) and len({(r["split"], r["document"]) for r in documents}) == len(texts)
    assert len({r["split"] for r in documents}) > 3
    want, _, _ = expected(model, texts)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_links"], r["groups_sha256"]) for r in documents) == sorted((w[0], w[4], w[7]) for w in want)
    records = sum(len(f[0]) for r in made if r["radix"] is not None for f in cross_alignment.frames(r["run"]))
    assert records == sum(len(set(plain(model, t)[1])) for _, t in texts)

