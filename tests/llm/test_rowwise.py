"""Operators that judge each document by itself: token counts, records, rules, secrets."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordmill.llm import quality_rules, secret_scan, shared, token_counts, token_records

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "aaaaaaaaaa aaaaaaab",
    "<|endoftext|>x <|startoftext|><|endoftext|> <|endoftext",
    "It's we'LL 12३ ÀÉ Σας ΣΑΣ İstanbul é́  x\x1cy\x85z 日本語 🎉🎉 don't",
    "a" * 3000 + "b" * 2000,
    " x　y \x00\x01 ǅ ﬀ ß ẞ",
    "",
]


@pytest.fixture(scope="module")
def library():
    return token_counts.merges(PATH).library


def counted(texts):
    words = shared.words_of(pa.array(texts, pa.string()))
    each = token_counts.word_counts(words.strings(), PATH)
    return shared.sums(each[words.codes] if len(words.codes) else words.codes, words.starts).tolist()


def encoded(texts):
    ids, starts = token_records.encoder(PATH).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


def test_odd_texts_are_counted_and_encoded_as_the_library_does(library):
    expected = [x.ids for x in library.encode_batch(ODD, add_special_tokens=False)]
    assert counted(ODD) == [len(x) for x in expected]
    assert encoded(ODD) == expected


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'<|>aAsSeE.!é́")), max_size=60))
def test_any_text_is_counted_and_encoded_as_the_library_does(text):
    expected = token_counts.merges(PATH).library.encode(text, add_special_tokens=False).ids
    assert counted([text]) == [len(expected)]
    assert encoded([text]) == [expected]


def test_words_that_differ_in_case_and_marks_go_to_the_library_once(monkeypatch):
    sent, ids = [], token_records.Encoder.ids
    monkeypatch.setattr(token_records.Encoder, "ids", lambda *args: sent.extend(args[-1]) or ids(*args))
    shared.KEPT.clear()
    encoded(["Été the The THE the. the, THE, the!! The...", "été, ÉTÉ. Été!! the"])
    assert sorted(" ".join(sent).split()) == sorted(["été", "the", ".", ",", "!!", "..."])


def test_folded_words_have_the_ids_of_the_library(library):
    letters = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))]
    draw = random.Random(1)
    texts = [f"{c} x{c} {c}X x{c}. {c}{c}'S, {c}\u0301. {c}”." for c in letters]
    texts += [" ".join("".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(300)) for _ in range(20)]
    texts += ["<|ENDOFTEXT|> <|endoftext|> <|endoftext|>. x<|EndOfText|>!", "H\u0331 h\u0331 I\u0307. It'S 'tis' DON'T. 1st."]
    shared.KEPT.clear()
    for _ in range(2):
        assert encoded(texts) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("part", ["normalizer", "pre_tokenizer"])
def test_other_vocabularies_fold_no_words(tmp_path, part):
    with open(PATH, encoding="utf-8") as file:
        content = json.load(file)
    parts = content[part]["normalizers" if part == "normalizer" else "pretokenizers"]
    parts.pop() if part == "normalizer" else parts[0].update(pattern={"Regex": r"\S+"})
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(content, file)
    texts = ["The THE the. Été, <|endoftext|> x", *ODD]
    ids, starts = token_records.encoder(path).encode(pa.array(texts, pa.string()))
    expected = [x.ids for x in token_records.encoder(path).library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == expected


def test_words_are_those_of_the_pattern(rows):
    texts = [r[1] for r in rows]
    words = shared.words_of(pa.array(texts))
    strings = words.strings()
    hashes, starts = shared.hashed_words(pa.array(texts))
    assert starts.tolist() == words.starts.tolist()
    by_word = {}
    for i, text in enumerate(texts):
        own = [strings[c] for c in words.codes[words.starts[i] : words.starts[i + 1]]]
        assert own == brute.WORD.findall(text or "")
        for w, h in zip(own, hashes[starts[i] : starts[i + 1]].tolist()):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_token_counts(spark, rows, docs, none, clashing, library):
    expected = sorted(
        (-1 if r[0] is None else r[0], len((r[1] or "").encode()), len(ids := library.encode(r[1] or "", add_special_tokens=False).ids), len(ids) > 2048)
        for r in rows
    )
    for table in (docs, clashing):
        got = token_counts.count_tokens(table, PATH).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == expected
    assert token_counts.count_tokens(none, PATH).collect() == []


def test_records_round_trip_in_ascending_order(spark, rows, docs, none, clashing, library):
    ids = [(-1 if r[0] is None else r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    expected, start = [], 0
    for doc_id, own in sorted(ids, key=lambda x: x[0]):
        expected.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    for table in (docs, clashing):
        got = token_records.token_records(table, PATH).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == expected
    assert token_records.token_records(none, PATH).collect() == []


def test_index_finds_single_records(spark, rows, docs, library):
    folder = f"{shared.new_folder(spark)}/records"
    index = token_records.write_records(docs, PATH, folder)
    wanted = index.where("doc_id % 7 = 3").orderBy("doc_id", ascending=False)
    texts = {r[0]: r[1] for r in rows}
    got = token_records.fetch_records(wanted).collect()
    assert len(got) == wanted.count() > 10
    for row in got:
        assert row.ids == library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids + [1]


def test_damaged_records_are_noticed(spark, docs):
    folder = f"{shared.new_folder(spark)}/records"
    index = token_records.write_records(docs, PATH, folder)
    row = index.where("n_tokens > 20").first()
    system, path = token_records.open_folder(row.path)
    with system.open_input_stream(path) as file:
        data = bytearray(file.read())
    for place in (row.offset + 3, row.offset + 40):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            raw = bytes(broken[row.offset : row.offset + row.length])
            token_records.payload_of(raw[12:], token_records.frame_length(raw))


def test_rules(spark, rows, docs, none, clashing):
    trusted = docs.where("doc_id % 2 = 0").select("doc_id")
    expected = sorted((-1 if r[0] is None else r[0], *brute.rules(r[1])) for r in rows)
    for table in (docs, clashing):
        got = quality_rules.quality_rules(table, trusted).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:7]) for r in got) == expected
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality_rules(none, trusted).collect() == []
    assert {r.score_millionths for r in quality_rules.quality_rules(docs, none).collect()} == {0}


def test_scores_are_the_mean_log_ratio(spark, rows, docs):
    """Against counts in plain Python over the same buckets."""
    bits, trusted = 10, {r[0] for r in rows if r[0] is not None and r[0] % 2 == 0}
    buckets = []
    for r in rows:
        got, _ = quality_rules.grams(pa.array([r[1]], pa.string()), bits)
        buckets.append(got.tolist())
    raw, target = [1] * (1 << bits), [1] * (1 << bits)
    for r, own in zip(rows, buckets):
        for b in own:
            raw[b] += 1
            target[b] += r[0] in trusted
    weight = [round(float(np.log(t / sum(target)) - np.log(c / sum(raw))) * 1e6) for t, c in zip(target, raw)]
    expected = sorted((-1 if r[0] is None else r[0], sum(weight[b] for b in own) // max(1, len(own))) for r, own in zip(rows, buckets))
    got = quality_rules.quality_rules(docs, docs.where("doc_id % 2 = 0"), bits).collect()
    got = sorted((-1 if r[0] is None else r[0], r.score_millionths) for r in got)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) <= 1 for a, b in zip(got, expected, strict=True))


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    length = bytes([size]) if size < 128 else (n := size.to_bytes((size.bit_length() + 7) // 8, "big")) and bytes([0x80 + len(n)]) + n
    return bytes([tag]) + length + body


def string(data):
    return len(data).to_bytes(4, "big") + data


def secrets_text():
    rng = random.Random(5)
    number = lambda n: der(2, b"\x01" + rng.randbytes(n))
    rsa = der(0x30, der(2, b"\0"), *[number(n) for n in (64, 3, 64, 32, 32, 32, 32, 32)])
    algorithm = der(0x30, der(6, b"\x2a\x86\x48\x86\xf7"), der(5))
    wrapped = der(0x30, der(2, b"\0"), algorithm, der(4, rsa))
    public = der(0x30, algorithm, der(3, b"\0" + rng.randbytes(64)))
    ssh = b"openssh-key-v1\0" + b"".join(map(string, (b"none", b"none", b""))) + (1).to_bytes(4, "big")
    ssh += string(rng.randbytes(51)) + string(rng.randbytes(144))
    plain = lambda b: base64.b64encode(b).decode()
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.c2lnbmF0dXJl"
    no_token = f"{part({'typ': 'x'})}.{part({'sub': 1})}.c2lnbmF0dXJl"
    return {
        "der_key": [plain(rsa), plain(wrapped), rsa.hex(), base64.urlsafe_b64encode(wrapped).decode(),
                    f"-----BEGIN RSA PRIVATE KEY-----\n{plain(rsa)[:64]}\n{plain(rsa)[64:]}\n-----END RSA PRIVATE KEY-----"],
        "ssh_key": [plain(ssh), f"-----BEGIN OPENSSH PRIVATE KEY-----\n{plain(ssh)}\n-----END OPENSSH PRIVATE KEY-----"],
        "signed_token": [token],
        None: [plain(public), plain(rng.randbytes(300)), plain(rsa[:-1]), plain(rsa + b"x"), plain(ssh[:-1]), no_token, plain(b"\x30\x80" * 40)],
    }


def test_only_structures_are_added():
    for kind, texts in secrets_text().items():
        for text in texts:
            found = secret_scan.added_spans(f"é é {text} end")
            assert [(k, a) for a, _, k in found] == ([] if kind is None else [(kind, 4)]), text


def test_other_forms_of_keys():
    """Escaped line ends, header lines, lines without a frame, a path in front, 0x in front; and what only looks like them."""
    rng = random.Random(8)
    rsa = base64.b64decode(secrets_text()["der_key"][0])
    ssh = base64.b64decode(secrets_text()["ssh_key"][0])
    lines = lambda raw, n=64: [x[k : k + n] for x in [base64.b64encode(raw).decode()] for k in range(0, len(x), n)]
    pem = lambda body, kind="RSA ": f"-----BEGIN {kind}PRIVATE KEY-----{body}-----END {kind}PRIVATE KEY-----"
    head = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n"
    plain = base64.b64encode(rsa).decode()
    cases = [
        (pem("\\n" + "\\n".join(lines(rsa)) + "\\n"), "der_key", 0),
        (pem("\n" + "\r\n".join(lines(rsa)) + "\n"), "der_key", 0),
        (pem("\nComment: mine\n" + "\n".join(lines(ssh)) + "\n", "OPENSSH "), "ssh_key", 0),
        (pem(head + "\n".join(lines(rng.randbytes(160))) + "\n"), "der_key", 0),
        ("\n".join(lines(rsa)), "der_key", 0),
        ("\r\n".join(lines(ssh, 70)), "ssh_key", 0),
        (f"/etc/keys/{plain}", "der_key", 10),
        (f"x/{base64.b64encode(ssh).decode()}", "ssh_key", 2),
        (f"0x{rsa.hex()}", "der_key", 2),
        (pem(head + "\n".join(lines(rng.randbytes(161))) + "\n"), None, 0),
        (pem("\\n" + "\\n".join(lines(rng.randbytes(160))) + "\\n"), None, 0),
        ("\n".join(lines(rng.randbytes(200))), None, 0),
        (f"/etc/keys/{plain[:-8]}", None, 0),
        ("/MIIB" + base64.b64encode(rng.randbytes(90)).decode(), None, 0),
    ]
    for text, kind, at in cases:
        got = secret_scan.added_spans(f"é {text} end")
        assert got == ([] if kind is None else [(2 + at, 2 + len(text), kind)]), text


def test_secrets(spark, none):
    texts = [None, "", "token:token:abcdefgh password = 'abc.def-12' PassWord=short ſecret=abcdefghij", "AKIA" + "A" * 12 + " AKIA" + "B" * 11,
             "x" + "0f" * 16 + "g " + "ab" * 15, "api_key: " + "a" * 50_000, *[f"😀 {t}" for ts in secrets_text().values() for t in ts]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[3])], "doc_id long, text string")
    got = secret_scan.secret_scan(table).collect()
    assert len(got) == len(texts) + 1
    for row in got:
        base = brute.base_secrets(texts[3 if row.doc_id is None else row.doc_id])
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        spans = [s for s in row.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in secret_scan.KINDS[:3]] == [s for s in base.split(",") if s]
        assert row.n_assign + row.n_access + row.n_hex == len([s for s in base.split(",") if s])
    assert sum("der_key" in r.spans for r in got) == 5 and sum("ssh_key" in r.spans for r in got) == 2
    assert secret_scan.secret_scan(none).collect() == []


def test_a_worker_drops_what_another_operator_kept():
    from recordmill.llm import shared

    model = token_records.encoder(PATH)
    model.encode(pa.array(["some words"], pa.string()))
    assert token_records.encoder(PATH) is model and "words" in shared.KEPT["token_records"]
    shared.kept_by("near_duplicates")
    assert list(shared.KEPT) == ["near_duplicates"] and token_records.encoder(PATH) is not model
