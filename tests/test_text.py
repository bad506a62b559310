import random
import re

import pytest

from recordmill.functions import text as T
from recordmill.functions import vocab

ALPHABET = list("aZé9 _-'/") + [" ", " ", "\u0085", "\u001c", "\u000b", "​", "\t", "\n", "　", "ß"]


def samples(n=400, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_norm_ws_agrees_with_unicode_white_space(apply):
    values = samples()
    assert apply(T.norm_ws, values) == [re.sub(r"\s+", " ", v).strip() for v in values]
    assert apply(T.norm_ws, [None, "", "   ", "a​b"]) == ["", "", "", "a​b"]


def test_norm_ws_is_idempotent(apply):
    once = apply(T.norm_ws, samples(seed=8))
    assert apply(T.norm_ws, once) == once


def test_strip_ws_only_touches_the_ends(apply):
    values = samples(seed=9)
    assert apply(T.strip_ws, values) == [v.strip() for v in values]


def test_whitespace_list_is_complete():
    assert set(T.WHITESPACE_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_title_case_starts_after_every_non_letter(apply):
    values = ["district-wide", "o'neil", "9km", "road / rehab", "ÉCOLE élan", "", "ALL WARDS", "a_b c2d"]
    assert apply(T.title_case, values) == [v.title() for v in values]
    mixed = [v.replace("ß", "s") for v in samples(seed=10)]
    assert apply(T.title_case, mixed) == [v.title() for v in mixed]


def test_category_label(apply):
    assert apply(T.category_label, ["community_projects", " grants_and  loans "]) == ["Community Projects", "Grants And Loans"]


def test_canonical_if_mentions(apply):
    got = apply(lambda c: T.canonical_if_mentions(c, "River", "River Council"), ["", None, "the RIVERside", " Other  one "])
    assert got == ["River Council", "River Council", "River Council", "Other one"]


def test_defaults(apply):
    assert apply(lambda c: T.or_default(c, "Fund"), ["", None, " x  y "]) == ["Fund", "Fund", "x y"]
    got = apply(lambda a, b: T.first_non_empty(a, b), [(" ", "b "), ("a", "b"), (None, None)])
    assert got == ["b", "a", ""]


@pytest.mark.parametrize(
    ("function", "pattern", "group"),
    [(T.first_year, r"(19|20)[0-9]{2}", 0), (T.bounded_year, r"(?<!\w)(20[0-9]{2})(?!\w)", 1)],
)
def test_years(apply, function, pattern, group):
    values = ["", "2025", "FY2025", "in 2025.", "12025 and 2019", "1998/99", "é2031", "_2025", "20256", "2025_", "x 1999 2000"]
    expected = [m.group(group) if (m := re.search(pattern, v)) else "" for v in values]
    assert apply(function, values) == expected


def test_published_date(apply):
    values = [
        "Road Published September 3, 2026 text", "july  4, 2025", "PUBLISHED May 1, 2024", "May 1, 1999", "", "no, 2025",
    ]
    assert apply(T.published_date, values) == ["September 3, 2026", "july  4, 2025", "PUBLISHED May 1, 2024", "", "", ""]


def test_without_leading(apply):
    pairs = [("ROAD opened  today", "Road Opened"), ("Other text", "Road"), ("Road", "Road"), ("x", "longer title")]
    assert apply(T.without_leading, pairs) == ["today", "Other text", "", "x"]


def test_safe_stem(apply):
    names = ["__a b/c__", "é-x", "a" * 120, "___"]
    assert apply(T.safe_stem, names) == ["a_b_c", "-x", "a" * 120, ""]
    assert apply(lambda c: T.safe_stem(c, 100), names) == ["a_b_c", "-x", "a" * 100, ""]


def test_mentions_any(apply):
    got = apply(lambda c: T.mentions_any(c, ("cdf", "ward development")), ["The CDF", "Ward  Development", "ward development", None])
    assert got == [True, False, True, False]


def test_plain_number(apply):
    values = [12800000.0, 0.1, 5.0, 1234567890123.25, 0.00025, 1e15, -3e7, None]
    expected = ["12800000.0", "0.1", "5.0", "1234567890123.25", "0.00025", "1000000000000000.0", "-30000000.0", None]
    assert apply(T.plain_number, values, "double") == expected
    rng = random.Random(3)
    numbers = [rng.uniform(-1, 1) * 10 ** rng.randint(-3, 15) for _ in range(300)]
    assert [float(v) for v in apply(T.plain_number, numbers, "double")] == numbers


def test_status_vocabulary(apply):
    words = list(vocab.STATUS_WORDS)
    assert len(words) == 23
    assert apply(vocab.status, words) == list(vocab.STATUS_WORDS.values())
    assert apply(vocab.status, [" COMPLETED ", "Completed / ready for commissioning", None]) == ["Completed", "Unknown", "Unknown"]


def test_ward_vocabulary(apply):
    words = vocab.ward_words("Rivertown")
    got = apply(
        lambda c: vocab.from_words_or_title(c, words),
        ["central", "RIVERTOWN", "rivertown central", "Lubwe", "all wards", "", None, "o'neil ward"],
    )
    assert got == ["Rivertown Central"] * 3 + ["Lubwe", "All Wards", "", "", "O'Neil Ward"]
