"""Money written as text.

The odd results are kept on purpose, because published figures depend on them:
``K2.8m`` is 2.8, ``17 projects; 19 classrooms`` is 1719, ``5 k`` is 5 and
``2.8-million-kwacha`` is no number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.text import norm_ws, text_or_empty

# Currency words that are dropped, and scale words.
CURRENCY_WORDS = r"(?U)\b(?:zmw|zambian\s+kwacha|kwacha|k)\b"
SCALES = {"billion": 1e9, "million": 1e6}
SUFFIXES = {"k": 1e3, "m": 1e6}


def _scale_word(c: Column) -> Column:
    return (
        F.when(F.contains(c, F.lit("billion")), F.lit("billion"))
        .when(F.contains(c, F.lit("million")), F.lit("million"))
        .otherwise(F.lit(""))
    )


def _factor(word: Column, factors: dict[str, float]) -> Column:
    out = F.lit(1.0)
    for name, factor in factors.items():
        out = F.when(word == name, F.lit(factor)).otherwise(out)
    return out


def parse_amount(c: Column) -> Column:
    """Amount of a money text as double; null where it is not a single number."""
    text = F.regexp_replace(F.lower(norm_ws(c)), CURRENCY_WORDS, " ")
    text = norm_ws(F.translate(text, ",", ""))
    word = _scale_word(text)
    body = F.trim(F.when(word == "", text).otherwise(F.replace(text, word, F.lit(" "))))

    plain = r"^([0-9]+(?:\.[0-9]+)?)\s*([km]?)$"
    number = F.regexp_extract(body, plain, 1).try_cast("double")
    suffix = F.regexp_extract(body, plain, 2)
    kept = F.regexp_replace(body, r"[^0-9.\-]", "").try_cast("double")
    scale = _factor(word, SCALES)
    return F.when(number.isNotNull(), number * _factor(suffix, SUFFIXES) * scale).otherwise(kept * scale)


def mentioned_amount(c: Column) -> Column:
    """First ``<number> [million|billion] kwacha`` of a prose text, else null.

    The search only starts on texts that hold the currency word at all, and the
    separators are matched once, so long runs of digits or blanks stay cheap.
    """
    text = text_or_empty(c)
    pattern = r"(?i)([0-9]+(?:[.,][0-9]+)?)[-\s]*(?:(million|billion)[-\s]*)?kwacha"
    number = F.translate(F.regexp_extract(text, pattern, 1), ",", "").try_cast("double")
    unit = F.lower(F.regexp_extract(text, pattern, 2))
    amount = number * _factor(unit, SCALES)
    return F.when(F.contains(F.lower(text), F.lit("kwacha")), amount)
