"""Whitespace, title case, years and other text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space is the Unicode property plus the four ASCII separators. Java's \s
# is ASCII only, and U+200B is not white space.
WHITESPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# What normalising changes: runs of two or more, and single ones that are not a
# plain space. Text that is tidy already is not rewritten.
_UNTIDY = rf"{WHITESPACE}(?:{WHITESPACE}+|(?<! ))"

# Month names, and the date of an article header made of them.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
_PUBLISHED = r"(?i)(?:Published\s+)?(?:" + "|".join(MONTHS) + r")\s+[0-9]{1,2},\s+20[0-9]{2}"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_ws(c: Column) -> Column:
    """Remove white space at both ends and leave the inside alone."""
    return F.btrim(text_or_empty(c), F.lit(WHITESPACE_CHARS))


def norm_ws(c: Column) -> Column:
    """Null becomes ''; runs of Unicode white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text_or_empty(c), _UNTIDY, " "))


def or_default(c: Column, default: str) -> Column:
    """The normalised value, or ``default`` where nothing is left of it."""
    return F.coalesce(F.nullif(norm_ws(c), F.lit("")), F.lit(default))


def first_non_empty(*columns: Column) -> Column:
    """The first normalised value that is not empty, else ''."""
    return F.coalesce(*[F.nullif(norm_ws(c), F.lit("")) for c in columns], F.lit(""))


def title_case(c: Column) -> Column:
    """Upper-case the first letter after every non-letter, lower-case the rest.

    ``initcap`` only starts a word after white space, so each run of cased
    letters is capitalised on its own: ``district-wide o'neil 9km`` becomes
    ``District-Wide O'Neil 9Km``.
    """
    runs = F.regexp_extract_all(c, F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def category_label(c: Column) -> Column:
    return title_case(F.translate(norm_ws(c), "_", " "))


def lower_tidy(c: Column) -> Column:
    return F.lower(norm_ws(c))


def canonical_if_mentions(c: Column, token: str, canonical: str) -> Column:
    """``canonical`` where the value is empty or mentions ``token``, else the value."""
    value = norm_ws(c)
    named = (value == "") | F.contains(F.lower(value), F.lit(token.lower()))
    return F.when(named, F.lit(canonical)).otherwise(value)


def first_year(c: Column) -> Column:
    """First 19xx or 20xx anywhere, also inside a longer run of digits."""
    return F.regexp_extract(text_or_empty(c), r"(?:19|20)[0-9]{2}", 0)


def bounded_year(c: Column) -> Column:
    """First 20xx that stands alone between non-word characters."""
    word = r"[\p{L}\p{N}_]"
    return F.regexp_extract(text_or_empty(c), rf"20(?<!{word}20)[0-9]{{2}}(?!{word})", 0)


def published_date(c: Column) -> Column:
    """First ``Month d, 20yy`` of a text; a leading ``Published`` is dropped.

    The month names are only searched in texts that hold ``d, 20yy`` at all.
    """
    text = text_or_empty(c)
    found = F.replace(F.regexp_extract(text, _PUBLISHED, 0), F.lit("Published"), F.lit(""))
    return F.when(F.rlike(text, F.lit(r"[0-9],\s+20[0-9]{2}")), strip_ws(found)).otherwise(F.lit(""))


def without_leading(c: Column, title: Column) -> Column:
    """Drop ``title`` from the start of the text, compared without case."""
    rest = norm_ws(F.substring(c, F.length(title) + F.lit(1), F.length(c)))
    leads = F.lower(F.substring(c, F.lit(1), F.length(title))) == F.lower(title)
    return F.when(leads, rest).otherwise(c)


def head_chars(c: Column, n: int | None) -> Column:
    """The first ``n`` characters; the whole text where ``n`` is None."""
    return c if n is None else F.substring(c, 1, n)


def mentions_any(c: Column, terms: tuple[str, ...]) -> Column:
    """True where the lower-cased text contains any of ``terms``."""
    lowered = F.lower(text_or_empty(c))
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.contains(lowered, F.lit(term))
    return hit


def safe_stem(c: Column, length: int | None = None) -> Column:
    """File stem made of ASCII letters, digits, ``_`` and ``-``; at most ``length`` long if given."""
    joined = F.regexp_replace(text_or_empty(c), r"[^\w-]+", "_")
    return head_chars(F.btrim(joined, F.lit("_")), length)


def plain_number(c: Column) -> Column:
    """A double as decimal text with at least one decimal: ``12800000.0``, not ``1.28E7``.

    Only printed exponents are rewritten, and only where plain digits stay exact.
    """
    printed = c.cast("string")
    fixed = printed.try_cast("decimal(38,21)").cast("string")
    spelled = F.contains(printed, F.lit("E")) & (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    return F.when(spelled, F.regexp_replace(fixed, r"(\.[0-9]+?)0+$", "$1")).otherwise(printed)
