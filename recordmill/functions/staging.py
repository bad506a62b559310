"""Parts of expressions: a value used several times, a literal map."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``.

    Catalyst shares repeated expressions of a projection only where all of them
    are always evaluated: not inside ``when`` branches, and not inside array
    lambdas. A lambda parameter is a value in both.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def literal_map(entries: dict[str, str]) -> Column:
    """A map of strings that becomes one literal of the plan, however many entries it has."""
    text = "\x02".join(f"{key}\x01{value}" for key, value in entries.items())
    return F.str_to_map(F.lit(text), F.lit("\x02"), F.lit("\x01"))
