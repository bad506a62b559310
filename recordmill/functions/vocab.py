"""Controlled vocabularies held as literal maps.

A literal map travels inside the plan, so it suits lists of some dozen entries.
Larger vocabularies are tables and go through ``operators.joins.lookup_join``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.staging import literal_map
from recordmill.functions.text import lower_tidy, norm_ws, title_case

# Project status words and the status they stand for.
STATUS_WORDS = {
    "completed": "Completed",
    "complete": "Completed",
    "done": "Completed",
    "finished": "Completed",
    "in progress": "In progress",
    "in-progress": "In progress",
    "ongoing": "In progress",
    "on going": "In progress",
    "under construction": "In progress",
    "under procurement": "Under procurement",
    "procurement": "Under procurement",
    "tendering": "Under procurement",
    "deferred": "Deferred",
    "postponed": "Deferred",
    "stalled": "Deferred",
    "proposed": "Proposed",
    "planned": "Proposed",
    "not started": "Proposed",
    "": "Unknown",
    "unknown": "Unknown",
    "n/a": "Unknown",
    "na": "Unknown",
    "-": "Unknown",
}


def ward_words(town: str) -> dict[str, str]:
    """Ward spellings; those that name the town itself come from the parameter."""
    centre = f"{town.title()} Central"
    # Ward names.
    return {
        "kapilibila": "Kapilibila",
        f"{town.lower()} central": centre,
        "central": centre,
        town.lower(): centre,
        "chifunabuli": "Chifunabuli",
        "kasaba": "Kasaba",
        "lubwe": "Lubwe",
        "mabumba": "Mabumba",
        "mansa": "Mansa",
        "senama": "Senama",
        "chishi": "Chishi",
    }


def _found(c: Column, words: dict[str, str]) -> Column:
    return F.try_element_at(literal_map(words), lower_tidy(c))


def from_words(c: Column, words: dict[str, str], default: str) -> Column:
    """Exact match on the lower-cased value; ``default`` for anything else."""
    return F.coalesce(_found(c, words), F.lit(default))


def from_words_or_title(c: Column, words: dict[str, str]) -> Column:
    """Exact match on the lower-cased value; other values are title-cased; '' stays ''."""
    value = norm_ws(c)
    return F.when(value == "", F.lit("")).otherwise(F.coalesce(_found(c, words), title_case(value)))


def status(c: Column) -> Column:
    return from_words(c, STATUS_WORDS, "Unknown")
