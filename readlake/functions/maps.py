"""Maps from text whose keys may repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_wins(entries: Column) -> Column:
    """A map of an array of (key, value); of entries with one key the last counts. Null for null; null keys go."""

    def of(e: Column) -> Column:
        later = lambda x, i: F.exists(F.slice(e, i + 2, F.greatest(F.lit(0), F.size(e) - i - 1)), lambda y: y["key"] == x["key"])
        return F.map_from_entries(F.filter(e, lambda x, i: x["key"].isNotNull() & ~later(x, i)))

    # the entries are made once, not once more for each of them
    return F.transform(F.array(entries), of)[0]
