"""Semi joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of the rows on, so there are at most 1 / share hot keys.
HOT_SHARE = 1 / 512


def semi_join(rows: DataFrame, counted: DataFrame, on: list[str], count: str) -> DataFrame:
    """Rows whose key is in ``counted``, a stored table of distinct keys with their numbers of rows.

    The hot keys, at most 512 by their definition, are broadcast and their rows need no shuffle;
    all others are shuffled to a join whose keys each hold a small share.
    """
    total = counted.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = counted.where(F.col(count) > int(total * HOT_SHARE) + 1).select(*on)
    few = F.broadcast(hot)
    cold = counted.where(F.col(count) <= int(total * HOT_SHARE) + 1).select(*on)
    return rows.join(few, on, "left_semi").unionByName(
        rows.join(few, on, "left_anti").join(cold, on, "left_semi")
    )
