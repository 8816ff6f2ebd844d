"""Identity and layout keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def article_id(url: Column) -> Column:
    """Hex SHA-1 of the URL."""
    return F.sha1(url)


def partition_key(source: Column) -> Column:
    """A source name made safe for a folder name."""
    safe = F.btrim(F.regexp_replace(source, "[^A-Za-z0-9_-]+", "_"), F.lit("_"))
    return F.coalesce(F.when(safe != "", safe), F.lit("unknown"))


def silver_key(source_key: Column, dt: Column, id: Column) -> Column:
    """Position of an article in the listing order of the silver layer."""
    return F.concat(
        F.lit("source="), source_key, F.lit("/dt="), dt.cast("string"),
        F.lit("/"), F.coalesce(id, F.lit("None")), F.lit(".json"),
    )
