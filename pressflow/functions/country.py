"""Source to country lookup."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressflow.fixed_values import SOURCE_COUNTRY, UNKNOWN_COUNTRY


def country_of(source: Column, countries: dict[str, str] | None = None) -> Column:
    """Country of a source. The rows are a literal in the plan, so there is no join."""
    rows = SOURCE_COUNTRY if countries is None else countries
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(rows.items())])
    return F.coalesce(F.try_element_at(lookup, source), F.lit(UNKNOWN_COUNTRY))
