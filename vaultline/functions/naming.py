"""Object names of the vault, from source table and column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes that source tables carry and object names drop.
SOURCE_PREFIXES = ("CMS_", "CMMS_")


def entity(name: Column, prefixes: Sequence[str] = SOURCE_PREFIXES, drop: Sequence[str] = ()) -> Column:
    """``CMS_TRADE_LEG`` gives ``TradeLeg``; every text in ``drop`` is removed first as well."""
    for text in (*prefixes, *drop):
        name = F.replace(name, F.lit(text), F.lit(""))
    spaced = F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
    return F.replace(spaced, F.lit(" "), F.lit(""))
