"""Vault loads with storage: each object is a parquet folder that new rows are appended to.

Every load compares with what is stored, so one that failed half way can run again. Hubs, links and
satellites do not wait for each other.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import SparkSession

from vaultline.functions.hashing import HashRule
from vaultline.operators import vault
from vaultline.sources.readers import read_stored
from vaultline.specs import HubSpec, LinkSpec, SatSpec


def load_vault(
    spark: SparkSession, specs: Iterable[HubSpec | LinkSpec | SatSpec], sources: vault.Sources, root: str,
    load_time: datetime | str, schema: str | None = None, name: str | None = None, rule: HashRule = HashRule(),
) -> list[str]:
    """Loads the chosen objects from their sources and returns their folders."""
    done = []
    for spec in vault.select_specs(specs, schema, name):
        path = f"{root}/{spec.schema}/{spec.name}"
        stored = read_stored(spark, path)
        if isinstance(spec, HubSpec):
            new = vault.load_hub(sources, stored, spec, load_time, rule=rule)
        elif isinstance(spec, LinkSpec):
            new = vault.load_link(sources, stored, spec, load_time, rule=rule)
        else:
            source = vault.source_frame(sources, spec.object_name or spec.name, spec.source_schema, spec.database)
            new = vault.load_sat(source, stored, spec, load_time, rule=rule)
        new.write.mode("append").parquet(path)
        done.append(path)
    return done
