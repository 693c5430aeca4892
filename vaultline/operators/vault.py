"""Loads of hubs, links, satellites and reference tables. Each returns the rows to append."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.clock import timestamp
from vaultline.functions.hashing import NULL_TEXT, HashRule
from vaultline.functions.skew import HOT_SHARE, lookup
from vaultline.specs import (
    APPLIED_TIME, DEFAULT_LOAD_ID, HASH_DIFF, LOAD_ID, LOAD_TIME, RECORD_SOURCE, HubSpec, LinkSpec, SatSpec,
)

Spec = TypeVar("Spec", HubSpec, LinkSpec, SatSpec)
DEFAULT_RULE = HashRule()


Sources = Mapping[str | tuple[str, ...], DataFrame]


def source_frame(sources: Sources, name: str, schema: str | None = None, database: str | None = None) -> DataFrame:
    """The frame of a source object. Sources are named by object, by (schema, object) or by (database, schema, object);
    whatever both the name and the spec say has to agree, and an object that two sources could be is an error."""
    wanted = (database, schema, name)
    found = []
    for key in sources:
        parts = (key,) if isinstance(key, str) else tuple(key)
        if all(w is None or p == w for p, w in zip(reversed(parts), reversed(wanted))):
            found.append(key)
    if len(found) != 1:
        raise KeyError(f"{'.'.join(p for p in wanted if p)}: {len(found)} sources of this name, of {sorted(map(str, sources))}")
    return sources[found[0]]


def load_hub(
    sources: Sources, hub: DataFrame | None, spec: HubSpec, load_time: datetime | str,
    *, rule: HashRule = DEFAULT_RULE,
) -> DataFrame:
    """Business keys that the hub does not have, from all its sources.

    Keys with a NULL part are left out and blanks at the end of a text key do not count. Where several
    sources bring a key, the first one named is its record source. Keys are combined before their
    shuffle; the anti-join on the same keys needs no second one; only new keys are hashed.
    """
    parts = []
    for position, source in enumerate(spec.sources):
        frame = source_frame(sources, source.object_name, source.schema, source.database)
        keys = [_key(frame, column).alias(name) for name, column in source.keys.items()]
        parts.append(frame.select(*keys).dropna().withColumn("_source", F.lit(position)))
    staged = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        staged = staged.groupBy(*spec.keys).agg(F.min("_source").alias("_source"))
    else:  # the keys alone, as nothing has to be held beside them
        staged = staged.select(*spec.keys).distinct().withColumn("_source", F.lit(0))
    if hub is not None:
        known = hub.select(*[_key(hub, k).alias(k) for k in spec.keys])
        staged = staged.join(known, spec.keys, "left_anti")
    # Hashed in the order of the source columns' names, as a link hashes the same key.
    return staged.select(
        rule.key(spec.keys, spec.sources[0].keys).alias(spec.hash_key),
        *_audit(load_time, _pick("_source", [s.record_source for s in spec.sources])),
        *spec.keys,
    )


def load_link(
    sources: Sources, link: DataFrame | None, spec: LinkSpec, load_time: datetime | str,
    *, min_keys: int = 2, rule: HashRule = DEFAULT_RULE,
) -> DataFrame:
    """Key combinations that the link does not have. A row counts with at least ``min_keys`` of its
    source keys present. Source keys are combined before their shuffle, and hashed after."""
    parts = []
    for position, source in enumerate(spec.sources):
        frame, columns = source_frame(sources, source.object_name, source.schema, source.database), source.columns
        present = reduce(Column.__add__, [F.col(c).isNotNull().cast("int") for c in columns])
        keys = frame.where(present >= min_keys).select(*[_hashed_text(frame, c).alias(c) for c in columns]).distinct()
        parts.append(keys.select(
            rule.key(columns).alias(spec.hash_key),
            F.lit(position).alias("_source"),
            *[rule.key(source.hubs[k]).alias(k) for k in spec.hub_keys],
        ))
    staged = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        # Each source's rows are distinct already: dealt by hash as they are, they meet once, for both of these.
        by_link = Window.partitionBy(spec.hash_key)
        staged = (
            staged.repartition(spec.hash_key)
            .groupBy(spec.hash_key, *spec.hub_keys).agg(F.min("_source").alias("_source"))
            .withColumn("_first", F.min("_source").over(by_link))
            .where(F.col("_source") == F.col("_first"))
        )
    if link is not None:
        staged = staged.join(link.select(spec.hash_key), spec.hash_key, "left_anti")
    return staged.select(
        spec.hash_key,
        *_audit(load_time, _pick("_source", [s.record_source for s in spec.sources])),
        *spec.hub_keys,
    )


def load_staged(
    stg: DataFrame, target: DataFrame | None, hash_key: str, columns: Sequence[str], load_time: datetime | str,
    *, dedupe: bool = False,
) -> DataFrame:
    """Business hub or link: staged with its hash key, added where the target does not have it.

    Repeated staged rows stay repeated unless ``dedupe`` is set. Both sides of the anti-join come
    straight from their shuffles, so an oversized key is split at run time.
    """
    staged = stg.where(F.col(hash_key).isNotNull()).select(hash_key, RECORD_SOURCE, *columns)
    if dedupe:
        staged = staged.distinct()
    if target is not None:
        staged = staged.join(target.select(hash_key), hash_key, "left_anti")
    return staged.select(hash_key, *_audit(load_time, F.col(RECORD_SOURCE)), *columns)


def load_sat(
    stg: DataFrame, sat: DataFrame | None, spec: SatSpec, load_time: datetime | str,
    *, applied_time: datetime | str | None = None, dedupe: bool = False, rule: HashRule = DEFAULT_RULE,
    hot_share: int | None = HOT_SHARE,
) -> DataFrame:
    """New keys, and known keys whose hash difference is not that of their latest version.

    A raw source is hashed here (``spec.keys``); a business one brings its hash key. Repeated staged
    rows stay repeated unless ``dedupe`` is set, so one key may hold many: keys above a share of
    ``1 / hot_share`` are looked up where they are. ``hot_share=None`` skips that for a staging that
    is known to hold each key once.
    """
    key = spec.hash_key
    source = F.lit(spec.record_source) if spec.record_source else F.col(RECORD_SOURCE)
    hashed = rule.key(spec.keys) if spec.keys else F.col(key)
    usable = stg.dropna(subset=list(spec.keys) or [key]).withColumnsRenamed({v: k for k, v in spec.renamed.items()})
    staged = usable.select(
        hashed.alias(key), source.alias(RECORD_SOURCE), rule.key(spec.hashed).alias(HASH_DIFF), *spec.attributes
    )
    if dedupe:
        staged = staged.distinct()
    if sat is not None:
        before = latest(sat, key).withColumnRenamed(HASH_DIFF, "_latest")
        staged = lookup(staged, before, [key], None if dedupe else hot_share).where(
            F.col("_latest").isNull() | (F.col(HASH_DIFF) != F.col("_latest"))
        )
    return staged.select(
        key, timestamp(load_time).alias(LOAD_TIME), RECORD_SOURCE, HASH_DIFF,
        timestamp(applied_time or load_time).alias(APPLIED_TIME), F.lit(DEFAULT_LOAD_ID).cast("bigint").alias(LOAD_ID),
        *spec.attributes,
    )


def latest(sat: DataFrame, key: str) -> DataFrame:
    """The hash difference of the latest version of each key. Ties in load time are settled by applied
    time, then hash. The window keeps one row per key and task before its shuffle."""
    order = [F.desc(LOAD_TIME), F.desc(APPLIED_TIME), F.desc(HASH_DIFF)]
    return (
        sat.select(key, LOAD_TIME, APPLIED_TIME, HASH_DIFF)
        .withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
        .where(F.col("_n") == 1)
        .select(key, HASH_DIFF)
    )


def load_reference(
    src: DataFrame, business_key: str, record_source: str, load_time: datetime | str
) -> DataFrame:
    """One row per business key; of several, the one that comes first by its other columns."""
    others = [c for c in src.columns if c != business_key]
    kept = src.where(F.col(business_key).isNotNull()).groupBy(business_key).agg(F.min(F.struct(*others)).alias("r"))
    return kept.select(business_key, *_audit(load_time, F.lit(record_source)), "r.*")


def select_specs(specs: Iterable[Spec], schema: str | None = None, name: str | None = None) -> list[Spec]:
    """Objects of a schema and name; None, ``NULL`` and ``ALL`` stand for every one."""
    every = (None, "NULL", "ALL")
    return [s for s in specs if (schema in every or s.schema == schema) and (name in every or s.name == name)]


def load_hubs(
    specs: Iterable[HubSpec], sources: Sources, hubs: Mapping[str, DataFrame], load_time: datetime | str,
    schema: str | None = None, name: str | None = None, **options,
) -> dict[str, DataFrame]:
    return {s.name: load_hub(sources, hubs.get(s.name), s, load_time, **options) for s in _chosen(specs, schema, name)}


def load_links(
    specs: Iterable[LinkSpec], sources: Sources, links: Mapping[str, DataFrame], load_time: datetime | str,
    schema: str | None = None, name: str | None = None, **options,
) -> dict[str, DataFrame]:
    return {s.name: load_link(sources, links.get(s.name), s, load_time, **options) for s in _chosen(specs, schema, name)}


def load_sats(
    specs: Iterable[SatSpec], sources: Sources, sats: Mapping[str, DataFrame], load_time: datetime | str,
    schema: str | None = None, name: str | None = None, **options,
) -> dict[str, DataFrame]:
    return {
        s.name: load_sat(source_frame(sources, s.object_name or s.name, s.source_schema, s.database), sats.get(s.name), s, load_time, **options)
        for s in _chosen(specs, schema, name)
    }


def _chosen(specs: Iterable[Spec], schema: str | None, name: str | None) -> list[Spec]:
    """``select_specs``, whose names must tell the objects apart."""
    chosen = select_specs(specs, schema, name)
    if len({s.name for s in chosen}) != len(chosen):
        raise ValueError("objects of one name in several schemas: choose a schema")
    return chosen


def _key(frame: DataFrame, column: str) -> Column:
    """A text key without the blanks at its end, which neither the hash nor equality regards."""
    return F.rtrim(column) if dict(frame.dtypes)[column] == "string" else F.col(column)


def _hashed_text(frame: DataFrame, column: str) -> Column:
    """What the hash sees of a text key, so that equal hashes are combined before they are computed."""
    if dict(frame.dtypes)[column] == "string":
        return F.coalesce(F.rtrim(column), F.lit(NULL_TEXT))
    return F.col(column)


def _pick(position: str, values: Sequence[str]) -> Column:
    if len(values) == 1:
        return F.lit(values[0])
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(position) + 1)


def _audit(load_time: datetime | str, record_source: Column) -> list[Column]:
    return [
        timestamp(load_time).alias(LOAD_TIME),
        record_source.alias(RECORD_SOURCE),
        F.lit(DEFAULT_LOAD_ID).cast("bigint").alias(LOAD_ID),
    ]
