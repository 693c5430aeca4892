"""Snapshot comparison: a new full copy of a source against the current rows of its history."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import all_equal, any_null
from vaultline.functions.skew import HOT_SHARE, known_hot_keys, salted_join
from vaultline.specs import (
    ADD, CURRENT, GEOMETRY, MODIFY, OPERATION, REMOVE, UPDATE_FLAG_SUFFIX, ColumnSpec, TableSpec,
)

GeomEqual = Callable[[Column, Column], Column]


def current(sds: DataFrame) -> DataFrame:
    return sds.where(F.col(CURRENT) == "Y")


def null_keyed(stg: DataFrame, spec: TableSpec) -> DataFrame:
    """Staged rows that the delta leaves out because a natural key part is NULL."""
    return stg.where(any_null(spec.keys))


def delta(
    stg: DataFrame,
    sds: DataFrame,
    spec: TableSpec,
    *,
    null_safe: bool = False,
    on_null_key: str = "drop",
    snapshot_type: str | None = None,
    geom_equal: GeomEqual | None = None,
    hot_share: int | None = HOT_SHARE,
    stored_hot_share: int | None = None,
) -> DataFrame:
    """Added, modified and removed rows, each with an update flag per tracked column.

    A change is SQL ``<>``, so NULL against a value is none; ``null_safe`` makes it one. Only tracked
    columns count. ``on_null_key``: ``drop`` staged rows with a NULL key part (see ``null_keyed``),
    fail with ``error``, or ``ref``: keep them as additions, blank where the first key is NULL. A
    ``DELTA`` snapshot lists changes only, so absence removes nothing.

    Each side is read and shuffled once, for a full outer join on the natural keys. NULL keys match nothing and
    never enter it. Spark cannot split an oversized key of a full outer join, so staged keys that
    repeat more than one ``hot_share``-th of all rows are salted; ``hot_share=None`` skips looking for them in a
    staging that is known to hold each key once. ``stored_hot_share`` does the same for stored keys, which a sound
    history does not repeat.
    """
    compared = compare(
        stg, sds, spec, null_safe=null_safe, on_null_key=on_null_key, snapshot_type=snapshot_type,
        geom_equal=geom_equal, hot_share=hot_share, stored_hot_share=stored_hot_share,
    )
    return compared.where(F.col(OPERATION).isNotNull()).select(OPERATION, *merged(spec))


def compare(
    stg: DataFrame,
    sds: DataFrame,
    spec: TableSpec,
    *,
    null_safe: bool = False,
    on_null_key: str = "drop",
    snapshot_type: str | None = None,
    geom_equal: GeomEqual | None = None,
    hot_share: int | None = HOT_SHARE,
    stored_hot_share: int | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The join behind ``delta``, changed or not: staged columns as ``s_``, stored ones (and those to
    ``carry``) as ``o_``, the update flags, and the operation, NULL for an unchanged row."""
    if on_null_key not in ("drop", "error", "ref"):
        raise ValueError("on_null_key must be 'drop', 'error' or 'ref'")
    keys, first = spec.keys, spec.keys[0]
    staged_keys, stored_keys = [f"s_{k}" for k in keys], [f"o_{k}" for k in keys]
    staged = stg.select(*[F.col(c).alias(f"s_{c}") for c in spec.names])
    stored = current(sds).select(*[F.col(c).alias(f"o_{c}") for c in [*spec.names, *carry]])
    if on_null_key == "error":
        failed = F.when(any_null(staged_keys), F.raise_error(F.lit(f"{spec.table}: NULL natural key")))
        usable = staged.withColumn(f"s_{first}", failed.otherwise(F.col(f"s_{first}")))
    else:
        usable = staged.where(~any_null(staged_keys))
    known = stored.where(~any_null(stored_keys))
    whole = (snapshot_type or spec.snapshot_type) == "FULL"

    same = all_equal(staged_keys, stored_keys)
    # Changes alone leave stored rows out, unless the caller carries them on.
    if not whole and not carry:
        pairs = usable.join(known, same, "left")
    elif hot_share is None:
        pairs = usable.join(known, same, "full")
    else:
        pairs = _pairs(usable, known, staged_keys, stored_keys, hot_share, stored_hot_share)

    in_staging, in_history = F.col(f"s_{first}").isNotNull(), F.col(f"o_{first}").isNotNull()
    changes = {c.name: _differs(c, null_safe, geom_equal) for c in spec.tracked}
    changed = reduce(or_, changes.values(), F.lit(False))
    absent = F.lit(REMOVE) if whole else F.lit(None).cast("string")
    operation = F.when(~in_history, ADD).when(~in_staging, absent).when(changed, MODIFY)
    parts = [
        pairs.select(
            "*", operation.alias(OPERATION),
            *[_flag(in_staging & in_history & changes[c.name]).alias(c.name + UPDATE_FLAG_SUFFIX) for c in spec.tracked],
        )
    ]
    no_flags = [_flag(F.lit(False)).alias(c.name + UPDATE_FLAG_SUFFIX) for c in spec.tracked]
    if whole or carry:
        # Stored rows with a NULL key part, which a sound history does not have.
        lost = F.when(in_history, absent).otherwise(F.lit(ADD) if whole else absent)
        parts.append(_beside(stored.where(any_null(stored_keys)), staged).select("*", lost.alias(OPERATION), *no_flags))
    if on_null_key == "ref":
        blank = _beside(staged.where(any_null(staged_keys)), stored)
        parts.append(blank.select("*", F.lit(ADD).alias(OPERATION), *no_flags))
    return reduce(DataFrame.unionByName, parts)


def merged(spec: TableSpec) -> list[Column]:
    """Each column of a compared row, staged where the row is staged, with its update flag."""
    tracked, in_staging = {c.name for c in spec.tracked}, F.col(f"s_{spec.keys[0]}").isNotNull()
    out: list[Column] = []
    for name in spec.names:
        out.append(F.when(in_staging, F.col(f"s_{name}")).otherwise(F.col(f"o_{name}")).alias(name))
        if name in tracked:
            out.append(F.col(name + UPDATE_FLAG_SUFFIX))
    return out


def _beside(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that have no partner, with the partner's columns as NULL."""
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields])


def _flag(changed: Column) -> Column:
    return F.when(changed, "Y").otherwise("N")


def _pairs(
    staged: DataFrame, stored: DataFrame, staged_keys: list[str], stored_keys: list[str], hot_share: int,
    stored_hot_share: int | None,
) -> DataFrame:
    """Full outer pairs in one join; keys that many rows share are salted."""
    hot = known_hot_keys(staged, staged_keys, hot_share)
    hot_stored = known_hot_keys(stored, stored_keys, stored_hot_share) if stored_hot_share else None
    if hot is None and hot_stored is None:
        return staged.join(stored, all_equal(staged_keys, stored_keys), "full")
    return salted_join(staged, stored, staged_keys, stored_keys, "full", hot_left=hot, hot_right=hot_stored)


def _differs(column: ColumnSpec, null_safe: bool, geom_equal: GeomEqual | None) -> Column:
    new, old = F.col(f"s_{column.name}"), F.col(f"o_{column.name}")
    if column.data_type == GEOMETRY:
        same = geom_equal(new, old) if geom_equal else new == old
        return new.isNotNull() & old.isNotNull() & ~same
    return ~new.eqNullSafe(old) if null_safe else new != old


def operation_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(OPERATION).agg(F.count(F.lit(1)).alias("row_count"))


def update_flag_counts(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """How many modified rows changed each tracked column, all columns in one pass."""
    flags = [c.name for c in spec.tracked]
    counts = changes.where(F.col(OPERATION) == MODIFY).agg(
        *[F.count_if(F.col(c + UPDATE_FLAG_SUFFIX) == "Y").alias(c) for c in flags]
    )
    return counts.unpivot([], flags, "column_nm", "updated_rows")


def group_files(specs: Iterable[TableSpec], group_id: int) -> list[TableSpec]:
    """Files of a group that have column metadata, in file order."""
    return sorted((s for s in specs if s.group_id == group_id and s.columns), key=lambda s: s.file_id)


def group_delta(
    specs: Iterable[TableSpec], group_id: int, staging: dict[str, DataFrame], history: dict[str, DataFrame],
    **options,
) -> dict[str, DataFrame]:
    """One delta per file of the group; the frames are independent and may run at the same time."""
    return {
        s.table: delta(staging[s.table], history[s.table], s, **options) for s in group_files(specs, group_id)
    }
