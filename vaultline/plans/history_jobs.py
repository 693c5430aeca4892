"""History loads with storage.

A history folder holds attempts at batches. An attempt is checked where it lies, and only then named in the commit log
with the attempt it builds on; readers follow that chain. So a refused attempt, or one that another bypassed, is never
part of a history; a batch that runs again makes a new attempt, and what was built on the old one stays as it was.
Nothing that may be read is overwritten. The batch id is the caller's; ``forget_attempts`` names the folders that no
history needs.

A whole attempt holds all current rows and the versions it closed. The attempts after it hold only the versions they
opened and closed, so that a small change costs a small write; reading the current rows leaves out of the whole ones
those whose keys changed, and takes the last version of each of these. When the changed rows reach ``WHOLE_SHARE`` of the
whole ones, or their attempts ``WHOLE_AFTER``, the next attempt is a whole one again. All versions that an attempt
closed end at its file date, so a read as of a moment opens no attempt that closed before it.

Natural keys are unique in a staging, or the load is refused. Staged rows that cannot be loaded (a value that its type
cannot hold, a natural key without a value) end the load before anything is published; with ``on_bad="quarantine"``
they are stored with their reasons instead, together with every other row of their keys, and stored rows with these
keys stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.clock import as_datetime
from vaultline.functions.keys import any_null
from vaultline.operators import cdc, conform, scd2
from vaultline.plans.commit_log import Commit, CommitLog
from vaultline.specs import CURRENT, MODIFY, OPERATION, REMOVE, ColumnSpec, TableSpec

#: Changed rows, as a share of the whole ones, and attempts after which all current rows are written again.
WHOLE_SHARE = 0.25
WHOLE_AFTER = 16
#: Closed rows whose keys are not broadcast, as a file's size tells little about them.
BROADCAST_ROWS = 1_000_000
HELD_BACK = "another row of this key is refused"
_CHANGED = "_changed"


def commits(spark: SparkSession, root: str) -> dict[int, Commit]:
    """The last commit of each batch."""
    return {c.batch: c for c in _log(spark, root).read()}


def chain(spark: SparkSession, root: str, batch_id: int | None) -> list[Commit]:
    """The commits that make up the history at a batch, the batch's own first."""
    return _chain(_log(spark, root).read(), root, batch_id)


def read_current(spark: SparkSession, spec: TableSpec, root: str, batch_id: int) -> DataFrame:
    return _current(spark, spec, root, chain(spark, root, batch_id))


def read_history(spark: SparkSession, spec: TableSpec, root: str, batch_id: int) -> DataFrame:
    """The whole history as of a batch."""
    line = chain(spark, root, batch_id)
    return _current(spark, spec, root, line).unionByName(_closed(spark, spec, root, line))


def read_as_of(spark: SparkSession, spec: TableSpec, root: str, batch_id: int, moment: datetime | str) -> DataFrame:
    """The versions of a batch's history that are valid at a moment. Attempts that closed versions before it are not
    opened; what began after it is left out by the files' own least values."""
    line = chain(spark, root, batch_id)
    later = [c for c in line if as_datetime(c.file_date) > as_datetime(moment)]
    versions = _current(spark, spec, root, line).unionByName(_closed(spark, spec, root, later))
    return scd2.as_of(versions, moment)


def read_changes(spark: SparkSession, spec: TableSpec, root: str, batch_id: int) -> DataFrame:
    """The delta of a batch that ``advance_file`` wrote."""
    columns = [c.name for c in conform.delta_columns(spec)]
    rows = _rows(spark, spec, root, chain(spark, root, batch_id)[:1], "YN")
    return rows.where(F.col(OPERATION).isNotNull()).select(*columns)


def read_quarantine(spark: SparkSession, spec: TableSpec, root: str, batch_id: int) -> DataFrame | None:
    """The staged rows that a batch left out, as they were, with their reasons; None if it looked for none."""
    kept = chain(spark, root, batch_id)[0].quarantine
    return None if kept is None else spark.read.parquet(f"{root}/quarantine/{kept}").drop("part")


def forget_attempts(spark: SparkSession, root: str) -> list[str]:
    """Attempts in the folder that no batch's history needs: what failed, was refused, or was replaced."""
    log = _log(spark, root).read()
    used = {c.attempt for batch in {c.batch for c in log} for c in _chain(log, root, batch)}
    stored = spark.read.schema("batch bigint, attempt string, curr_ind string").parquet(f"{root}/history")
    return sorted(r.attempt for r in stored.select("attempt").distinct().collect() if r.attempt not in used)


def empty_history(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], _ddl(conform.history_columns(spec)))


def advance_file(
    stg: DataFrame, spec: TableSpec, root: str, batch_id: int, previous_batch: int | None, file_date: datetime | str,
    *, on_bad: str = "error", **options,
) -> DataFrame:
    """Delta and apply in one join and one write."""
    spark = stg.sparkSession
    log = _log(spark, root).read()
    line = _chain(log, root, previous_batch)
    usable, held, kept, repeated, seen, quarantine, options = _usable(stg, _before(spark, spec, root, line), spec, root, on_bad, options)
    after = scd2.advance(usable, held, spec, file_date, **options)
    after = after.withColumn(_CHANGED, F.col(OPERATION).isNotNull() | (F.col(CURRENT) == "N"))
    if kept is not None:
        after = after.unionByName(kept.withColumn(_CHANGED, F.lit(False)), allowMissingColumns=True)
    whole = _is_whole(line) or options["on_null_key"] == "ref"

    def check() -> None:
        _refuse_bad(seen, spec)
        _refuse_repeated(repeated, spec)

    return _publish(after, spec, root, batch_id, line, len(log), file_date, whole, quarantine, check)


def write_delta(
    stg: DataFrame, spec: TableSpec, root: str, batch_id: int, previous_batch: int | None, *, on_bad: str = "error", **options
) -> DataFrame:
    """Stores the delta of a snapshot against the previous batch, with the attempt that it was compared with. Running
    it again replaces it; a refused one replaces nothing."""
    spark = stg.sparkSession
    line = chain(spark, root, previous_batch)
    usable, held, _, repeated, seen, quarantine, options = _usable(stg, _before(spark, spec, root, line), spec, root, on_bad, options)
    draft, path = f"{root}/draft/{uuid.uuid4().hex}", f"{root}/delta/batch={batch_id}"
    cdc.delta(usable, held, spec, **options).write.parquet(draft)
    _refuse_bad(seen, spec)
    _refuse_repeated(repeated, spec)
    spark.read.parquet(draft).write.mode("overwrite").parquet(path)
    pin = {"previous": line[0].attempt if line else None, "quarantine": quarantine}
    spark.createDataFrame([(json.dumps(pin),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/delta_pins/batch={batch_id}")
    return spark.read.parquet(path)


def apply_delta(
    spark: SparkSession, spec: TableSpec, root: str, batch_id: int, previous_batch: int | None, file_date: datetime | str
) -> DataFrame:
    """Applies the stored delta in one write: newly closed and newly opened versions side by side."""
    delta = spark.read.parquet(f"{root}/delta/batch={batch_id}")
    pin = json.loads(spark.read.text(f"{root}/delta_pins/batch={batch_id}").first()[0])
    log = _log(spark, root).read()
    line = _chain_of(log, pin["previous"])
    if (line[0].batch if line else None) != previous_batch:
        raise ValueError(f"{root}: the delta of batch {batch_id} was not made against batch {previous_batch}")
    before = _before(spark, spec, root, line)
    whole = _is_whole(line) or not delta.where(any_null(spec.keys)).isEmpty()
    if not whole:
        ended = delta.where(F.col(OPERATION).isin(MODIFY, REMOVE)).select(*spec.keys).dropna()
        before = before.join(ended, spec.keys, "left_semi")
    stayed = scd2.close_current(before, delta, spec, file_date).withColumn(_CHANGED, F.col(CURRENT) == "N")
    after = stayed.unionByName(scd2.open_versions(delta, spec, file_date).withColumn(_CHANGED, F.lit(True)))
    return _publish(after, spec, root, batch_id, line, len(log), file_date, whole, pin["quarantine"], lambda: None)


def load_group(
    spark: SparkSession, specs: Iterable[TableSpec], group_id: int, staging: Mapping[str, DataFrame], root: str,
    batch_id: int, previous_batch: int | None, file_date: datetime | str, *, parallel: int = 4, one_pass: bool = True,
    **options,
) -> dict[str, DataFrame]:
    """Delta and apply for each file of a group, all at one file date. Files are independent jobs and
    overlap; a failure leaves the files that are done, as the folder of each is its own."""
    files = cdc.group_files(specs, group_id)

    def load(spec: TableSpec) -> DataFrame:
        folder, stg = f"{root}/{spec.table}", staging[spec.table]
        if one_pass:
            return advance_file(stg, spec, folder, batch_id, previous_batch, file_date, **options)
        write_delta(stg, spec, folder, batch_id, previous_batch, **options)
        return apply_delta(spark, spec, folder, batch_id, previous_batch, file_date)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip([s.table for s in files], pool.map(load, files), strict=True))


# --- commits ---


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/commits")


def _chain(log: list[Commit], root: str, batch_id: int | None) -> list[Commit]:
    if batch_id is None:
        return []
    attempts = {c.batch: c.attempt for c in log}
    if batch_id not in attempts:
        raise ValueError(f"{root}: batch {batch_id} is not committed")
    return _chain_of(log, attempts[batch_id])


def _chain_of(log: list[Commit], attempt: str | None) -> list[Commit]:
    known, out = {c.attempt: c for c in log}, []
    while attempt is not None:
        out.append(known[attempt])
        attempt = known[attempt].previous
    return out


def _is_whole(line: list[Commit]) -> bool:
    """Whether the next attempt should hold all current rows."""
    changes = list(takewhile(lambda c: not c.whole, line))
    if len(changes) == len(line):
        return True
    return len(changes) >= WHOLE_AFTER or sum(c.opened + c.closed for c in changes) >= WHOLE_SHARE * line[len(changes)].current


# --- what a load reads ---


def _usable(
    stg: DataFrame, before: DataFrame, spec: TableSpec, root: str, on_bad: str, options: dict
) -> tuple[DataFrame, DataFrame, DataFrame | None, bool, Observation | None, str | None, dict]:
    """The staged rows to load; the stored rows to compare, and those to carry on as they are; whether a staged key
    repeats; the count of bad rows or the name of the quarantine; the options of the comparison, which looks for hot
    keys only where one repeats.

    By default bad rows are counted in the pass that loads the others, and ``_refuse_bad`` ends the load. What was
    quarantined is not what was removed: stored rows of such a key are carried on; and if a quarantined row's key itself
    could not be read, any stored row may be meant, so absence removes none.
    """
    options = {"on_null_key": "error", **options}
    if on_bad not in ("error", "quarantine"):
        raise ValueError(f"on_bad must be error or quarantine, not {on_bad}")
    columns = conform.staging_columns(spec)
    marked, good = conform.with_reasons(stg, columns), F.size(conform.REASONS) == 0
    if on_bad == "error":
        seen = Observation()
        counted = marked.observe(seen, F.count_if(~good).alias("bad"), F.min(F.when(~good, F.col(conform.REASONS)[0])).alias("example"))
        repeated, options = _compared_once(marked.where(good), spec, options)
        return counted.where(good).drop(conform.REASONS), before, None, repeated, seen, None, options
    name = uuid.uuid4().hex
    path = f"{root}/quarantine/{name}"
    raw = stg.select("*", conform.with_reasons_column(stg, columns))
    raw.where(~good).write.parquet(f"{path}/part=refused")
    refused = conform.conform(stg.sparkSession.read.schema(raw.schema).parquet(f"{path}/part=refused"), columns).select(*spec.keys)
    if not refused.where(any_null(spec.keys)).isEmpty():
        options["snapshot_type"] = "DELTA"
    keys = _stored(refused.dropna().distinct(), f"{root}/draft/{uuid.uuid4().hex}")
    by_key = [conform.cast(stg, c).alias(f"_key_{c.name}") for c in columns if c.is_key]
    held_back = raw.where(good).select("*", *by_key).join(keys.toDF(*[f"_key_{k}" for k in spec.keys]), [f"_key_{k}" for k in spec.keys], "left_semi")
    held_back = held_back.select(*[stg[c] for c in stg.columns], F.array(F.lit(HELD_BACK)).alias(conform.REASONS))
    held_back.write.parquet(f"{path}/part=held")
    usable = marked.where(good).drop(conform.REASONS).join(keys, spec.keys, "left_anti")
    kept = before.join(keys, spec.keys, "left_semi").select(*before.columns)
    repeated, options = _compared_once(usable, spec, options)
    return usable, before.join(keys, spec.keys, "left_anti"), kept, repeated, None, name, options


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _compared_once(usable: DataFrame, spec: TableSpec, options: dict) -> tuple[bool, dict]:
    """Whether a key repeats, which refuses the load after its write; keys that do not are none that many rows share."""
    repeated = _repeats(usable, spec)
    return repeated, options if repeated or options.get("stored_hot_share") else {"hot_share": None, **options}


def _refuse_bad(seen: Observation | None, spec: TableSpec) -> None:
    if seen is not None and seen.get["bad"]:
        raise ValueError(f"{spec.table}: {seen.get['bad']} staged rows cannot be loaded, such as {seen.get['example']}")


def _repeats(usable: DataFrame, spec: TableSpec) -> bool:
    """Counted by key alone, with each task's counts combined first. The keys of the stored rows are unique, as nothing
    else was ever committed, so the current rows after the load have unique keys as well."""
    return not usable.select(*spec.keys).dropna().groupBy(*spec.keys).count().where("count > 1").isEmpty()


def _refuse_repeated(repeated: bool, spec: TableSpec) -> None:
    if repeated:
        raise ValueError(f"{spec.table}: a natural key is not unique")


# --- attempts ---


def _publish(
    after: DataFrame, spec: TableSpec, root: str, batch_id: int, line: list[Commit], seen: int, file_date: datetime | str, whole: bool,
    quarantine: str | None, check,
) -> DataFrame:
    """Writes an attempt, checks it, and commits it."""
    spark, attempt, counts = after.sparkSession, uuid.uuid4().hex, Observation()
    is_current, changed = F.col(CURRENT) == "Y", F.col(_CHANGED)
    counted = after.observe(
        counts, F.count_if(is_current).alias("current"), F.count_if(is_current & changed).alias("opened"), F.count_if(~is_current).alias("closed")
    )
    rows = counted if whole else counted.where(changed)
    rows.drop(_CHANGED).write.partitionBy(CURRENT).parquet(f"{root}/history/batch={batch_id}/attempt={attempt}")
    check()
    total, closed = counts.get["current"], counts.get["closed"]
    opened = total if whole else counts.get["opened"]
    if not whole:  # a change against the rows that were current before, where they were not all read
        total = line[0].current + opened - closed
    previous = line[0].attempt if line else None
    commit = Commit(batch_id, attempt, previous, as_datetime(file_date).isoformat(sep=" "), whole, opened, closed, total, quarantine)
    _log(spark, root).append(commit, seen)
    line = [commit, *line]
    return _current(spark, spec, root, line).unionByName(_closed(spark, spec, root, line))


def _rows(spark: SparkSession, spec: TableSpec, root: str, line: list[Commit], flags: str) -> DataFrame:
    """The rows of some attempts, from their own folders alone; operation and flags are NULL where a delta was stored
    apart."""
    columns = [*conform.delta_columns(spec), *conform.VERSION_COLUMNS]
    found = [(c, f) for c in line for f in flags if (c.opened if f == "Y" else c.closed)]
    if not found:
        return spark.createDataFrame([], _ddl(columns) + ", batch bigint, attempt string")
    paths = [f"{root}/history/batch={c.batch}/attempt={c.attempt}/{CURRENT}={f}" for c, f in found]
    reader = spark.read.schema(_ddl(columns) + ", batch bigint, attempt string").option("basePath", f"{root}/history")
    return reader.parquet(*paths).where(F.col("batch").isin([c.batch for c, _ in found]) & F.col(CURRENT).isin(list(flags)))


def _current(spark: SparkSession, spec: TableSpec, root: str, line: list[Commit]) -> DataFrame:
    """The rows that are current after a chain of attempts."""
    changes = list(takewhile(lambda c: not c.whole, line))
    names = _names(spec)
    whole = _rows(spark, spec, root, line[len(changes):][:1], "Y").select(*names)
    if not changes:
        return whole
    if len(changes) == 1:  # which opened each key once, and closed each whole row that is current no more
        ended, opened = (_rows(spark, spec, root, changes, flag) for flag in "NY")
        ended = ended.select(*spec.keys)
        if changes[0].closed > BROADCAST_ROWS:
            ended = ended.hint("merge")
        return whole.join(ended, spec.keys, "left_anti").select(*names).unionByName(opened.select(*names))
    order: list[Column] = [x for i, c in enumerate(reversed(changes)) for x in (F.lit(c.attempt), F.lit(i))]
    changed = _rows(spark, spec, root, changes, "YN").withColumn("_at", F.create_map(*order)[F.col("attempt")])
    last = F.max_by(F.struct(*names), F.struct("_at", F.col(CURRENT) == "Y")).alias("row")
    reopened = changed.groupBy(*[F.col(k).alias(f"_{k}") for k in spec.keys]).agg(last).select("row.*").where(F.col(CURRENT) == "Y")
    return whole.join(changed.select(*spec.keys).distinct(), spec.keys, "left_anti").select(*names).unionByName(reopened)


def _closed(spark: SparkSession, spec: TableSpec, root: str, line: list[Commit]) -> DataFrame:
    return _rows(spark, spec, root, line, "N").select(*_names(spec))


def _before(spark: SparkSession, spec: TableSpec, root: str, line: list[Commit]) -> DataFrame:
    return _current(spark, spec, root, line) if line else empty_history(spark, spec)


def _names(spec: TableSpec) -> list[str]:
    return [c.name for c in conform.history_columns(spec)]


def _ddl(columns: Iterable[ColumnSpec]) -> str:
    return ", ".join(f"`{c.name}` {c.spark_type}" for c in columns)
