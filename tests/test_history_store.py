"""Stored histories that cannot lie: pinned commits, small writes for small changes, reads that open what they need."""

import pytest
from pyspark.sql import functions as F

from vaultline.functions.clock import as_datetime
from vaultline.operators import cdc, scd2
from vaultline.plans import history_jobs
from vaultline.plans.commit_log import Commit, CommitConflict, CommitLog
from vaultline.specs import ColumnSpec, TableSpec

SPEC = TableSpec("accounts", (ColumnSpec("id", "int", is_key=True), ColumnSpec("v", "decimal(10,2)")), 1, 7)


def staged(spark, *pairs):
    return spark.createDataFrame([(i, str(v)) for i, v in pairs], "id int, v string")


def load(spark, root, batch, previous, day, *pairs, one_pass=True, **options):
    stg = staged(spark, *pairs)
    if one_pass:
        return history_jobs.advance_file(stg, SPEC, root, batch, previous, day, **options)
    history_jobs.write_delta(stg, SPEC, root, batch, previous, **options)
    return history_jobs.apply_delta(spark, SPEC, root, batch, previous, day)


def shown(df):
    picked = df.select("id", F.col("v").cast("int"), F.col("start_dt").cast("date").cast("string"), "curr_ind").collect()
    return sorted(tuple(r) for r in picked)


def size_of(root, commit):
    folder = f"{root}/history/batch={commit.batch}/attempt={commit.attempt}"
    return sum(p.stat().st_size for p in __import__("pathlib").Path(folder).rglob("*.parquet"))


@pytest.mark.parametrize("one_pass", [True, False])
def test_a_key_staged_twice_is_refused_though_one_row_is_unchanged(spark, tmp_path, one_pass):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (5, 5), (6, 6), one_pass=one_pass)
    for pairs in (((5, 5), (5, 9), (6, 6)), ((5, 5), (5, 5), (6, 6)), ((7, 1), (7, 2))):
        with pytest.raises(ValueError, match="not unique"):
            load(spark, root, 2, 1, "2024-01-02", *pairs, one_pass=one_pass)
    assert set(history_jobs.commits(spark, root)) == {1}


@pytest.mark.parametrize("one_pass", [True, False])
def test_a_key_with_a_bad_row_is_held_back_whole(spark, tmp_path, one_pass):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), one_pass=one_pass)
    after = load(spark, root, 2, 1, "2024-01-02", (1, 5), (1, "bad"), (3, 3), (4, "x"), one_pass=one_pass, on_bad="quarantine")
    assert shown(after) == [(1, 1, "2024-01-01", "Y"), (2, 2, "2024-01-01", "N"), (3, 3, "2024-01-02", "Y")]
    apart = history_jobs.read_quarantine(spark, SPEC, root, 2)
    assert sorted((r.id, r.v, r.load_reasons[0]) for r in apart.collect()) == [
        (1, "5", history_jobs.HELD_BACK), (1, "bad", "v: unreadable"), (4, "x", "v: unreadable")]
    assert history_jobs.read_quarantine(spark, SPEC, root, 1) is None


@pytest.mark.parametrize("one_pass", [True, False])
def test_a_rerun_does_not_change_what_was_built_on_the_first_attempt(spark, tmp_path, one_pass):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), one_pass=one_pass)
    load(spark, root, 2, 1, "2024-02-01", (1, 1), (2, 3), one_pass=one_pass)
    load(spark, root, 3, 2, "2024-03-01", (1, 4), (2, 3), one_pass=one_pass)
    before = shown(history_jobs.read_history(spark, SPEC, root, 3))
    again = load(spark, root, 2, 1, "2024-02-01", (1, 1), (2, 9), one_pass=one_pass)
    assert (2, 9, "2024-02-01", "Y") in shown(again)
    assert shown(history_jobs.read_history(spark, SPEC, root, 3)) == before
    assert history_jobs.forget_attempts(spark, root) == []
    # The batch after it, run again, builds on the new attempt; then the old ones are needed no more.
    redone = load(spark, root, 3, 2, "2024-03-01", (1, 4), (2, 9), one_pass=one_pass)
    assert shown(redone) == [(1, 1, "2024-01-01", "N"), (1, 4, "2024-03-01", "Y"), (2, 2, "2024-01-01", "N"), (2, 9, "2024-02-01", "Y")]
    assert len(history_jobs.forget_attempts(spark, root)) == 2


def test_a_delta_is_applied_to_what_it_was_made_against(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), one_pass=False)
    history_jobs.write_delta(staged(spark, (1, 2)), SPEC, root, 2, 1)
    load(spark, root, 1, None, "2024-01-01", (1, 2), one_pass=False)  # batch 1 again, with another value
    after = history_jobs.apply_delta(spark, SPEC, root, 2, 1, "2024-02-01")
    assert shown(after) == [(1, 1, "2024-01-01", "N"), (1, 2, "2024-02-01", "Y")]
    with pytest.raises(ValueError, match="not made against"):
        history_jobs.apply_delta(spark, SPEC, root, 2, None, "2024-02-01")


def test_commits_are_never_overwritten(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/commits")
    first, other = (Commit(b, f"a{b}", None, "2024-01-01 00:00:00", True, 1, 0, 1) for b in (1, 2))
    log.append(first, 0)
    with pytest.raises(CommitConflict):
        log.append(first, 0)
    assert not log._create(1, other)
    log.append(other, 0)  # another batch in between is no conflict
    assert log.read() == [first, other]
    assert sorted(p.name for p in (tmp_path / "commits").glob("[!.]*")) == ["000000000001.json", "000000000002.json"]


@pytest.mark.parametrize("one_pass", [True, False])
def test_a_small_change_is_a_small_write(spark, tmp_path, one_pass, monkeypatch):
    root, n = str(tmp_path), 200_000
    first = spark.range(n).select(F.col("id").cast("int"), (F.hash("id") % 1000000).cast("decimal(10,2)").alias("v"))
    second = first.where("id <> 77").withColumn("v", F.when(F.col("id") % 1000 == 5, F.col("v") + 1).otherwise(F.col("v")).cast("decimal(10,2)"))

    def run(batch, previous, day, stg):
        if one_pass:
            return history_jobs.advance_file(stg, SPEC, root, batch, previous, day)
        history_jobs.write_delta(stg, SPEC, root, batch, previous)
        return history_jobs.apply_delta(spark, SPEC, root, batch, previous, day)

    run(1, None, "2024-01-01", first)
    after = run(2, 1, "2024-02-01", second)
    known = history_jobs.commits(spark, root)
    assert known[1].whole and not known[2].whole and (known[2].opened, known[2].closed, known[2].current) == (200, 201, n - 1)
    assert size_of(root, known[2]) < 0.05 * size_of(root, known[1])
    # What is read is what a history applied in memory holds.
    whole = history_jobs.empty_history(spark, SPEC)
    for stg, day in ((first, "2024-01-01"), (second, "2024-02-01")):
        whole = scd2.close(whole, d := history_jobs.cdc.delta(stg, whole, SPEC), SPEC, day).unionByName(scd2.open_versions(d, SPEC, day))
    assert after.exceptAll(whole).isEmpty() and whole.exceptAll(after).isEmpty()
    assert history_jobs.read_current(spark, SPEC, root, 2).count() == n - 1
    # Enough changes make the next attempt a whole one.
    monkeypatch.setattr(history_jobs, "WHOLE_SHARE", 0.001)
    assert run(3, 2, "2024-03-01", first).count() == n + 201 + 200
    assert history_jobs.commits(spark, root)[3].whole


def test_changes_of_changes(spark, tmp_path, monkeypatch):
    """Keys that leave, come back and change again between two whole attempts."""
    monkeypatch.setattr(history_jobs, "WHOLE_SHARE", 100)
    monkeypatch.setattr(history_jobs, "WHOLE_AFTER", 4)
    root, other = str(tmp_path / "a"), str(tmp_path / "b")
    days = [((1, 1), (2, 2), (3, 3)), ((1, 1), (3, 4)), ((1, 2), (2, 2), (3, 4)), ((2, 5),), ((2, 5), (1, 1)), ((1, 1),), ((4, 4), (2, 1))]
    for i, pairs in enumerate(days, 1):
        monkeypatch.setattr(history_jobs, "WHOLE_AFTER", 4)
        got = load(spark, root, i, i - 1 or None, f"2024-01-{i:02d}", *pairs)
        monkeypatch.setattr(history_jobs, "WHOLE_AFTER", 0)
        assert shown(got) == shown(load(spark, other, i, i - 1 or None, f"2024-01-{i:02d}", *pairs))
    kinds = [history_jobs.commits(spark, r) for r in (root, other)]
    assert [kinds[0][i].whole for i in range(1, 8)] == [True, False, False, False, False, True, False]
    assert all(c.whole for c in kinds[1].values())


def test_as_of_opens_only_what_can_hold_the_moment(spark, tmp_path):
    root = str(tmp_path)
    for i, pairs in enumerate((((1, 1), (2, 2)), ((1, 2), (2, 2)), ((1, 3), (2, 2)), ((1, 4),)), 1):
        load(spark, root, i, i - 1 or None, f"2024-0{i}-01", *pairs)
    whole = history_jobs.read_history(spark, SPEC, root, 4)
    for moment, attempts in (("2024-01-15", 3), ("2024-02-01", 2), ("2024-03-31 23:59:59", 1), ("2024-04-01", 0), ("2023-01-01", 3)):
        found = history_jobs.read_as_of(spark, SPEC, root, 4, moment)
        assert shown(found) == shown(scd2.as_of(whole, moment))
        opened = {f.split("batch=")[1][0] for f in found.inputFiles() if "curr_ind=N" in f}
        later = {c.batch for c in history_jobs.chain(spark, root, 4) if c.closed and as_datetime(c.file_date) > as_datetime(moment)}
        current_side = {c.batch for c in history_jobs.chain(spark, root, 4) if not c.whole and c.closed}
        assert {int(b) for b in opened} <= later | current_side and len(later) == attempts


@pytest.mark.parametrize("one_pass", [True, False])
def test_hot_keys_are_sought_only_where_a_key_repeats(spark, tmp_path, monkeypatch, one_pass):
    sought, known_hot_keys = [], cdc.known_hot_keys
    monkeypatch.setattr(cdc, "known_hot_keys", lambda *args: sought.append(args) or known_hot_keys(*args))
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), one_pass=one_pass)
    load(spark, root, 2, 1, "2024-01-02", (1, 5), (1, "bad"), (3, 3), one_pass=one_pass, on_bad="quarantine")
    assert not sought
    with pytest.raises(ValueError, match="not unique"):
        load(spark, root, 3, 2, "2024-01-03", (1, 5), (3, 3), (3, 4), one_pass=one_pass)
    assert sought


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_one_change_is_read_without_grouping_its_versions(spark, tmp_path, plan, monkeypatch, most):
    monkeypatch.setattr(history_jobs, "BROADCAST_ROWS", most, raising=False)
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), (3, 3))
    after = load(spark, root, 2, 1, "2024-01-02", (1, 5), (3, 3), (4, 4))
    assert shown(after) == [(1, 1, "2024-01-01", "N"), (1, 5, "2024-01-02", "Y"), (2, 2, "2024-01-01", "N"), (3, 3, "2024-01-01", "Y"), (4, 4, "2024-01-02", "Y")]
    assert "max_by" not in plan(after) and ("SortMergeJoin" in plan(after)) == (most == 0)
    again = load(spark, root, 3, 2, "2024-01-03", (1, 5), (2, 2), (4, 6))
    assert shown(again) == sorted([
        (1, 1, "2024-01-01", "N"), (1, 5, "2024-01-02", "Y"), (2, 2, "2024-01-01", "N"), (2, 2, "2024-01-03", "Y"),
        (3, 3, "2024-01-01", "N"), (4, 4, "2024-01-02", "N"), (4, 6, "2024-01-03", "Y")])
