"""Every registered query agrees with its SQL on the smallest data, and reads the given tables."""

import inspect
import re

import pytest
from oracle import compare, connect

import __spark_entry__
from registry import all_oracles, all_queries
from registry.base import INPUTS, TABLES

SF = "/root/testdata/sf0.001"
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(all_queries()))
def test_agrees_with_sql(spark, con, name):
    problems, _ = compare(spark, con, SF, name, all_queries()[name], ORACLES.get(name))
    assert not problems


def test_every_query_has_sql():
    assert set(ORACLES) == set(all_queries())


def test_every_query_reads_given_tables():
    for name, sql in ORACLES.items():
        assert any(re.search(rf"\b{t}\b", sql) for t in TABLES), name


def test_inputs_take_no_subset_by_number():
    for text in INPUTS.values():
        assert not re.search(r"%\s*\d|\bmod\b|\blimit\b|\bsample\b", text)


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["dlt_operation_nm", "row_count"] and result.count() == 3
    assert inspect.signature(__spark_entry__.queries).parameters == {}
