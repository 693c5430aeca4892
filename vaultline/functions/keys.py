"""Natural keys: null tests and the text that stands in for a row address."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a) == F.col(b) for a, b in zip(left, right, strict=True)])


def row_id(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns])
