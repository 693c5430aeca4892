"""Shapes in well-known binary, compared as shapes: by what they cover and not by how they are written.

The canonical form has one byte order; a ring starts at its least vertex and turns one way; a line runs from its lesser
end; the holes of a polygon and the members of a collection are in order. Bytes that are no well-known binary stand for
themselves.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from vaultline.functions.shipping import ship_package

# Geometry types of well-known binary; a thousand is added for each of Z, M and both.
POINT, LINE, POLYGON, MULTI_POINT, MULTI_LINE, MULTI_POLYGON, COLLECTION = range(1, 8)


def canonical(data: bytes) -> bytes:
    try:
        out, end = _shape(data, 0)
    except (struct.error, KeyError, IndexError):
        return data
    return out if end == len(data) else data


def _shape(data: bytes, at: int) -> tuple[bytes, int]:
    order = {0: ">", 1: "<"}[data[at]]
    (kind,) = struct.unpack_from(f"{order}I", data, at + 1)
    width = {0: 2, 1: 3, 2: 3, 3: 4}[kind // 1000]
    at += 5

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(f"{order}I", data, at)
        at += 4
        return n

    def points(n: int) -> list[bytes]:
        nonlocal at
        values = struct.unpack_from(f"{order}{n * width}d", data, at)
        at += 8 * n * width
        return [struct.pack(f"<{width}d", *values[k: k + width]) for k in range(0, n * width, width)]

    def listed(parts: list[bytes]) -> bytes:
        return struct.pack("<I", len(parts)) + b"".join(parts)

    base = kind % 1000
    if base == POINT:
        body = points(1)[0]
    elif base == LINE:
        line = points(count())
        body = listed(min(line, line[::-1]))
    elif base == POLYGON:
        rings = [listed(_ring(points(count()))) for _ in range(count())]
        body = listed(rings[:1] + sorted(rings[1:]))
    elif MULTI_POINT <= base <= COLLECTION:
        parts = []
        for _ in range(count()):
            part, at = _shape(data, at)
            parts.append(part)
        body = listed(sorted(parts))
    else:
        raise KeyError(kind)
    return b"\1" + struct.pack("<I", kind) + body, at


def _ring(points: list[bytes]) -> list[bytes]:
    if len(points) < 2 or points[0] != points[-1]:
        return points
    open_ring = points[:-1]
    turned = []
    for way in (open_ring, open_ring[::-1]):
        least = min(way)
        turned += [way[k:] + way[:k] for k, p in enumerate(way) if p == least]
    ring = min(turned)
    return [*ring, ring[0]]


def _canonical(shapes: pd.Series) -> pd.Series:
    return shapes.map(canonical, na_action="ignore")


def same_shape(new: Column, old: Column) -> Column:
    """For ``cdc.delta(geom_equal=...)``. Equal bytes are equal shapes, so only what differs is looked into."""
    ship_package(SparkSession.active())
    form, differs = F.pandas_udf(_canonical, BinaryType()), ~new.eqNullSafe(old)
    return F.when(differs, form(F.when(differs, new)) == form(F.when(differs, old))).otherwise(new == old)
