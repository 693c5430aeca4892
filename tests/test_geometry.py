import struct

from vaultline.functions.geometry import canonical, same_shape
from vaultline.operators import cdc
from vaultline.specs import GEOMETRY, ColumnSpec, TableSpec


def wkb(kind, body, order="<"):
    return struct.pack(f"{order}BI", order == "<", kind) + body


def points(*xy, order="<", counted=True):
    body = b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in xy)
    return struct.pack(f"{order}I", len(xy)) + body if counted else body


def polygon(*rings, order="<"):
    return wkb(3, struct.pack(f"{order}I", len(rings)) + b"".join(points(*r, order=order) for r in rings), order)


SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
HOLE, OTHER = [(.1, .1), (.2, .1), (.2, .2), (.1, .1)], [(.5, .5), (.6, .5), (.6, .6), (.5, .5)]


def test_one_shape_has_one_form():
    turned = SQUARE[2:] + SQUARE[1:3]
    same = [polygon(SQUARE, HOLE, OTHER), polygon(turned, OTHER, HOLE), polygon(SQUARE[::-1], HOLE[::-1], OTHER), polygon(turned, HOLE, OTHER, order=">")]
    assert len({canonical(s) for s in same}) == 1
    assert canonical(polygon(HOLE, SQUARE)) != canonical(polygon(SQUARE, HOLE))  # the outer ring comes first
    line = [(0, 0), (1, 1), (2, 0)]
    assert canonical(wkb(2, points(*line))) == canonical(wkb(2, points(*line[::-1], order=">"), ">"))
    assert canonical(wkb(2, points(*line))) != canonical(wkb(2, points(line[1], line[0], line[2])))
    a, b = wkb(1, points((1, 2), counted=False)), wkb(1, points((3, 4), order=">", counted=False), ">")
    multi = [wkb(4, struct.pack("<I", 2) + x + y) for x, y in ((a, b), (b, a))]
    assert canonical(multi[0]) == canonical(multi[1]) != canonical(wkb(4, struct.pack("<I", 2) + a + a))
    assert canonical(wkb(1001, points((1, 2, 3), counted=False))) != canonical(wkb(1001, points((1, 2, 4), counted=False)))


def test_other_bytes_stand_for_themselves():
    for data in (b"", b"\1", b"POINT (1 2)", wkb(9, b""), wkb(2, b"\xff\xff\xff\x7f"), wkb(1, points((1, 2), counted=False)) + b"x"):
        assert canonical(data) == data


def test_change_capture_by_shape(spark, rows):
    spec = TableSpec("s", (ColumnSpec("id", "int", is_key=True), ColumnSpec("shape", GEOMETRY)))
    moved = [(0, 0), (1, 0), (1, 2), (0, 1), (0, 0)]
    new = spark.createDataFrame([(1, polygon(SQUARE)), (2, polygon(moved)), (3, None), (4, polygon(SQUARE[::-1]))], "id int, shape binary")
    old = spark.createDataFrame([(i, polygon(SQUARE), "Y") for i in (1, 2, 3, 4)], "id int, shape binary, curr_ind string")
    assert rows(cdc.delta(new, old, spec, geom_equal=same_shape), "id", "dlt_operation_nm") == [(2, "MODIFY")]
    assert rows(cdc.delta(new, old, spec), "id") == [(2,), (4,)]
