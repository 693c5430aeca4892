"""MD5 hash keys and hash differences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for NULL, part separator, and the text length of the original conversion.
NULL_TEXT = "NA"
SEPARATOR = "|"
CONVERTED_LENGTH = 100


def md5_key(
    columns: Sequence[str],
    *,
    order: str = "name",
    max_len: int | None = None,
    charset: str = "UTF-8",
    binary: bool = False,
) -> Column:
    """MD5 over the texts of ``columns``: blanks at the end cut, NULL as ``NA``, ``|`` after each part.

    ``order="name"`` hashes in alphabetical column order, ``"position"`` in the order given.
    The whole text counts unless ``max_len`` (``CONVERTED_LENGTH`` for host-equal hashes) is given.
    ``charset="UTF-16LE"`` hashes the two-byte text of the original host. ``binary`` gives 16 bytes
    in place of 32 hex digits, which halves the shuffled key.
    """
    parts: list[Column] = []
    for name in ordered(columns, order):
        text = F.col(name).cast("string")
        if max_len is not None:
            text = F.left(text, F.lit(max_len))
        parts += [F.coalesce(F.rtrim(text), F.lit(NULL_TEXT)), F.lit(SEPARATOR)]
    text = F.concat(*parts)
    digest = F.md5(text if charset == "UTF-8" else F.encode(text, charset))
    return F.unhex(digest) if binary else digest


def ordered(columns: Sequence[str], order: str) -> list[str]:
    if order not in ("name", "position"):
        raise ValueError("order must be 'name' or 'position'")
    return sorted(columns, key=str.upper) if order == "name" else list(columns)


@dataclass(frozen=True)
class HashRule:
    """How a vault hashes; all its loads must share one rule. ``order="position"`` keeps hub and link
    hashes equal for composite keys whose columns sort differently in hub and link sources."""

    order: str = "name"
    max_len: int | None = None
    charset: str = "UTF-8"
    binary: bool = False

    def key(self, columns: Sequence[str], sort_names: dict[str, str] | None = None) -> Column:
        """The hash of ``columns``; where they were renamed, ``sort_names`` gives the names to sort by."""
        if sort_names and self.order == "name":
            columns = sorted(columns, key=lambda c: sort_names[c].upper())
        else:
            columns = ordered(columns, self.order)
        return md5_key(columns, order="position", max_len=self.max_len, charset=self.charset, binary=self.binary)
