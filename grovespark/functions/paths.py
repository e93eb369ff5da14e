"""Row-local algebra of root-to-node paths (arrays of ids)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def common_length(a: Column | str, b: Column | str) -> Column:
    """How many leading elements two paths share."""
    a, b = _col(a), _col(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, same: F.struct(F.when(s["on"] & same, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["on"] & same).alias("on")), lambda s: s["n"])


def common_prefix(a: Column | str, b: Column | str) -> Column:
    return F.slice(_col(a), F.lit(1), common_length(a, b))


def mrca(a: Column | str, b: Column | str) -> Column:
    """The deepest node on both paths; null if they have different roots."""
    return F.get(_col(a), common_length(a, b) - 1)


def descends_from(path: Column | str, ancestor: Column | str) -> Column:
    """Whether ``ancestor`` is on the path (a node descends from itself)."""
    return F.array_contains(_col(path), _col(ancestor))


def divergence(a: Column | str, b: Column | str) -> Column:
    """The two sibling ancestors below the mrca; null if one path holds the other or the roots differ."""
    a, b, n = _col(a), _col(b), common_length(a, b)
    return F.when((n > 0) & (n < F.size(a)) & (n < F.size(b)), F.struct(F.get(a, n).alias("left"), F.get(b, n).alias("right")))


def set_mrca_path(path: Column | str) -> Column:
    """Aggregate: the common prefix of many paths is that of the least and the greatest."""
    return common_prefix(F.min(_col(path)), F.max(_col(path)))


def last(path: Column | str) -> Column:
    return F.element_at(_col(path), -1)


def nearest_in(path: Column | str, wanted: Column) -> Column:
    """The deepest element of the path that is in the array ``wanted``."""
    return F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(_col(path), lambda x: F.array_contains(wanted, x))), -1)
