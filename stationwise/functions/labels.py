"""Label expressions: distance buckets and code -> name lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationwise.constants import FAR_BUCKET, NEIGHBOURHOOD_NAMES, PROXIMITY_BUCKETS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def proximity_bucket(
    distance: Column | str,
    buckets: Sequence[tuple[float, str]] = PROXIMITY_BUCKETS,
    far_label: str = FAR_BUCKET,
) -> Column:
    """First bucket whose (inclusive) upper bound holds the distance.

    A null distance falls through every test and lands in ``far_label``.
    """
    d = _col(distance)
    expr = None
    for bound, label in buckets:
        expr = (F.when if expr is None else expr.when)(d <= F.lit(bound), label)
    return F.lit(far_label) if expr is None else expr.otherwise(far_label)


def name_lookup(code: Column | str, names: Mapping[str, str] = NEIGHBOURHOOD_NAMES) -> Column:
    """Name of a code from a constant table; an unknown or null code gives null.

    The table is two constant arrays, folded by the optimizer: no join, no shuffle.
    """
    codes = F.array(*(F.lit(str(k)) for k in names))
    found = F.array_position(codes, _col(code).cast("string"))
    return F.get(F.array(*(F.lit(v) for v in names.values())), (found - 1).cast("int"))
