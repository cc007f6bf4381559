"""Lenient casts and key normalisation.

Spark 4 runs with ANSI mode on, where a malformed string cast raises.
The cleaning rules want malformed input to become null, so every cast
here is a ``try_cast``; the session setting is never touched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationwise.constants import NULL_TOKENS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """String or number -> double; malformed text and NaN -> null.

    ``nanvl`` mentions the parsed value once, which keeps the generated
    code small once the optimizer pushes filters through this expression.
    """
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def to_int(c: Column | str) -> Column:
    """String or number -> int through double, truncating toward zero.

    ``'1987'``, ``'1987.0'`` and ``'1987.9'`` all give 1987; a direct
    string-to-int cast would reject the last two.
    """
    return _col(c).try_cast("double").try_cast("int")


def normalize_code(c: Column | str) -> Column:
    """Neighbourhood code as text without leading zeros (``'007'`` -> ``'7'``).

    A lone ``'0'`` stays, and non-integer text such as ``'1.0'`` is kept
    as is (so it matches no dictionary key).
    """
    return F.regexp_replace(_col(c).cast("string"), r"^0+([0-9])", "$1")


def null_tokens(c: Column | str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Text that a delimited-file reader should treat as missing -> null."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)
