"""String operations chosen by configuration, applied as one column expression."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# The configuration keys.
OPERATION = "stringop.operation"
SOURCE = "stringop.source.column"
DEST = "stringop.dest.column"
PARAM = "stringop.param."

_INT_RANGE = range(-(2**31), 2**31)


class Params:
    """Typed access to the parameters of one operation."""

    def __init__(self, config: Mapping[str, object]):
        self._config = config

    def text(self, name: str, default: str = "") -> str:
        return str(self._config.get(PARAM + name, default))

    def whole(self, name: str) -> int:
        raw = self.text(name, "0")
        if not re.fullmatch(r"[+-]?\d+", raw) or int(raw) not in _INT_RANGE:
            raise ValueError(f"{PARAM}{name} is no whole number: {raw!r}")
        return int(raw)


def _right(c: Column, p: Params) -> Column:
    n = p.whole("length")
    return F.substring(c, F.greatest(F.length(c) - n + 1, F.lit(1)), F.lit(n))


def _replace_literal(c: Column, p: Params) -> Column:
    # The target is literal; the replacement keeps its group references.
    return F.regexp_replace(c, re.escape(p.text("target")), p.text("replacement"))


_UPPER = lambda c, p: F.upper(c)
_LOWER = lambda c, p: F.lower(c)

OPERATIONS: dict[str, Callable[[Column, Params], Column]] = {
    "trim": lambda c, p: F.trim(c),
    "ltrim": lambda c, p: F.ltrim(c),
    "rtrim": lambda c, p: F.rtrim(c),
    "left": lambda c, p: F.substring(c, 1, p.whole("length")),
    "right": _right,
    "substring": lambda c, p: F.substring(c, p.whole("start") + 1, p.whole("length")),
    "touppercase": _UPPER,
    "toupper": _UPPER,
    "upper": _UPPER,
    "tolowercase": _LOWER,
    "tolower": _LOWER,
    "lower": _LOWER,
    "replace": _replace_literal,
    "regexreplace": lambda c, p: F.regexp_replace(c, p.text("regex"), p.text("replacement")),
    "padleft": lambda c, p: F.lpad(c, p.whole("totalLength"), p.text("padChar", " ")),
    "padright": lambda c, p: F.rpad(c, p.whole("totalLength"), p.text("padChar", " ")),
}


def apply_string_op(df: DataFrame, config: Mapping[str, object]) -> DataFrame:
    """Add (or replace) the destination column.

    A configuration that cannot be used leaves the data as it is and is logged;
    a source column that does not exist is an error.
    """
    operation, source, dest = (str(config.get(k, "")) for k in (OPERATION, SOURCE, DEST))
    if not (operation and source and dest):
        log.error("string operation needs %s, %s and %s", OPERATION, SOURCE, DEST)
        return df
    column = df[source]
    build = OPERATIONS.get(operation.lower())
    if build is None:
        log.error("unknown string operation: %s", operation)
        return df
    try:
        result = build(column, Params(config))
    except ValueError as error:
        log.error("string operation not applied: %s", error)
        return df
    return df.withColumn(dest, result)


def string_op(config: Mapping[str, object]) -> Callable[[DataFrame], DataFrame]:
    """The same as a step for ``DataFrame.transform``."""
    return lambda df: apply_string_op(df, config)
