"""Small Column helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Column expressions are trees: a sub-expression used five times is evaluated
    five times and copied five times into the plan; nesting such functions
    multiplies the copies. Binding the value to a lambda variable keeps the
    plan linear in size and evaluates it once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


_BUILT: dict = {}


def built_once(key: tuple, builder: Callable[[], object]):
    """Reuse Column expressions that are costly to build from Python.

    A Column built from many small functions takes thousands of calls into the
    JVM to construct. Columns that refer only to fixed internal column names can
    be built once per SparkContext and parameter set and reused by every plan.
    """
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    # application id + start time identify a context; a Python id() can be reused
    # by a new context after an old one is stopped
    ctx = (sc.applicationId, sc.startTime) if sc is not None else None
    full = (ctx, key)
    if full not in _BUILT:
        _BUILT[full] = builder()
    return _BUILT[full]
