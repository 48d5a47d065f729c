"""Column expressions that are built once per application.

Building a large expression is many calls to the JVM (tenths of a second); what a micro-batch builds again
for every batch it takes from here. Columns are not bound to a table, so any number of plans may share them.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark import SparkContext

_BUILT: dict = {}


def once(build: Callable) -> Callable:
    """``build``, whose columns depend on its (hashable) arguments alone, called once for them."""

    @functools.wraps(build)
    def built(*args):
        sc = SparkContext._active_spark_context
        key = (sc and sc.applicationId, build, args)
        if key not in _BUILT:
            _BUILT[key] = build(*args)
        return _BUILT[key]

    return built
