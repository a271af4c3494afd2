"""Reuse built ``Column`` lists within one JVM.

Building a wide select list costs hundreds of Py4J calls; the unresolved
expressions do not depend on the input frame, so one list per JVM serves
every query of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from pyspark import SparkContext

T = TypeVar("T")


def per_jvm(build: Callable[[], T]) -> Callable[[], T]:
    held: dict[str, object] = {}

    @wraps(build)
    def get() -> T:
        sc = SparkContext._active_spark_context
        context = sc._jsc if sc is not None else None
        # the context itself is held, so a later one cannot pass for it
        if "value" not in held or held["context"] is not context:
            held["context"], held["value"] = context, build()
        return held["value"]  # type: ignore[return-value]
    return get
