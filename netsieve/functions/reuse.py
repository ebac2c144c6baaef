"""Reuse of Column expressions.

Building an expression is a chain of small calls into the JVM. The larger expression sets of this
package depend on column names only, so each is built once per JVM and used again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext


def built_once(build: Callable) -> Callable:
    """Cache a builder of Columns by its (hashable) arguments, for the running JVM."""
    known: dict = {}

    @wraps(build)
    def reuse(*arguments):
        gateway = SparkContext._gateway
        if gateway is None or known.get("gateway") is not gateway:
            known.clear()
            known["gateway"] = gateway
        if arguments not in known:
            known[arguments] = build(*arguments)
        return known[arguments]

    return reuse
