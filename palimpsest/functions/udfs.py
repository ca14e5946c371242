"""Arrow UDFs declared in modules that are imported before there is a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import functions as F


def arrow_udf(returns: str) -> Callable:
    """A pandas UDF of a return type in DDL, made when it is first used."""

    def declare(f: Callable) -> Callable:
        made: list = []

        @wraps(f)
        def apply(*cols):
            if not made:
                made.append(F.pandas_udf(f, returns))
            return made[0](*cols)

        return apply

    return declare
