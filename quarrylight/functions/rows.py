"""Column functions in Python of single values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F


def by_row(schema: str) -> Callable:
    """Makes a column function of one that takes single values, such as the html of a page.

    They go to Python a hundred at a time, where an Arrow batch would hold ten thousand and all that is made of
    them. Each is read once: of a deterministic function Spark makes copies for the filters that it infers.
    """
    return lambda f: F.udf(f, schema, useArrow=False).asNondeterministic()
