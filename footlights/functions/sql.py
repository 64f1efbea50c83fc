"""The column builders as temporary SQL functions, for queries that are SQL text.

A function's body is its builder's own SQL, so both forms are one rule. Bodies are expressions that the optimiser sees
through: no Python runs, filters and column pruning work as with the builders.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# quoted text, which stays, or an operator's name before its arguments
_NAMES = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])(and|or|[-+*/%=<>!&|^~]+)(?=\()")


def sql_of(c: Column) -> str:
    """A column as SQL text; dates and times must come in as columns, not as literals. Needs a classic session."""
    return _NAMES.sub(lambda m: m[1] or f"`{m[2]}`", c._jc.node().sql())


def create_function(spark: SparkSession, name: str, arguments: str, returns: str, build: Callable[..., Column]) -> None:
    """``name`` as a temporary function. arguments: ``a string, b int``; ``build`` takes a column for each."""
    names = [a.split()[0] for a in arguments.split(",")]
    body = sql_of(build(*[F.col(n) for n in names]).cast(returns))
    spark.sql(f"create or replace temporary function {name}({arguments}) returns {returns} return {body}")


def create_functions(spark: SparkSession, functions: dict[str, tuple[str, str, Callable[..., Column]]]) -> None:
    """Several functions: name to (arguments, returned type, builder)."""
    for name, (arguments, returns, build) in functions.items():
        create_function(spark, name, arguments, returns, build)
