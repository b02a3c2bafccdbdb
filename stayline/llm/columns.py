"""Operators that hand rows through with all their columns, whatever these are called."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, functions as F

READ = ("doc_id", "text", "source")  # what the operators read


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def any_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator over documents meet no column names but those it reads and its own.

    All other columns go through it as ``extra 0``, ``extra 1``, ... and get their names back.
    Where the operator adds a column, one of the input with that name is left out.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        names = {c: c if c in READ else f"extra {i}" for i, c in enumerate(docs.columns)}
        out = operator(docs.select(*(_column(c).alias(n) for c, n in names.items())), *args, **kwargs)
        back = {n: c for c, n in names.items()}
        added = [c for c in out.columns if c not in back]
        return out.select(*(_column(n).alias(back.get(n, n)) for n in out.columns if back.get(n) not in added))

    return run
