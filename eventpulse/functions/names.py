"""Parts of an ``owner/name`` repository name."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(name: str | Column, index: int) -> Column:
    # get() yields NULL past the end, where getItem() raises under ANSI mode
    return F.get(F.split(name, "/"), F.lit(index))


def repo_owner(name: str | Column) -> Column:
    return _part(name, 0)


def repo_short_name(name: str | Column) -> Column:
    return _part(name, 1)
