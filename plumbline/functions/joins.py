"""Equi-joins on named keys, some of which may be null on both sides."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def key_join(left: DataFrame, right: DataFrame, keys, how: str = "inner", null_safe=()) -> DataFrame:
    """Join on equal keys; those in ``null_safe`` also match null with null.

    Null-safe equality is still a hash or sort-merge key. The result has the left table's keys once.
    """
    other = {k: f"_right_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(o)) if k in null_safe else F.col(k) == F.col(o) for k, o in other.items()]
    joined = left.join(right.withColumnsRenamed(other), reduce(lambda a, b: a & b, same), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*other.values())
