"""Joins of rows with few facts about their keys, whatever a key's share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPIES = 1000
HOT = 10_000


def join_facts(rows: DataFrame, facts: DataFrame, key: str, copies: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (one row a key, its number of rows
    in the column ``copies``, which goes).

    Keys of more than max(COPIES, total / HOT) of the ``total`` rows, at most
    HOT of them, are broadcast; all others are joined by a shuffle in which no
    key has more rows than that.
    """
    least = max(COPIES, total // HOT)
    hot = F.broadcast(facts.filter(F.col(copies) > least).drop(copies))
    rare = facts.filter(F.col(copies) <= least).drop(copies)
    return rows.join(hot, key).union(rows.join(hot.select(key), key, "left_anti").join(rare, key))
