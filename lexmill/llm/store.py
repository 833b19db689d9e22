"""Written tables and column names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.store import new_path, written

__all__ = ["fresh", "join_unique", "lost_matches", "new_path", "without", "written"]


def fresh(name: str, *taken: str) -> str:
    """name, made longer until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


#: A key is hot if it has one in so many of all rows; so many keys can be hot at most.
SHARES = 1000


def join_unique(rows: DataFrame, table: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """rows with the columns of table, which has one row for each of their keys; its column n counts the rows of a key, of ``total``.

    Keys with 1 / SHARES of all rows or more are met by broadcast (SHARES of them at most), the others by shuffle.
    """
    least = max(1, -(-total // SHARES))
    hot = F.broadcast(table.where(F.col(n) >= least))
    cool = rows.join(hot.select(key), key, "left_anti").join(table.where(F.col(n) < least), key)
    return rows.join(hot, key).unionByName(cool)


def without(docs: DataFrame, lost: DataFrame, id_col: str) -> DataFrame:
    """docs without the rows whose id is in lost's single column (nulls match); all columns stay, whatever their names."""
    name = fresh("lost_id", *docs.columns)
    return docs.join(lost.toDF(name), lost_matches(name, id_col), "left_anti")


def lost_matches(name: str, id_col: str) -> Column:
    return F.col(name).eqNullSafe(F.col(id_col))
