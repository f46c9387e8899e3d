"""Tables in Parquet that grow and change by rewriting: no keys, no locks, no packets."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def select(rows: DataFrame, columns: list[str], *, equal: dict | None = None, among: dict | None = None, between: dict | None = None, null: list[str] | None = None) -> DataFrame:
    """Columns of the rows that meet all conditions; conditions on null count too."""
    where: list[Column] = [F.col(c) == v for c, v in (equal or {}).items()]
    where += [F.col(c).isin(list(v)) for c, v in (among or {}).items()]
    where += [F.col(c).between(*v) for c, v in (between or {}).items()]
    where += [F.col(c).isNull() for c in null or []]
    for w in where:
        rows = rows.where(w)
    return rows.select(*columns)


def by_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among ``keys``, however many those are."""
    return rows.join(keys, on, "left_semi")


def _unmatched(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key ``other`` lacks; null is a value of its own in a key."""
    keys = other.select(*(F.col(c).alias(f"_key_{i}") for i, c in enumerate(on)))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(on)))
    return rows.join(keys, same, "left_anti")


def new_rows(stored: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """Rows to append: one for each key, which may have nulls, that is not stored yet."""
    return _unmatched(rows.dropDuplicates(on), stored, on)


def upserted(stored: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """The stored rows, those with a key of ``rows`` replaced, and the new ones, one for each key."""
    rows = rows.dropDuplicates(on)
    return _unmatched(stored, rows, on).unionByName(rows)


def updated(stored: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """The stored rows with columns of ``rows`` put over theirs where a key matches and the value is not null."""
    new = [c for c in rows.columns if c not in on]
    joined = stored.join(rows.select(*on, *(F.col(c).alias(f"_new_{c}") for c in new)), on, "left")
    return joined.select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in new else F.col(c) for c in stored.columns))


def removed(stored: DataFrame, condition: Column) -> DataFrame:
    """The stored rows for which the condition is not true."""
    return stored.where(~F.coalesce(condition, F.lit(False)))


def without_children(parents: DataFrame, children: DataFrame, on: list[str]) -> DataFrame:
    """Parents that no child refers to."""
    return parents.join(children, on, "left_anti")


def write(rows: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "append") -> None:
    """Append or replace; replacing what is read needs another path."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    """Tab-separated with a header, nulls as a dash."""
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "-").csv(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("nullValue", "-").csv(path)


def session(sessions: DataFrame, file: str, checksum: int) -> DataFrame:
    """Sessions of the same file name and content."""
    return sessions.where((F.col("file") == file) & (F.col("checksum") == checksum))


def refresh(state: DataFrame, seen: DataFrame, key: str = "id", modified: str = "modified_at") -> tuple[DataFrame, DataFrame]:
    """What is to be done again, and the state after it: (id, modified_at), the latest of each id.

    An id is due if it is new or was modified after what the state has; notices that repeat
    or come late are not. Notices without an id or time are left out.
    """
    newest = seen.where(F.col(key).isNotNull() & F.col(modified).isNotNull()).groupBy(key).agg(F.max(modified).alias(modified))
    known = state.select(key, F.col(modified).alias("_known"))
    due = newest.join(known, key, "left").where(F.col("_known").isNull() | (F.col(modified) > F.col("_known"))).select(key, modified)
    after = state.select(key, modified).unionByName(due).groupBy(key).agg(F.max(modified).alias(modified))
    return due, after
