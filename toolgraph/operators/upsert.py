"""What to do with records: create, update, leave; and merges of new into existing ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def actions(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, action) by full outer join: uploaded, updated, unchanged, or only_existing; nulls compare equal."""
    a, b = new.select(key, F.struct(*columns).alias("n")), old.select(key, F.struct(*columns).alias("o"))
    action = F.when(F.col("o").isNull(), "uploaded").when(F.col("n").isNull(), "only_existing").when(F.col("n").eqNullSafe(F.col("o")), "unchanged").otherwise("updated")
    return a.join(b, key, "full").select(key, action.alias("action"))


def upload_status(known: Column, equal: Column, valid: Column, sent: Column) -> Column:
    """The state of one record after an upload attempt."""
    return (
        F.when(known & equal, "unchanged").when(~valid, "failed_validation").when(known & sent, "updated").when(known, "failed_update").when(sent, "uploaded").otherwise("failed_upload")
    )


def preserve(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The new records with the given fields of the existing ones where those have them."""
    kept = old.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = new.join(kept, key, "left")
    return joined.select(*(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in new.columns))


def overwrite(existing: DataFrame, new: DataFrame, key: str, columns: list[str], nullable: tuple[str, ...] = ()) -> DataFrame:
    """Existing records with fields of the new ones; a null overwrites only in ``nullable`` fields."""
    fresh = new.select(key, F.lit(True).alias("_new"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = existing.join(fresh, key, "left")
    put = lambda c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) if c in nullable else F.coalesce(F.col(f"_{c}"), F.col(c))
    return joined.select(*(put(c).alias(c) if c in columns else F.col(c) for c in existing.columns))


def add_collection(collections: Column, name: str) -> Column:
    return F.array_sort(F.array_union(F.coalesce(collections, F.array().cast("array<string>")), F.array(F.lit(name))))
