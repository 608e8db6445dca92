"""Document-index tables: scans, upserts and partial updates.

A document frame has a ``_metadata`` map (``_index``, ``_id``, ``_score``) and
data columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.evaluate import sized

METADATA = {"meta_index": "_index", "meta_id": "_id", "meta_score": "_score"}


def scan_documents(documents: DataFrame, field: str | None = None) -> DataFrame:
    """Metadata as ``meta_*`` columns, plus one named field if given."""
    meta = [F.col("_metadata")[source].alias(name) for name, source in METADATA.items()]
    return documents.select(*meta, *([field] if field else []))


def scan_updates(documents: DataFrame, field: str = "update_time") -> DataFrame:
    """Metadata and update time, sorted by it (as text, NULLs first).  The id
    settles ties, so that one update time of very many documents can still be
    cut into several sort ranges."""
    return scan_documents(documents, field).orderBy(F.col(field).asc_nulls_first(), "meta_id")


def high_water_mark(documents: DataFrame, field: str = "update_time") -> DataFrame:
    """Largest update time as a one-row frame."""
    return documents.agg(F.max(field).alias("high_water_mark"))


def changed_since(documents: DataFrame, mark: DataFrame, field: str = "update_time") -> DataFrame:
    """Rows updated after the high-water mark (a one-row frame).  The mark is
    a scalar subquery: no join, and nothing passes through the driver program."""
    return documents.filter(F.col(field) > mark.select("high_water_mark").scalar())


def preview(df: DataFrame, order: list[str], rows: int = 200) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(rows)


def latest_by(df: DataFrame, key: list[str], order: Column) -> DataFrame:
    """One row per key, the one with the greatest ``order``.  ``max_by``
    combines map-side, so a key holding most of the rows shrinks to one row
    per task before the shuffle (a row_number window would sort them all in
    one task)."""
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), order)
    return df.groupBy(*key).agg(newest.alias("_n")).select(*key, *[F.col("_n")[c].alias(c) for c in rest])


def upsert(current: DataFrame, delta: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Replace or add whole documents by id; ``current`` has one row per id.

    A small delta is broadcast, and then the current table is scanned without
    a shuffle; otherwise both sides are shuffled on the id.
    """
    delta, few = sized(delta)
    fresh = latest_by(delta, key, order).select(*current.columns)
    replaced = fresh.select(*key)
    # fresh has no more rows than the delta
    if few:
        replaced = F.broadcast(replaced)
    return current.join(replaced, key, "left_anti").select(*current.columns).unionByName(fresh)


def stringify(df: DataFrame) -> DataFrame:
    """Append-only documents: every field as text and a generated id."""
    return df.select(F.uuid().alias("meta_id"), *[F.col(c).cast("string").alias(c) for c in df.columns])


def merge_supplied(current: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """Partial update: columns of the delta overwrite (NULL included), columns
    it does not have keep their value, unknown keys are added.  Both sides
    have one row per key.

    A full outer join shuffles both sides.  For a small delta it is replaced by
    an outer join that broadcasts the delta, plus the new keys: the current
    table is scanned twice (the second time only its key) and not shuffled.
    """
    delta, few = sized(delta)
    supplied = [c for c in delta.columns if c not in key]
    changes = delta.select(*key, F.struct(*supplied).alias("_d"))

    def merged(joined: DataFrame) -> DataFrame:
        columns = []
        for c in [*current.columns, *[c for c in supplied if c not in current.columns]]:
            if c not in supplied:
                columns.append(F.col(c))
            elif c not in current.columns:
                columns.append(F.col("_d")[c].alias(c))
            else:
                columns.append(F.when(F.col("_d").isNotNull(), F.col("_d")[c]).otherwise(F.col(c)).alias(c))
        return joined.select(*columns)

    if not few:
        return merged(current.join(changes, key, "full_outer"))
    updated = merged(current.join(F.broadcast(changes), key, "left"))
    known = current.select(*key).join(F.broadcast(delta.select(*key)), key, "left_semi")
    # as many known keys as the current table has rows for them: Spark measures
    added = delta.join(known, key, "left_anti")
    return updated.unionByName(added, allowMissingColumns=True)
