"""Post cleaning on whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import text as T
from tidemill.operators.evaluate import filter_computed


def strip_posts(df: DataFrame, column: str = "post_content", profile: str = "full") -> DataFrame:
    """All cleaning steps before the length gate, on ``column`` in place.

    A step with a test runs only on texts it may change.  Such a step reads its
    input several times, so it is a projection of its own: the optimizer keeps
    it apart and computes the input once, still within one generated stage.
    """
    text = F.col(column)
    for step, may_change in T.STEPS[profile]:
        changed = step(text)
        if may_change is not None:
            changed = F.when(may_change(text), changed).otherwise(text)
        df = df.withColumn(column, changed)
    return df


def clean_posts(
    df: DataFrame,
    column: str = "post_content",
    profile: str = "full",
    keep_empty: bool = False,
) -> DataFrame:
    """Clean ``column`` in place and drop rows left empty (NULL included)."""
    source = df if keep_empty else df.filter(F.col(column).isNotNull())
    gated = strip_posts(source, column, profile).withColumn(column, T.length_gate(column))
    return gated if keep_empty else filter_computed(gated, F.col(column) != "")


def as_posts(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Project any frame to the six post fields, all strings.  ``mapping``
    gives a column or name per field; fields without one are NULL."""
    mapping = mapping if mapping is not None else {f: f for f in fv.POST_FIELDS}
    columns = []
    for field in fv.POST_FIELDS:
        source = mapping.get(field)
        if source is None:
            column = F.lit(None)
        else:
            column = F.col(source) if isinstance(source, str) else source
        columns.append(column.cast("string").alias(field))
    return df.select(*columns)


def as_results(df: DataFrame, *extra: str) -> DataFrame:
    """The eight result columns of an enriched post."""
    return df.select(*fv.POST_FIELDS, "sub_industry_id", "parent_id", *extra)
