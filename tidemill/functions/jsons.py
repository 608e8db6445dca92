"""JSON predicates and reply decoding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.columns import as_column


def in_array(c: Column | str) -> Column:
    """The text as the only element of a JSON array.  Spark's JSON functions
    stop after the first value and would accept trailing text; inside an array
    anything behind that value makes the document malformed."""
    return F.concat(F.lit("["), as_column(c), F.lit("]"))


def looks_like_object(c: Column | str) -> Column:
    """First and last visible characters are braces."""
    text = F.btrim(as_column(c), F.lit(" \t\r\n"))
    return F.coalesce(F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")), F.lit(False))


def is_json_object(c: Column | str) -> Column:
    """True for a single JSON object; false for arrays, scalars, malformed or
    empty text and NULL."""
    single = F.coalesce(F.json_array_length(in_array(c)) == 1, F.lit(False))
    return looks_like_object(c) & single


def json_strings(c: Column | str, names) -> Column:
    """Named top-level fields as an array of strings, missing ones dropped."""
    values = [F.get_json_object(as_column(c), f"$.{name}") for name in names]
    return F.array_compact(F.array(*values))


def reply_ok(reply: Column | str) -> Column:
    return F.coalesce(
        F.get_json_object(as_column(reply), "$.msg") == fv.REPLY_SUCCESS, F.lit(False)
    )


def industry_keys(reply: Column | str) -> Column:
    """The sorted keys of element 0 of ``data``, which is an object or a string
    holding one."""
    first = F.get_json_object(as_column(reply), "$.data[0]")
    return F.array_sort(F.array_distinct(F.json_object_keys(first)))


def reply_industries(reply: Column | str) -> Column:
    """Industry ids of a classifier reply; NULL unless it is successful."""
    return F.when(reply_ok(reply), industry_keys(reply))


def join_ids(ids: Column | str) -> Column:
    """Sorted comma string of an id set; NULL gives the empty string."""
    return F.coalesce(F.array_join(F.array_sort(as_column(ids)), ","), F.lit(""))


def in_whitelist(ids: Column | str, codes=fv.INDUSTRY_WHITELIST) -> Column:
    """True if any id equals one of the codes; empty and NULL sets are false."""
    wanted = F.array(*[F.lit(code) for code in codes])
    return F.coalesce(F.arrays_overlap(as_column(ids), wanted), F.lit(False))
