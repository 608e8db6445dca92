"""Row keys, digests and request parameters as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.columns import as_column


def md5_hex(c: Column | str) -> Column:
    """Lower-case hex MD5 of the UTF-8 text; NULL stays NULL."""
    return F.md5(as_column(c))


def row_key(c: Column | str) -> Column:
    """MD5 as an unsigned 128-bit number in base 32 (digits 0-9a-v, no leading
    zeros).  ``conv`` handles 64 bits, so the digest is converted in seven
    groups of five hex digits, each exactly four base-32 digits."""
    digest = F.lpad(F.md5(as_column(c)), 35, "0")
    groups = [
        F.lpad(F.lower(F.conv(F.substring(digest, start, 5), 16, 32)), 4, "0")
        for start in range(1, 36, 5)
    ]
    return F.ltrim(F.concat(*groups), F.lit("0"))


def form_encode(c: Column | str) -> Column:
    """Form-style percent encoding; NULL becomes the empty string."""
    return F.coalesce(F.url_encode(as_column(c)), F.lit(""))


def append_query(url: Column | str, parameters: dict[str, Column | str]) -> Column:
    """Append encoded ``name=value`` pairs in the given order.  NULL values are
    skipped; the separator stays even if every value is NULL."""
    base = as_column(url)
    # url_encode keeps NULL, so concat drops the pair and concat_ws skips it
    pairs = [
        F.concat(F.lit(f"{name}="), F.url_encode(as_column(value)))
        for name, value in parameters.items()
    ]
    start = F.when(F.contains(base, F.lit("?")), "&").otherwise("?")
    return F.concat(base, start, F.concat_ws("&", *pairs))
