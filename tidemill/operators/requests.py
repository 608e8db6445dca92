"""Signed request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import as_column
from tidemill.functions.keys import append_query, md5_hex


def translation_requests(
    df: DataFrame,
    url: str,
    app_id: str,
    security_key: str,
    query: str,
    source_lang: Column | str,
    target_lang: Column | str,
    salt: Column | str,
) -> DataFrame:
    """Add ``sign`` and ``request_url`` for each row; nothing is sent.  The
    key only enters the signature."""
    salt_text = as_column(salt).cast("string")
    sign = md5_hex(F.concat(F.lit(app_id), F.col(query), salt_text, F.lit(security_key)))
    signed = df.withColumn("sign", sign)
    parameters = {
        "q": F.col(query),
        "from": as_column(source_lang),
        "to": as_column(target_lang),
        "appid": F.lit(app_id),
        "salt": salt_text,
        "sign": F.col("sign"),
    }
    return signed.withColumn("request_url", append_query(F.lit(url), parameters))
