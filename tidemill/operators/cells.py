"""Wide-column tables as long frames of cells.

A cell is ``(rowkey, family, qualifier, version, value)``; a missing cell is an
absent row.  The newest version wins, equal versions are settled by the larger
value so that results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.codec import DECODERS, ENCODERS
from tidemill.functions.keys import row_key
from tidemill.operators.decode import decode_timed_records
from tidemill.operators.documents import latest_by
from tidemill.operators.evaluate import sized

CELL_KEY = ("rowkey", "family", "qualifier")


def latest_cells(cells: DataFrame) -> DataFrame:
    """One row per cell.  A plain maximum combines map-side, so the copies of
    a hot cell collapse before the shuffle."""
    newest = F.max(F.struct("version", "value"))
    return (
        cells.groupBy(*CELL_KEY)
        .agg(newest.alias("_n"))
        .select(*CELL_KEY, F.col("_n.version"), F.col("_n.value"))
    )


def project_cells(
    cells: DataFrame,
    qualifiers: list[str],
    family: str = fv.CELL_FAMILY,
    empty_rows: bool = True,
) -> DataFrame:
    """Full scan to a flat frame ``rowkey, <qualifiers>``; a missing cell is
    NULL.

    As in a table scan, rows without any of the cells are kept; without
    ``empty_rows`` the choice of cells is a filter that reaches the scan.  One
    conditional maximum per qualifier needs a single shuffle on the row key,
    where a pivot would first group by key and qualifier.  Values of other
    cells are dropped before the sort that precedes the aggregation.
    """
    wanted = (F.col("family") == family) & F.col("qualifier").isin(*qualifiers)
    if empty_rows:
        narrow = cells.select(
            "rowkey", *[F.when(wanted, F.col(c)).alias(c) for c in ("qualifier", "version", "value")]
        )
    else:
        narrow = cells.filter(wanted).select("rowkey", "qualifier", "version", "value")
    numbered = narrow.select("rowkey", "qualifier", F.struct("version", "value").alias("_n"))
    newest = [F.expr(f"max(_n) FILTER (WHERE qualifier = {_quoted(q)})")["value"].alias(q) for q in qualifiers]
    return numbered.groupBy("rowkey").agg(*newest)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def get_rows(cells: DataFrame, keys: DataFrame, family: str | None = None) -> DataFrame:
    """Point get for a set of keys: ``rowkey, cells`` with the newest cells of
    each row as a ``qualifier -> value`` map, empty for unknown keys.

    Without ``family`` equal qualifiers of several families compete by version.
    The keys filter the cells before these are reduced: few are broadcast, and
    then nothing but their cells is shuffled; for many, both sides are joined by
    key, and a row with very many cells is a skewed join, which Spark splits.
    Versions then combine map-side.
    """
    keys, few = sized(keys.select("rowkey"))
    return rows_of(cells, keys, few, family)


def rows_of(cells: DataFrame, keys: DataFrame, few: bool, family: str | None = None) -> DataFrame:
    """``get_rows`` for written keys that have been measured."""
    wanted = keys.distinct()
    scope = cells if family is None else cells.filter(F.col("family") == family)
    scope = scope.join(F.broadcast(wanted) if few else wanted, "rowkey", "left_semi")
    newest = scope.groupBy("rowkey", "qualifier").agg(
        F.max(F.struct("version", "family", "value"))["value"].alias("value")
    )
    # at most one entry per qualifier is left, so a row's map is its own size
    maps = newest.groupBy("rowkey").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("qualifier", "value")))
        ).alias("cells")
    )
    empty = F.create_map().cast("map<string,string>")
    return wanted.join(maps, "rowkey", "left").select(
        "rowkey", F.coalesce("cells", empty).alias("cells")
    )


def _unpivot(df: DataFrame, columns: dict[str, Column], version, family: str) -> DataFrame:
    """``rowkey`` plus named value columns to cells, NULL values left out."""
    stamp = version if isinstance(version, Column) else F.lit(version)
    return (
        df.select("rowkey", stamp.cast("long").alias("version"), _as_rows(columns).alias("_c"))
        .select("rowkey", F.lit(family).alias("family"), "_c.qualifier", "version", "_c.value")
        .filter(F.col("value").isNotNull())
    )


def _as_rows(columns: dict[str, Column]) -> Column:
    """Named columns as rows ``qualifier, value``.  Spark's own unpivot gives its
    columns in a form that generated code with structs behind it cannot take as
    arguments: the stage then runs interpreted."""
    pairs = [F.struct(F.lit(name).alias("qualifier"), c.alias("value")) for name, c in columns.items()]
    return F.explode(F.array(*pairs) if pairs else F.array().cast("array<struct<qualifier:string,value:string>>"))


def to_cells(
    df: DataFrame, key: str = "rowkey", version=0, family: str = fv.CELL_FAMILY
) -> DataFrame:
    """Documents to cells: the key column names the row, every other non-NULL
    field becomes ``family:<field>`` as text."""
    columns = {c: F.col(c).cast("string") for c in df.columns if c != key}
    keyed = df if key == "rowkey" else df.withColumn("rowkey", F.col(key).cast("string"))
    return _unpivot(keyed, columns, version, family)


def encode_cells(
    df: DataFrame, types: dict[str, str], key: str = "rowkey", version=0,
    family: str = fv.CELL_FAMILY,
) -> DataFrame:
    """Typed columns to cells with binary values (``string``, ``int``, ``long``)."""
    columns = {name: ENCODERS[kind](name) for name, kind in types.items()}
    keyed = df if key == "rowkey" else df.withColumn("rowkey", F.col(key).cast("string"))
    return _unpivot(keyed, columns, version, family)


def decode_cells(
    cells: DataFrame, types: dict[str, str], family: str = fv.CELL_FAMILY
) -> DataFrame:
    """Inverse of :func:`encode_cells`: newest binary cells to typed columns.
    Bytes are decoded after the aggregation, once per result value."""
    wide = project_cells(cells, list(types), family)
    return wide.select("rowkey", *[DECODERS[k](n).alias(n) for n, k in types.items()])


def record_cells(
    messages: DataFrame,
    tables: dict[str, str],
    names: dict[str, str] | None = None,
    version=0,
    value: str = "value",
    order: Column | None = None,
) -> DataFrame:
    """Timed-record messages to cells of the table their topic maps to.

    The row key is the digest of the name, and fields are renamed.  Messages
    of topics without a table and undecodable ones give no cells.  If all get
    the same version, ``order`` picks the last message of each row.
    """
    names = names or fv.TIMED_RECORD_CELLS
    records = decode_timed_records(messages.filter(F.col("topic").isin(*tables)), value).good
    target = F.create_map(*[F.lit(x) for pair in tables.items() for x in pair])
    stamp = version if isinstance(version, Column) else F.lit(version)
    keyed = records.filter(F.col("name").isNotNull()).select(
        F.element_at(target, F.col("topic")).alias("table"),
        row_key("name").alias("rowkey"),
        stamp.cast("long").alias("version"),
        *[F.col(f).cast("string").alias(q) for f, q in names.items()],
        *([order.alias("_order")] if order is not None else []),
    )
    if order is not None:
        keyed = latest_by(keyed, ["table", "rowkey"], F.col("_order")).drop("_order")
    family = F.lit(fv.CELL_FAMILY).alias("family")
    return (
        keyed.select("table", "rowkey", "version", _as_rows({q: F.col(q) for q in names.values()}).alias("_c"))
        .select("table", "rowkey", family, "_c.qualifier", "version", "_c.value")
        .filter(F.col("value").isNotNull())
    )


def time_keyed_cells(
    df: DataFrame, types: dict[str, str], ingest_ms: Column, tie_break: Column | None = None
) -> DataFrame:
    """Records without a key to cells keyed by ingest time.  A tie break keeps
    records of the same millisecond apart; pass the source position where
    there is one, it is stable across retries."""
    tie = tie_break if tie_break is not None else F.monotonically_increasing_id()
    rowkey = F.concat_ws("-", ingest_ms.cast("long").cast("string"), tie.cast("string"))
    keyed = df.withColumn("rowkey", rowkey)
    return encode_cells(keyed, types, version=ingest_ms)
