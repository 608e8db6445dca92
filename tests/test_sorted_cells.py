"""The cell layout sorted by row key: what is read, and what comes out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.test_tables import random_cells, rows
from tidemill.operators import cells as C
from tidemill.operators import evaluate
from tidemill.session import shared_dir
from tidemill.sources.sorted_cells import SCHEMA, SortedCells

FILES = 64


@pytest.fixture(scope="module")
def many(spark):
    """20,000 rows of two cells, one row of 10,000 cells in several files."""
    numbers = spark.range(20_000).select(F.format_string("k%06d", "id").alias("rowkey"), F.col("id").cast("string").alias("n"), F.lit("x").alias("x"))
    hot = spark.range(10_000).select(
        F.lit("k010000").alias("rowkey"), F.lit("info").alias("family"), F.format_string("q%05d", "id").alias("qualifier"),
        F.lit(0).cast("long").alias("version"), F.lit("h").alias("value"),
    )
    cells = C.to_cells(numbers).unionByName(hot)
    kept = SortedCells(shared_dir(spark, "many"))
    kept.write(cells.unionByName(cells), FILES)
    return cells, kept


def keyed(spark, names):
    return spark.createDataFrame([(n,) for n in names], "rowkey string")


def test_files_are_ranges_and_hold_each_cell_once(spark, many):
    cells, kept = many
    assert rows(kept.read(spark)) == rows(cells)
    bounds = kept.bounds(spark).orderBy("first", "last").collect()
    assert FILES / 2 < len(bounds) <= FILES and sum(b.cells for b in bounds) == cells.count()
    assert all(a.last <= b.first for a, b in zip(bounds, bounds[1:]))
    # the hot row is a fifth of all cells: it spreads over several files, none of which is large
    assert sum(b.first == b.last == "k010000" for b in bounds) >= 5
    assert max(b.cells for b in bounds) < 3 * cells.count() / FILES


def test_a_get_of_a_hundred_keys_reads_few_files(spark, many):
    _, kept = many
    near = kept.near(keyed(spark, [f"k{n:06d}" for n in range(4000, 4100)]))
    assert len(near.inputFiles()) < 0.05 * len(kept.read(spark).inputFiles())
    apart = kept.near(keyed(spark, [f"k{n:06d}" for n in (3, 15_000, 999_999)]))
    assert len(apart.inputFiles()) <= 4


def test_the_key_filter_reaches_the_reader(spark, many, capsys):
    _, kept = many
    kept.near(keyed(spark, ["k000003", "k015000"])).explain("formatted")
    assert re.search(r"PushedFilters: \[In\(rowkey, \[k000003,k015000\]\)", capsys.readouterr().out)
    kept.near(keyed(spark, [f"k{n:06d}" for n in range(50)])).explain("formatted")
    assert "GreaterThanOrEqual(rowkey,k000000), LessThanOrEqual(rowkey,k000049)" in capsys.readouterr().out
    kept.scan(spark, "k000010", "k000020").explain("formatted")
    assert "GreaterThanOrEqual(rowkey,k000010), LessThan(rowkey,k000020)" in capsys.readouterr().out


def test_files_carry_a_bloom_filter_for_the_row_key_alone(spark):
    """Where keys are distinct; repeated ones get a dictionary instead, which the reader asks in the same way."""
    kept = SortedCells(shared_dir(spark, "bloom"))
    kept.write(C.to_cells(spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("rowkey"), F.lit("x").alias("x"))), 2)
    name = kept.read(spark).inputFiles()[0]
    hadoop, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), hadoop)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    offsets = {columns.get(k).getPath().toDotString(): columns.get(k).getBloomFilterOffset() for k in range(columns.size())}
    reader.close()
    assert offsets["rowkey"] > 0 and all(offsets[c] <= 0 for c in offsets if c != "rowkey")


@pytest.mark.parametrize("bound", [100_000, 1])
@pytest.mark.parametrize("family", [None, "info"])
def test_gets_equal_those_of_the_unsorted_cells(spark, monkeypatch, family, bound):
    monkeypatch.setattr(evaluate, "MAX_BROADCAST_ROWS", bound)
    _, frame = random_cells(spark)
    kept = SortedCells(shared_dir(spark, "random"))
    kept.write(frame, 7)
    keys = keyed(spark, ["hot", "r1", "unknown", "r1", None, ""])
    wanted = {r.rowkey: r.cells for r in C.get_rows(frame, keys, family).collect()}
    assert {r.rowkey: r.cells for r in kept.get(keys, family).collect()} == wanted
    assert wanted[None] == wanted[""] == wanted["unknown"] == {}


def test_scans_keep_the_order_of_bytes(spark):
    r = random.Random(4)
    names = sorted({"".join(r.choice("aZé～\U0001f600") for _ in range(r.randrange(4))) for _ in range(200)}, key=str.encode)
    cells = C.to_cells(keyed(spark, names).withColumn("a", F.lit("v")))
    kept = SortedCells(shared_dir(spark, "bytes"))
    kept.write(cells, 9)
    for first, stop in [(None, None), (names[10], None), (None, names[10]), (names[5], names[50]), (names[9], names[9]), ("\U0001f601", None)]:
        inside = [n for n in names if (first is None or n >= first) and (stop is None or n < stop)]
        assert sorted((x.rowkey for x in kept.scan(spark, first, stop).collect()), key=str.encode) == inside
    chosen = r.sample(names, 40) + ["b", "｟"]
    assert {x.rowkey for x in kept.near(keyed(spark, chosen)).collect()} >= set(chosen[:40])


def test_empty_tables_null_keys_and_second_writes(spark):
    none = spark.createDataFrame([], SCHEMA)
    kept = SortedCells(shared_dir(spark, "none"))
    kept.write(none, 4)
    assert kept.read(spark).count() == kept.scan(spark, "a", "b").count() == 0
    assert [tuple(r) for r in kept.get(keyed(spark, ["a"])).collect()] == [("a", {})]
    assert kept.get(keyed(spark, [])).count() == 0
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        kept.write(none, 4)
    bad = spark.createDataFrame([(None, "info", "a", 1, "v")], SCHEMA)
    with pytest.raises(Exception, match="no row key"):
        SortedCells(shared_dir(spark, "bad")).write(bad, 2)
    # extra columns are left out, a null value stays a cell
    odd = spark.createDataFrame([("r", "info", "a", 1, None, "z")], f"{SCHEMA}, file string")
    kept = SortedCells(shared_dir(spark, "odd"))
    kept.write(odd, 2)
    assert [tuple(x) for x in kept.read(spark).collect()] == [("r", "info", "a", 1, None)]
