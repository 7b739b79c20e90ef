"""The searched collection: rows of the scan, from fewer files."""

import pytest
from frames import values
from pyspark.sql import functions as F

from snapstats.operators import filters
from snapstats.sinks import search_index
from snapstats.sinks.tables import read_collection, write_collection
from snapstats.sinks.versions import read_version


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Forty files: names of their own, a text that few share, one very long value, nulls and nested values."""
    target = str(tmp_path_factory.mktemp("collections"))
    n = F.col("id")
    rows = spark.range(0, 4000, 1, 40).select(
        n, F.concat(F.lit("Part "), F.md5(F.floor(n / 100).cast("string"))).alias("name"),
        F.when(n == 1234, F.concat(F.repeat(F.lit("x"), 300_000), F.lit("Straße 𝒜𝒷𝒸 end"))).when(n % 7 != 0, F.lit("plain")).alias("note"),
        (n * 1.25).alias("price"), F.struct(F.concat(F.lit("in-"), n % 1000).alias("tag")).alias("more"),
        F.lit(None).cast("string").alias("file"))
    write_collection(rows, target, "parts", options={"maxRecordsPerFile": "100"})
    search_index.index_search(spark, target, "parts", nested=True)
    return target


@pytest.mark.parametrize("query", ["PART c4", "c4ca4238", "straße", "𝒜𝒷𝒸", "𝒷𝒸 e", "x en", "plain", "no such text", "1542.5", "42", "", None, "pla\nin", "null"])
def test_rows_of_the_scan(spark, stored, query):
    whole = read_collection(spark, stored, "parts")
    found = search_index.search_collection(spark, stored, "parts", query)
    assert found.columns == whole.columns
    assert values(found, "id") == values(filters.search(whole, query), "id")


@pytest.mark.parametrize("how", [{"nested": True}, {"nulls": True}, {"nested": True, "nulls": True}])
@pytest.mark.parametrize("query", ["in-777", "null", "null end"])
def test_nested_and_nulls(spark, stored, query, how):
    whole = read_collection(spark, stored, "parts")
    found = search_index.search_collection(spark, stored, "parts", query, **how)
    assert values(found, "id") == values(filters.search(whole, query, **how), "id")


def test_files_are_skipped(spark, stored):
    place = f"{stored}/parts"
    version = read_version(spark, place)

    def opened(query):
        return search_index.candidate_files(spark, place, version, query).count()

    assert opened("c4ca4238a0b923820dcc509a6f75849b") == 1  # the name of rows 100 to 199
    assert opened("straße") == 1 and opened("plain") == 40 and opened("no such text") == 0
    found = search_index.search_collection(spark, stored, "parts", "c4ca4238a0b923820dcc509a6f75849b")
    assert len(found.inputFiles()) == 1 and found.count() == 100


def test_without_a_sidecar(spark, tmp_path):
    target = str(tmp_path)
    rows = spark.createDataFrame([(1, "Alpha"), (2, None), (3, "")], "id int, name string")
    with pytest.raises(ValueError):
        search_index.index_search(spark, target, "new")
    write_collection(rows, target, "new")
    assert values(search_index.search_collection(spark, target, "new", "alp"), "id") == [(1,)]
    search_index.index_search(spark, target, "new")
    search_index.index_search(spark, target, "new")  # again: the earlier sidecar is replaced
    assert values(search_index.search_collection(spark, target, "new", "alp"), "id") == [(1,)]
    assert len(read_version(spark, f"{target}/new").kept) == 1
    write_collection(rows.withColumn("name", F.lit("beta")), target, "new")  # a new version has none
    assert values(search_index.search_collection(spark, target, "new", "alp"), "id") == []
    assert search_index.search_collection(spark, target, "new", "beta").count() == 3


def test_empty_collection(spark, tmp_path):
    rows = spark.createDataFrame([], "id int, name string")
    write_collection(rows, str(tmp_path), "none")
    search_index.index_search(spark, str(tmp_path), "none")
    assert search_index.search_collection(spark, str(tmp_path), "none", "abc").count() == 0
