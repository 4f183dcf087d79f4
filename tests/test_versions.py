"""Files of several schema versions read as one table."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from assayworks.sources.versions import IncompatibleSchemas, merged_read, merged_schema


def schema(ddl):
    return StructType.fromDDL(ddl)


def test_types_widen_as_far_as_values_are_kept():
    whole = merged_schema([schema("a int, b float, c decimal(5,2), d date, s struct<x:int>"),
                           schema("a bigint, b double, c decimal(8,4), d timestamp_ntz, e string, s struct<x:bigint,y:string>"),
                           schema("c int, a smallint")])
    assert whole.simpleString() == ("struct<a:bigint,b:double,c:decimal(14,4),d:timestamp_ntz,s:struct<x:bigint,y:string>,e:string>")


@pytest.mark.parametrize("a, b", [("bigint", "double"), ("string", "int"), ("timestamp", "date"), ("decimal(38,0)", "decimal(38,9)")])
def test_other_changes_need_a_full_refresh(a, b):
    with pytest.raises(IncompatibleSchemas, match="^c: "):
        merged_schema([schema(f"c {a}"), schema(f"c {b}")])


def test_one_scan_reads_all_versions(spark, folder):
    spark.createDataFrame([(1, 2, date(2024, 1, 2))], "id int, n int, d date").write.parquet(f"{folder}/1")
    spark.createDataFrame([(2, 3, "x")], "id int, n int, extra string").write.parquet(f"{folder}/2")
    spark.createDataFrame([("y", 4.5, 1 << 40, datetime(2024, 1, 2, 3), Decimal("1.50"))],
                          "extra string, n double, id bigint, d timestamp_ntz, p decimal(5,2)").write.parquet(f"{folder}/3")
    found = merged_read(spark, [f"{folder}/{k}" for k in (1, 2, 3)])
    assert sorted(map(tuple, found.collect())) == [
        (1, 2.0, datetime(2024, 1, 2), None, None), (2, 3.0, None, "x", None),
        (1 << 40, 4.5, datetime(2024, 1, 2, 3), "y", Decimal("1.50"))]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
