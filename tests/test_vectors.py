import pytest
from pyspark.sql import functions as F

from demandgrid.functions.vectors import format_vector, parse_vector, vector_length
from demandgrid.operators.hourly import expand_hours, unnest_hours, with_hour_timestamp

CELLS = [("[0 1]", [0.0, 1.0]), ("[0, 1]", [0.0, 1.0]), ("[0  1]", [0.0, 1.0]), ("[]", []), ("", []), (None, None),
         ("[0\n 1]", [0.0, 1.0]), ("1.0", [1.0]), ("[x 2]", [None, 2.0]), ("[1.5e1 -2]", [15.0, -2.0])]


@pytest.mark.parametrize("text,values", CELLS)
def test_parse(spark, text, values):
    df = spark.createDataFrame([(text,)], "v string")
    row = df.select(parse_vector("v").alias("a"), vector_length("v").alias("n")).first()
    assert row.a == values
    assert row.n == (None if values is None else len(values))


def test_int_variant_reads_decimals(spark):
    assert spark.createDataFrame([("[1.0, 0]",)], "v string").select(parse_vector("v", "int")).first()[0] == [1, 0]


def test_unnest_is_one_based_and_drops_rows_without_vector(spark):
    df = spark.createDataFrame([(1, "[5 6]"), (2, ""), (3, None)], "id int, v string")
    assert [tuple(r) for r in unnest_hours(df, "v").select("id", "val", "hour_index").collect()] == [(1, 5.0, 1), (1, 6.0, 2)]


def test_expand_keeps_rows_without_vector(spark):
    df = spark.createDataFrame([(1, "[5 6]", "[0 1]"), (2, "", "")], "id int, hours_sale string, hours_stock_status string")
    got = sorted(map(tuple, expand_hours(df).collect()), key=str)
    assert got == [(1, 5.0, 0, 0), (1, 6.0, 1, 1), (2, None, None, 0)]


def test_explode_and_collect_is_identity(sales):
    hourly = expand_hours(sales)
    assert hourly.count() == 24 * sales.count()
    packed = (hourly.groupBy("store_id", "product_id", "dt")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("hour", "sale_amount_hour"))),
                               lambda p: p["sale_amount_hour"].cast("int")).alias("v"))
              .select("store_id", "product_id", "dt", format_vector("v").alias("v")))
    same = sales.join(packed, ["store_id", "product_id", "dt"]).filter(F.col("v") == F.col("hours_sale")).count()
    assert same == sales.count()


def test_hour_becomes_part_of_the_time(sales):
    hours = with_hour_timestamp(expand_hours(sales)).select(F.hour("dt").alias("h"), "hour").distinct().collect()
    assert len(hours) == 24 and all(r.h == r.hour for r in hours)
