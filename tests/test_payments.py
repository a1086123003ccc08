from cardrail.plans.payments import ROWS_PER_TASK, operations

ORDERS = (
    "id o_orderkey",
    "id % 3 o_custkey",
    "CAST(1 AS DECIMAL(15,2)) o_totalprice",
    "DATE'1995-01-02' o_orderdate",
    "'LOW' o_orderpriority",
)


def test_whole_records_of_one_file_are_made_by_several_tasks(spark, tmp_path):
    rows = 2 * ROWS_PER_TASK + 1
    spark.range(rows).coalesce(1).selectExpr(*ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(k, f"c{k}", k, "BUILDING") for k in range(3)]
    names = "c_custkey long, c_name string, c_nationkey long, c_mktsegment string"
    spark.createDataFrame(customers, names).write.parquet(f"{tmp_path}/customer.parquet")
    made = operations(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == 3
    assert made.select("row_idx").distinct().count() == rows
    assert operations(spark, str(tmp_path), ("MESSAGE_TYPE",)).rdd.getNumPartitions() == 1
