"""Queries that work through a large input in rounds: the whole result, with one round's data on disk at a time."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from cardrail.plans import catalog
from cardrail.plans.payments import operations, parts
from cardrail.schemas import TOPIC_NORMALIZED
from cardrail.sources.topics import FolderTopic
from check_oracles import compare

CUSTOMERS, ORDERS = 7, 60


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Orders of a few customers, some of them twice."""
    folder = tmp_path_factory.mktemp("rounds")
    keys = [*range(ORDERS), 3, 3, 17]
    day = F.timestamp_seconds(F.col("n") * 86_400 * 3 + 800_000_000)
    orders = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n long, o_orderkey long")
    orders = orders.select(
        "o_orderkey",
        (F.col("n") % CUSTOMERS).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("n") * 1.5).alias("o_totalprice"),
        day.alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    customers = spark.range(CUSTOMERS).select(
        F.col("id").alias("c_custkey"),
        F.format_string("Customer %d", "id").alias("c_name"),
        F.lit(3).alias("c_nationkey"),
        F.lit(1.0).alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"),
    )
    for name, rows in (("orders", orders), ("customer", customers)):
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def duck(sf):
    con = duckdb.connect()
    for name in ("orders", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet/*.parquet')")
    return con


@pytest.fixture
def small_rounds(monkeypatch):
    monkeypatch.setattr(catalog, "MESSAGES_PER_ROUND", 40)
    monkeypatch.setattr(catalog, "ROWS_PER_ROUND", 40)
    monkeypatch.setattr(catalog, "MOST_ROUNDS", 4)
    monkeypatch.setattr(catalog, "REPORT_LIMIT", 10)


@pytest.fixture
def peaks(spark, monkeypatch):
    """The most messages that lay in each topic at a time, as seen after each batch."""
    seen, append = {}, FolderTopic.append

    def told(topic, messages, producer, batch_id=0):
        append(topic, messages, producer, batch_id)
        seen[topic.name] = max(seen.get(topic.name, 0), topic.read(spark).count())

    monkeypatch.setattr(FolderTopic, "append", told)
    return seen


def test_parts_hold_each_order_once(spark, sf):
    found = parts(spark, sf, 25, 12)
    assert found == [(0, 3), (1, 3), (2, 3)] and parts(spark, sf, 25, 2) == [(0, 2), (1, 2)]
    whole = operations(spark, sf)
    some = [operations(spark, sf, part=part) for part in found]
    assert all(0 < s.count() < whole.count() for s in some)
    union = some[0].unionByName(some[1]).unionByName(some[2])
    assert union.exceptAll(whole).count() == 0 and whole.exceptAll(union).count() == 0


@pytest.mark.parametrize("name", ["stage_counts", "publish_csv"])
def test_messages_expire_by_rounds(spark, sf, duck, small_rounds, peaks, name):
    assert compare(spark, duck, name, sf) == ""
    # parts of so few rows are uneven
    assert all(count < ORDERS for topic, count in peaks.items() if topic != TOPIC_NORMALIZED)


def test_storage_is_listed_by_rounds(spark, sf, duck, small_rounds, monkeypatch):
    listed, usage = [], catalog.monitoring.storage_usage
    monkeypatch.setattr(catalog.monitoring, "storage_usage", lambda s, root: listed.append(root) or usage(s, root))
    assert compare(spark, duck, "storage_usage", sf) == ""
    assert len(listed) == 2 and not any(Path(root.split(":", 1)[-1]).exists() for root in listed)
