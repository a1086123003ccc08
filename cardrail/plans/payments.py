"""Payment operations derived from the ``orders`` and ``customer`` tables.

One SQL expression per column, in the dialect part that Spark and DuckDB share; the same texts make
the Spark rows and the check query. Only the columns asked for are computed, and ``customer`` is
joined only when one of them needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardrail.schemas import RECORD_COLUMNS

_DAY = (
    "concat(lpad(CAST(day(o.o_orderdate) AS STRING),2,'0'),'/',"
    "lpad(CAST(month(o.o_orderdate) AS STRING),2,'0'),'/',CAST(year(o.o_orderdate) AS STRING){tail})"
)
_DATE_ONLY = _DAY.format(tail="")


def _day_at(time: str) -> str:
    return _DAY.format(tail=f",' {time}'")


_READ = {
    "MESSAGE_TYPE": (
        "CASE o.o_orderkey % 12 WHEN 0 THEN '1100' WHEN 1 THEN '1110' WHEN 2 THEN '1120'"
        " WHEN 3 THEN '1200' WHEN 4 THEN '1210' WHEN 5 THEN '1220' WHEN 6 THEN '1420'"
        " WHEN 7 THEN '1430' WHEN 8 THEN '1100' WHEN 9 THEN ' 1200 '"
        " WHEN 10 THEN (CASE WHEN o.o_orderkey % 5 = 0 THEN '9999' ELSE '1101' END)"
        " ELSE (CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 7 = 1 THEN ''"
        " ELSE '1201' END) END"
    ),
    "CARD_NUMBER": (
        "CASE o.o_orderkey % 13 WHEN 0 THEN '4539578763621486' WHEN 1 THEN '5321962100025057'"
        " WHEN 2 THEN '2223003122003222' WHEN 3 THEN '378282246310005'"
        " WHEN 4 THEN '6200000000000005' WHEN 5 THEN '6011111111111117'"
        " WHEN 6 THEN '6500000000000002' WHEN 7 THEN '3530111333300000'"
        " WHEN 8 THEN '2221000000000009' WHEN 9 THEN '4539 5787 6362 1486'"
        " WHEN 10 THEN '4539578763621487'"
        " WHEN 11 THEN (CASE WHEN o.o_orderkey % 3 = 0 THEN '4111' ELSE '4111111111111111' END)"
        " ELSE (CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE '5555555555554444' END) END"
    ),
    "TRANSACTION_AMOUNT": (
        "CASE WHEN o.o_orderkey % 101 = 0 THEN NULL WHEN o.o_orderkey % 103 = 0 THEN 'abc'"
        " ELSE CAST(o.o_totalprice AS STRING) END"
    ),
    "TRANSACTION_CURRENCY": (
        "CASE c.c_nationkey % 9 WHEN 0 THEN '840' WHEN 1 THEN '978' WHEN 2 THEN '504'"
        " WHEN 3 THEN '788' WHEN 4 THEN '392' WHEN 5 THEN '826' WHEN 6 THEN '756'"
        " WHEN 7 THEN '008' ELSE (CASE WHEN o.o_orderkey % 4 = 0 THEN '999' ELSE '784' END) END"
    ),
    "BILLING_CURRENCY": "CASE WHEN o.o_orderkey % 6 = 0 THEN NULL ELSE '978' END",
    "TRANSACTION_LOCAL_DATE": (
        f"CASE WHEN o.o_orderkey % 4 = 0 THEN {_day_at('09:49:28')}"
        f" WHEN o.o_orderkey % 4 = 1 THEN {_DATE_ONLY}"
        " WHEN o.o_orderkey % 4 = 2 THEN concat(CAST(CAST(o.o_orderdate AS DATE) AS STRING),"
        "'T12:00:00Z') ELSE 'not-a-date' END"
    ),
    "CARD_ACCEPTOR_ACTIVITY": (
        "CASE o.o_orderkey % 5 WHEN 0 THEN '5411' WHEN 1 THEN '5812' WHEN 2 THEN '6011'"
        " WHEN 3 THEN '0000' ELSE NULL END"
    ),
    "BILLING_AMOUNT": (
        "CASE WHEN o.o_orderkey % 6 = 1 THEN '' WHEN o.o_orderkey % 6 = 2 THEN NULL"
        " ELSE CAST(o.o_totalprice AS STRING) END"
    ),
    "ISS_SETTLEMENT_AMOUNT": "CASE WHEN o.o_orderkey % 3 = 0 THEN '12.50' ELSE NULL END",
    "ISS_SETTLEMENT_CURRENCY": (
        "CASE o.o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '826' ELSE NULL END"
    ),
    "CASH_BACK_AMOUNT": "CASE WHEN o.o_orderkey % 8 = 0 THEN '20' ELSE NULL END",
    "TRANSMISSION_DATE_AND_TIME": _day_at("10:00:01"),
    "BUSINESS_DATE": (
        "CASE o.o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ''"
        f" WHEN 2 THEN {_DATE_ONLY} ELSE 'bad' END"
    ),
    "CAPTURE_DATE": "concat(CAST(CAST(o.o_orderdate AS DATE) AS STRING),' 00:00:00')",
    "END_EXPIRY_DATE": "CASE WHEN o.o_orderkey % 2 = 0 THEN '01/12/2027' ELSE '31/02/2027' END",
    "PROCESSING_CODE": "'000000'",
    "ACTION_CODE": "CASE WHEN o.o_orderkey % 5 = 0 THEN '100' ELSE '000' END",
    "ORIGINAL_ACTION_CODE": "'00'",
    "CARD_SEQUENCE_NUMBER": "CASE WHEN o.o_orderkey % 2 = 0 THEN '001' ELSE NULL END",
    "CARD_ACCEPTOR_ID": "concat('MERCH',CAST(c.c_nationkey AS STRING))",
    "CARD_ACC_NAME_ADDRESS": (
        "CASE WHEN o.o_orderkey % 7 = 0 THEN '   ' WHEN o.o_orderkey % 7 = 1 THEN NULL"
        " ELSE concat('  ',c.c_name,' ') END"
    ),
    "CARD_ACCEPTOR_TERM_ID": "concat('TERM',lpad(CAST(o.o_orderkey % 1000 AS STRING),4,'0'))",
    "ACQUIRER_INSTITUTION_CODE": "concat('ACQ',CAST(c.c_nationkey % 5 AS STRING))",
    "ACQUIRER_BANK": "concat('BANK',CAST(c.c_nationkey AS STRING))",
    "ACQUIRING_COUNTRY_CODE": "CAST(c.c_nationkey AS STRING)",
    "ISSUING_BANK": "concat('ISS',CAST(c.c_nationkey % 7 AS STRING))",
    "NETWORK_CODE": "CASE WHEN o.o_orderkey % 2 = 0 THEN '01' ELSE '02' END",
    "INTERNAL_STAN": "lpad(CAST(o.o_orderkey % 1000000 AS STRING),6,'0')",
    "REFERENCE_NUMBER": "lpad(CAST(o.o_orderkey AS STRING),12,'0')",
    "AUTHORIZATION_CODE": (
        "CASE WHEN o.o_orderkey % 9 = 0 THEN NULL"
        " ELSE concat('A',lpad(CAST(o.o_orderkey % 100000 AS STRING),5,'0')) END"
    ),
    "AUTHORIZATION_SOURCE": "'1'",
    "ORIGINAL_AUTHORIZATION_CODE": "CAST(NULL AS STRING)",
}


def _unread(i: int, name: str) -> str:
    """A column that no stage reads: numbers, codes, texts and dates by turns, with nulls and empty texts."""
    kinds = (
        f"lpad(CAST((o.o_orderkey * {i + 7}) % 1000000 AS STRING),6,'0')",
        f"CASE WHEN o.o_orderkey % {i % 5 + 2} = 0 THEN NULL ELSE concat('V',CAST(o.o_custkey % {i + 11} AS STRING)) END",
        f"CASE WHEN o.o_orderkey % {i % 4 + 2} = 0 THEN '' ELSE c.c_mktsegment END",
        _DATE_ONLY,
        f"concat(o.o_orderpriority,' {name.lower()}')",
    )
    return kinds[i % len(kinds)]


EXPRESSIONS = {c: _READ.get(c) or _unread(i, c) for i, c in enumerate(RECORD_COLUMNS)}

INDEX = "row_idx"

#: An order has some 20 bytes and its record some 3,500 as text. Files of orders have few splits, so whole records are
#: dealt out anew, by so many rows a task.
ROWS_PER_TASK = 25_000


def operations(
    spark: SparkSession,
    sf_dir: str,
    columns: tuple[str, ...] | list[str] = RECORD_COLUMNS,
    part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """``row_idx`` and the given text columns, one row per order. ``part`` (k, n) takes the k-th of n parts of them;
    each order is in one part.

    Whole records are made by tasks of ``ROWS_PER_TASK`` rows, however the files are split. The orders' own columns move
    for that, before a record's columns are there.
    """
    expressions = {c: EXPRESSIONS[c] for c in columns}
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if part[1] > 1:
        orders = orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(part[1])) == part[0])
    rows = orders.alias("o")
    if any("c." in expression for expression in expressions.values()):
        customers = spark.read.parquet(f"{sf_dir}/customer.parquet").alias("c")
        # no hint: statistics decide between a broadcast and a shuffle with skew splitting
        rows = rows.join(customers, F.expr("o.o_custkey = c.c_custkey"))
    if len(expressions) == len(RECORD_COLUMNS):
        rows = rows.repartition(max(1, -(-orders.count() // ROWS_PER_TASK)))
    return rows.select(
        F.col("o.o_orderkey").alias(INDEX), *(F.expr(text).alias(c) for c, text in expressions.items())
    )


def parts(spark: SparkSession, sf_dir: str, rows_per_part: int, most: int) -> list[tuple[int, int]]:
    """Parts of the operations of about ``rows_per_part`` rows, one at least and ``most`` at most."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    n = min(most, max(1, -(-orders // rows_per_part)))
    return [(k, n) for k in range(n)]


def operations_sql() -> str:
    """The same rows as a SELECT."""
    columns = ",\n  ".join(f"{EXPRESSIONS[c]} AS {c}" for c in RECORD_COLUMNS)
    return (
        f"SELECT o.o_orderkey AS {INDEX},\n  {columns}\n"
        "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
    )
