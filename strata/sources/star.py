"""The star-schema test tables rendered as the raw e-commerce tables.

Each raw table is a projection of a given table (plus one dimension join
for city names), so its size grows with the input and it is produced in a
single pass. Values are rendered as the raw files carry them: prefixed,
zero-padded IDs, text money with two decimals, ISO dates.

What the conformed layer has to clean is derived from the row values, and
no row is left out: upper-case, padded and unknown statuses, missing
states, names, e-mails, customers and comments, dates, money and numbers
that do not parse or are negative, references to nothing, rows that come
twice with other values, and ids that differ as text but not once stripped
(so keys are not unique after conforming).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.columns import padded_id
from strata.operators.tables import with_audit
from strata.sources.files import read_driver_table

# Fixed audit instant, so a rerun lands identical rows.
LANDED_AT = "2025-01-01 12:00:00"


def _id(prefix: str, col: str, width: int):
    return padded_id(prefix, col, width)


def _money_text(c: str):
    return F.col(c).cast("decimal(12,2)").cast("string")


def _when(key: str, modulus: int, rest: int):
    """Rows picked by their key."""
    return F.col(key) % modulus == rest


def _with_variants(df: DataFrame, *picked):
    """Each row once as ``v`` 0, and once more as v 1, 2, ... where that variant's condition holds."""
    extra = [F.when(cond, F.lit(i)) for i, cond in enumerate(picked, 1)]
    return df.withColumn("v", F.explode(F.array_compact(F.array(F.lit(0), *extra))))


def _plain_id(prefix: str, c):
    """The id without padding: another text, the same id once stripped."""
    return F.concat(F.lit(prefix), c.cast("string"))


def _day_text(c):
    return c.cast("date").cast("string")


def raw_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # nation is a dimension; Spark broadcasts it only if its measured size is
    # under the broadcast threshold, otherwise a shuffle join runs.
    j = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    return j.select(
        _id("C", "c_custkey", 5).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(~_when("c_custkey", 31, 4), F.concat(_id("cliente", "c_custkey", 5), F.lit("@example.com"))).alias("email"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("state"),
        F.col("n_name").alias("city"),
        F.when(_when("c_custkey", 37, 5), "31.12.1999")
        .otherwise(_day_text(F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") % 2557).cast("int"))))
        .alias("signup_date"),
    )


def _status():
    base = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "processing")
        .when(F.col("o_orderstatus") == "P", "shipped")
    )
    digit = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(digit == "1", F.upper(base))
        .when(digit == "2", F.concat(F.lit(" "), base, F.lit(" ")))
        .otherwise(base)
    )


def _customer():
    return F.when(~_when("o_orderkey", 53, 7), _id("C", "o_custkey", 5))


def _signed_money(price: str, key: str, bad: tuple[int, int], bad_text: str, negative: tuple[int, int]):
    text = _money_text(price)
    return F.when(_when(key, *bad), bad_text).when(_when(key, *negative), F.concat(F.lit("-"), text)).otherwise(text)


def raw_orders(orders: DataFrame) -> DataFrame:
    again = _when("o_orderkey", 97, 5)        # the same id, another status
    unpadded = _when("o_orderkey", 101, 2)    # the same id once stripped
    return _with_variants(orders, again, unpadded).select(
        F.when(F.col("v") == 2, _plain_id("O", F.col("o_orderkey"))).otherwise(_id("O", "o_orderkey", 6)).alias("order_id"),
        _customer().alias("customer_id"),
        F.when(_when("o_orderkey", 89, 3), "2025-13-45").otherwise(_day_text(F.col("o_orderdate"))).alias("order_date"),
        F.when(F.col("v") == 1, "cancelled").when(_when("o_orderkey", 103, 8), "returned").otherwise(_status()).alias("status"),
        _signed_money("o_totalprice", "o_orderkey", (83, 4), "n/a", (79, 6)).alias("total_amount"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _id("O", "l_orderkey", 6).alias("order_id"),
        F.concat(_id("O", "l_orderkey", 6), F.lit("-I"), F.col("l_linenumber").cast("string")).alias("item_id"),
        F.when(_when("l_partkey", 71, 9), _plain_id("P", F.col("l_partkey") + 1000000)).otherwise(_id("P", "l_partkey", 4)).alias("product_id"),
        F.when((F.col("l_linenumber") == 1) & _when("l_orderkey", 61, 7), "x")
        .when((F.col("l_linenumber") == 1) & _when("l_orderkey", 67, 8), "-2")
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when((F.col("l_linenumber") == 2) & _when("l_orderkey", 73, 3), "free").otherwise(_money_text("l_extendedprice")).alias("unit_price"),
    )


def raw_payments(orders: DataFrame) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(digit == "1", "credit_card")
        .when(digit == "2", "debit_card")
        .when(digit == "3", "boleto")
        .when(digit == "4", "pix")
        .otherwise(" PIX ")
    )
    return orders.select(
        _id("PAY", "o_orderkey", 6).alias("payment_id"),
        F.when(_when("o_orderkey", 107, 3), _plain_id("O", F.col("o_orderkey") + 90000000)).otherwise(_id("O", "o_orderkey", 6)).alias("order_id"),
        kind.alias("payment_type"),
        (F.col("o_custkey") % 12 + 1).cast("string").alias("payment_installments"),
        _signed_money("o_totalprice", "o_orderkey", (83, 5), "abc", (79, 7)).alias("payment_value"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    second = F.col("v") == 1                  # the same id once stripped, another name
    name = F.when(F.col("p_size") <= 48, F.col("p_name"))
    return _with_variants(part, _when("p_partkey", 41, 6)).select(
        F.when(second, _plain_id("P", F.col("p_partkey"))).otherwise(_id("P", "p_partkey", 4)).alias("product_id"),
        F.when(second, F.concat(name, F.lit(" v2"))).otherwise(name).alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(_when("p_partkey", 47, 8), "?").when(_when("p_partkey", 43, 7), "-1.50").otherwise(_money_text("p_retailprice")).alias("price"),
        F.col("p_size").cast("string").alias("stock"),
    )


def raw_reviews(orders: DataFrame) -> DataFrame:
    second = F.col("v") == 1                  # the id of the order before, on this order
    return _with_variants(orders, _when("o_orderkey", 59, 5)).select(
        F.when(second, _plain_id("R", F.col("o_orderkey") - 1)).otherwise(_id("R", "o_orderkey", 6)).alias("review_id"),
        _id("O", "o_orderkey", 6).alias("order_id"),
        _customer().alias("customer_id"),
        F.when(second, "5").when(_when("o_orderkey", 113, 9), "9").when(_when("o_orderkey", 109, 10), "five")
        .otherwise(F.substring("o_orderpriority", 1, 1)).alias("rating"),
        F.nullif(F.substr(F.col("o_orderpriority"), F.lit(3)), F.lit("MEDIUM")).alias("comment"),
        F.when(_when("o_orderkey", 89, 4), "soon")
        .otherwise(_day_text(F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 14 + 1).cast("int"))))
        .alias("review_date"),
    )


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six source tables (all string columns, no audit stamp) from ``sf_dir``."""
    def read(name: str) -> DataFrame:
        return read_driver_table(spark, sf_dir, name)

    orders = read("orders")
    frames = {
        "payments": raw_payments(orders),
        "customers": raw_customers(read("customer"), read("nation")),
        "orders": raw_orders(orders),
        "order_items": raw_order_items(read("lineitem")),
        "products": raw_products(read("part")),
        "reviews": raw_reviews(orders),
    }
    return {t: frames[t].select(*fixed.RAW_COLUMNS[t]) for t in fixed.TABLES}


def raw_tables(spark: SparkSession, sf_dir: str, at: str | None = LANDED_AT) -> dict[str, DataFrame]:
    """The six raw tables (all string columns + audit stamp) from ``sf_dir``."""
    return {t: with_audit(df, at) for t, df in source_tables(spark, sf_dir).items()}
