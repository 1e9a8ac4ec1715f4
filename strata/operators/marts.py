"""Mart layer: business aggregates over the conformed tables.

Builders take a ``dict[str, DataFrame]`` of conformed tables and return a
lazy DataFrame. Column and table names are the published mart schema.

Scale notes (one key may hold a third of all rows):
* every aggregate is algebraic, so Spark combines map-side before the
  shuffle; exact ``count_distinct`` shuffles on (group key, distinct
  value), which spreads a hot group over the distinct values. No aggregate
  counts two distinct columns: Spark would ``Expand`` every row into one
  for each of them;
* joins against dimensions are left outer with the fact on the left, so
  AQE's skew-join split applies to a hot key, and a small dimension is
  broadcast only when its measured size is under
  ``spark.sql.autoBroadcastJoinThreshold``;
* where the grouping key functionally includes the join key, facts are
  aggregated before the join (``customer_summary``, ``product_rating``), so
  the join sees one row per key instead of every fact row, and no later
  aggregate pins a hot key to the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import with_rank

Tables = dict[str, DataFrame]


#: Published order of each mart: a metric, descending, and keys that break its ties.
ORDER: dict[str, tuple[str, tuple[str, ...]]] = {
    "vendas_por_categoria": ("receita_total", ("category",)),
    "pedidos_por_status": ("receita_total", ("status",)),
    "avaliacao_produto": ("avaliacao_media", ("product_id", "product_name", "category")),
    "resumo_clientes": ("total_gasto", ("customer_id", "customer_name", "state", "city")),
}


def mart_order(mart: str) -> list[Column]:
    """Descending by the mart's metric (NULLs last), then its keys (NULLs first)."""
    metric, keys = ORDER[mart]
    return [F.col(metric).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys]]


def _sorted(df: DataFrame, mart: str, sort: bool) -> DataFrame:
    return df.orderBy(*mart_order(mart)) if sort else df


def ranked_mart(df: DataFrame, mart: str) -> DataFrame:
    """The mart with each row's place in its published order, found range by range."""
    return with_rank(df, mart_order(mart))


def sales_by_category(t: Tables, sort: bool = True) -> DataFrame:
    """Revenue, items sold, distinct products and distinct orders per category.

    The sums are taken per product before its categories are joined, and
    added up per category with its distinct products: that join sees one
    row per product. Orders need the (order, product) ids of the items only.
    A product with several rows counts in full for each of them, as in a
    join of the items.
    """
    items = t["order_items"].select("order_id", "product_id", "quantity", "unit_price")
    products = t["products"].select("product_id", "category")
    per_product = items.groupBy("product_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("_revenue"),
        F.sum("quantity").alias("_items"),
    )
    sold = per_product.join(products, "product_id", "left").groupBy("category").agg(
        F.sum("_revenue").cast(per_product.schema["_revenue"].dataType).alias("receita_total"),
        F.sum("_items").alias("itens_vendidos"),
        F.count_distinct("product_id").alias("produtos_distintos"),
    )
    ordered = items.select("order_id", "product_id").join(products, "product_id", "left")
    kinds = ordered.groupBy(F.col("category").alias("_category")).agg(F.count_distinct("order_id").alias("total_pedidos"))
    out = sold.join(kinds, F.col("category").eqNullSafe(F.col("_category")), "left").select(
        "category", "receita_total", "itens_vendidos", "produtos_distintos", "total_pedidos",
    )
    return _sorted(out, "vendas_por_categoria", sort)


def orders_by_status(t: Tables, sort: bool = True) -> DataFrame:
    """Distinct orders, revenue and average ticket per status."""
    out = (
        t["orders"]
        .groupBy("status")
        .agg(
            F.count_distinct("order_id").alias("total_pedidos"),
            F.sum("total_amount").alias("receita_total"),
            F.avg("total_amount").alias("ticket_medio"),
        )
    )
    return _sorted(out, "pedidos_por_status", sort)


def product_rating(t: Tables, sort: bool = True) -> DataFrame:
    """Rating per product, each review counted at most once per product.

    Neither review ids nor product ids need be unique: a (review, product)
    pair counts once with its least rating, whatever orders it came through,
    and a product shows its least (name, category), NULLs first.

    Reviews are joined with the distinct (order, product) pairs, so an order
    holding several items of one product does not repeat its review. Ratings
    are aggregated per (product, review) and then per product *before* the
    attributes are joined: both aggregates combine map-side, a product with
    a large share of all reviews is spread over its reviews, and the join
    sees one row per product.
    """
    reviews = t["reviews"].select("review_id", "order_id", "rating")
    pairs = t["order_items"].select("order_id", "product_id").distinct()
    per_review = reviews.join(pairs, "order_id", "left").groupBy("product_id", "review_id").agg(F.min("rating").alias("rating"))
    per_product = per_review.groupBy("product_id").agg(
        F.avg("rating").alias("avaliacao_media"),
        F.count("review_id").alias("total_avaliacoes"),
        F.min("rating").alias("pior_nota"),
        F.max("rating").alias("melhor_nota"),
    )
    least = F.min(F.struct("product_name", "category"))
    products = t["products"].groupBy("product_id").agg(least.alias("least")).select("product_id", "least.*")
    out = per_product.join(products, "product_id", "left").select(
        "product_id", "product_name", "category",
        "avaliacao_media", "total_avaliacoes", "pior_nota", "melhor_nota",
    )
    return _sorted(out, "avaliacao_produto", sort)


def customer_summary(t: Tables, sort: bool = True) -> DataFrame:
    """Orders, spend, average ticket (per order) and first/last order per customer.

    Same result as joining every order with its customer and grouping by
    (customer_id, customer_name, state, city), computed the cheap way round:
    orders are aggregated per customer_id first (the only full shuffle of
    the fact table), then joined with the customers grouped by their
    attributes. A customer row repeated m times would have counted each
    order m times in the sum, hence the multiplicity factor; averages,
    distinct counts and min/max are unaffected by repetition.
    """
    per_customer = t["orders"].groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_pedidos"),
        F.sum("total_amount").alias("_sum"),
        F.avg("total_amount").alias("ticket_medio"),
        F.min("order_date").alias("primeiro_pedido"),
        F.max("order_date").alias("ultimo_pedido"),
    )
    attrs = t["customers"].groupBy("customer_id", "customer_name", "state", "city").agg(
        F.count(F.lit(1)).alias("_m")
    )
    sum_type = per_customer.schema["_sum"].dataType
    total = (
        F.when(F.col("_m").isNull() | (F.col("_m") == 1), F.col("_sum"))
        .otherwise(F.col("_sum") * F.col("_m"))
        .cast(sum_type)
    )
    out = per_customer.join(attrs, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "state",
        "city",
        "total_pedidos",
        total.alias("total_gasto"),
        "ticket_medio",
        "primeiro_pedido",
        "ultimo_pedido",
    )
    return _sorted(out, "resumo_clientes", sort)


#: The columns of the conformed tables that each mart reads.
READS: dict[str, dict[str, tuple[str, ...]]] = {
    "vendas_por_categoria": {"order_items": ("order_id", "product_id", "quantity", "unit_price"), "products": ("product_id", "category")},
    "pedidos_por_status": {"orders": ("order_id", "status", "total_amount")},
    "avaliacao_produto": {
        "reviews": ("review_id", "order_id", "rating"), "order_items": ("order_id", "product_id"), "products": ("product_id", "product_name", "category"),
    },
    "resumo_clientes": {
        "orders": ("order_id", "customer_id", "order_date", "total_amount"), "customers": ("customer_id", "customer_name", "state", "city"),
    },
}

BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "vendas_por_categoria": sales_by_category,
    "pedidos_por_status": orders_by_status,
    "avaliacao_produto": product_rating,
    "resumo_clientes": customer_summary,
}


def top_k(df: DataFrame, metric: str, k: int, keys: list[str]) -> DataFrame:
    """The k rows with the largest ``metric`` (ties by keys).

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps k
    rows, so only k x tasks rows ever reach the final merge.
    """
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def top_customers(summary: DataFrame, k: int = 10) -> DataFrame:
    """Top-k customers by spend from the customer summary mart."""
    return top_k(summary, "total_gasto", k, ["customer_id", "customer_name", "state", "city"])


def status_revenue(by_status: DataFrame) -> DataFrame:
    """Re-aggregate the status mart: revenue and orders per status."""
    out = by_status.groupBy("status").agg(
        F.sum("receita_total").alias("receita"),
        F.sum("total_pedidos").alias("pedidos"),
    )
    return out.orderBy(F.col("receita").desc_nulls_last(), F.col("status").asc_nulls_first())


def build_marts(conformed: Tables, sort: bool = False) -> dict[str, DataFrame]:
    """All four marts (unsorted by default: a written table promises no order)."""
    return {name: build(conformed, sort=sort) for name, build in BUILDERS.items()}
