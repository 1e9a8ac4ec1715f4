"""Reference SQL for the registered queries, runnable by DuckDB.

The SQL restates each query independently and the way the original
layers compute it (dedup with a window, marts as join-then-group, checks
as one count per check), over the same star-schema views. Text values,
rounding and types are made to agree with ``strata.plans.queries.present``.
"""

from __future__ import annotations

import re

from strata import fixed

AT = "TIMESTAMP '2025-01-01 12:00:00'"
TS = "'%Y-%m-%d %H:%M:%S.%f'"
ZONE = fixed.LOCAL_ZONE


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


# -- raw rendering -------------------------------------------------------------------

def _variants(table: str, *picked: str) -> str:
    """Each row as v 0, and again as v 1, 2, ... where that condition holds."""
    more = "".join(f" OR (v = {i} AND {cond})" for i, cond in enumerate(picked, 1))
    return f"{table} JOIN (VALUES {', '.join(f'({i})' for i in range(len(picked) + 1))}) variant(v) ON v = 0{more}"


def _signed(price: str, bad: str, text: str, negative: str) -> str:
    money = f"CAST(CAST({price} AS DECIMAL(12,2)) AS VARCHAR)"
    return f"CASE WHEN {bad} THEN '{text}' WHEN {negative} THEN '-' || {money} ELSE {money} END"


_CUSTOMER = "CASE WHEN o_orderkey % 53 <> 7 THEN printf('C%05d', o_custkey) END AS customer_id"

RAW = {
    "customers": f"""
SELECT printf('C%05d', c_custkey) AS customer_id, c_name AS customer_name,
       CASE WHEN c_custkey % 31 <> 4 THEN printf('cliente%05d@example.com', c_custkey) END AS email,
       CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS state, n_name AS city,
       CASE WHEN c_custkey % 37 = 5 THEN '31.12.1999'
            ELSE CAST(DATE '1992-01-01' + CAST(c_custkey % 2557 AS INTEGER) AS VARCHAR) END AS signup_date,
       {AT} AS _ingested_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "orders": f"""
SELECT CASE v WHEN 2 THEN 'O' || o_orderkey ELSE printf('O%06d', o_orderkey) END AS order_id, {_CUSTOMER},
       CASE WHEN o_orderkey % 89 = 3 THEN '2025-13-45' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       CASE WHEN v = 1 THEN 'cancelled' WHEN o_orderkey % 103 = 8 THEN 'returned'
            WHEN substr(o_orderpriority, 1, 1) = '1' THEN upper(st) WHEN substr(o_orderpriority, 1, 1) = '2' THEN ' ' || st || ' '
            ELSE st END AS status,
       {_signed('o_totalprice', 'o_orderkey % 83 = 4', 'n/a', 'o_orderkey % 79 = 6')} AS total_amount,
       {AT} AS _ingested_at
FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing' WHEN 'P' THEN 'shipped' END AS st
      FROM {_variants('orders', 'o_orderkey % 97 = 5', 'o_orderkey % 101 = 2')})""",
    "order_items": f"""
SELECT printf('O%06d', l_orderkey) AS order_id, printf('O%06d-I%d', l_orderkey, l_linenumber) AS item_id,
       CASE WHEN l_partkey % 71 = 9 THEN 'P' || (l_partkey + 1000000) ELSE printf('P%04d', l_partkey) END AS product_id,
       CASE WHEN l_linenumber = 1 AND l_orderkey % 61 = 7 THEN 'x' WHEN l_linenumber = 1 AND l_orderkey % 67 = 8 THEN '-2'
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN l_linenumber = 2 AND l_orderkey % 73 = 3 THEN 'free'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
       {AT} AS _ingested_at
FROM lineitem""",
    "payments": f"""
SELECT printf('PAY%06d', o_orderkey) AS payment_id,
       CASE WHEN o_orderkey % 107 = 3 THEN 'O' || (o_orderkey + 90000000) ELSE printf('O%06d', o_orderkey) END AS order_id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card'
            WHEN '3' THEN 'boleto' WHEN '4' THEN 'pix' ELSE ' PIX ' END AS payment_type,
       CAST(o_custkey % 12 + 1 AS VARCHAR) AS payment_installments,
       {_signed('o_totalprice', 'o_orderkey % 83 = 5', 'abc', 'o_orderkey % 79 = 7')} AS payment_value,
       {AT} AS _ingested_at
FROM orders""",
    "products": f"""
SELECT CASE v WHEN 1 THEN 'P' || p_partkey ELSE printf('P%04d', p_partkey) END AS product_id,
       CASE WHEN p_size <= 48 THEN p_name || CASE v WHEN 1 THEN ' v2' ELSE '' END END AS product_name, p_type AS category,
       CASE WHEN p_partkey % 47 = 8 THEN '?' WHEN p_partkey % 43 = 7 THEN '-1.50'
            ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
       CAST(p_size AS VARCHAR) AS stock,
       {AT} AS _ingested_at
FROM {_variants('part', 'p_partkey % 41 = 6')}""",
    "reviews": f"""
SELECT CASE v WHEN 1 THEN 'R' || (o_orderkey - 1) ELSE printf('R%06d', o_orderkey) END AS review_id,
       printf('O%06d', o_orderkey) AS order_id, {_CUSTOMER},
       CASE WHEN v = 1 THEN '5' WHEN o_orderkey % 113 = 9 THEN '9' WHEN o_orderkey % 109 = 10 THEN 'five'
            ELSE substr(o_orderpriority, 1, 1) END AS rating,
       nullif(substr(o_orderpriority, 3), 'MEDIUM') AS comment,
       CASE WHEN o_orderkey % 89 = 4 THEN 'soon'
            ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + 1 AS INTEGER) AS VARCHAR) END AS review_date,
       {AT} AS _ingested_at
FROM {_variants('orders', 'o_orderkey % 59 = 5')}""",
}


def _dedup(table: str) -> str:
    keys = fixed.NATURAL_KEYS[table]
    cols = list(fixed.RAW_COLUMNS[table]) + [fixed.AUDIT_COLUMN]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in cols if c not in keys)
    return (f"SELECT * FROM raw_{table} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{fixed.ID_PREFIXES[c]}0*', '')"


_AUDIT = f"(_ingested_at AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS _ingested_at"

CONF = {
    "payments": f"""
SELECT {_strip('payment_id')} AS payment_id, {_strip('order_id')} AS order_id,
       lower(trim(payment_type)) AS payment_type, payment_installments,
       try_cast(payment_value AS DECIMAL(10,2)) AS payment_value, {_AUDIT}
FROM dd_payments""",
    "customers": f"""
SELECT {_strip('customer_id')} AS customer_id, customer_name,
       coalesce(email, {_lit(fixed.NOT_INFORMED)}) AS email, coalesce(state, {_lit(fixed.UNKNOWN)}) AS state,
       city, try_cast(signup_date AS DATE) AS signup_date, {_AUDIT}
FROM dd_customers""",
    "orders": f"""
SELECT {_strip('order_id')} AS order_id,
       CASE WHEN customer_id IS NULL THEN {_lit(fixed.UNKNOWN)} ELSE {_strip('customer_id')} END AS customer_id,
       try_cast(order_date AS DATE) AS order_date, lower(trim(status)) AS status,
       try_cast(total_amount AS DECIMAL(10,2)) AS total_amount, {_AUDIT}
FROM dd_orders""",
    "order_items": f"""
SELECT {_strip('order_id')} AS order_id, regexp_replace(item_id, '^O0*', '') AS item_id,
       {_strip('product_id')} AS product_id, try_cast(quantity AS INTEGER) AS quantity,
       try_cast(unit_price AS DECIMAL(10,2)) AS unit_price, {_AUDIT}
FROM dd_order_items""",
    "products": f"""
SELECT {_strip('product_id')} AS product_id, coalesce(product_name, {_lit(fixed.UNNAMED_PRODUCT)}) AS product_name,
       category, try_cast(price AS DECIMAL(10,2)) AS price, try_cast(stock AS INTEGER) AS stock, {_AUDIT}
FROM dd_products""",
    "reviews": f"""
SELECT {_strip('review_id')} AS review_id, {_strip('order_id')} AS order_id, {_strip('customer_id')} AS customer_id,
       try_cast(rating AS INTEGER) AS rating, coalesce(comment, {_lit(fixed.NO_COMMENT)}) AS comment,
       try_cast(review_date AS DATE) AS review_date, {_AUDIT}
FROM dd_reviews""",
}


def _avg_half_up(x: str) -> str:
    """avg of a decimal(10,2) column rounded HALF_UP to 6 places, as double."""
    n = f"count({x})"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(CASE WHEN sum({x}) >= 0 "
            f"THEN (CAST(sum({x}) * 100 AS HUGEINT) * 20000 + {n}) // (2 * {n}) "
            f"ELSE -((CAST(-sum({x}) * 100 AS HUGEINT) * 20000 + {n}) // (2 * {n})) END AS DOUBLE) / 1000000.0 END")


MART = {
    "vendas_por_categoria": """
SELECT p.category, sum(i.quantity * i.unit_price) AS receita_total, sum(i.quantity) AS itens_vendidos,
       count(DISTINCT i.product_id) AS produtos_distintos, count(DISTINCT i.order_id) AS total_pedidos
FROM conf_order_items i LEFT JOIN conf_products p ON i.product_id = p.product_id
GROUP BY p.category""",
    "pedidos_por_status": f"""
SELECT status, count(DISTINCT order_id) AS total_pedidos, sum(total_amount) AS receita_total,
       {_avg_half_up('total_amount')} AS ticket_medio
FROM conf_orders GROUP BY status""",
    "avaliacao_produto": """
SELECT d.product_id, p.product_name, p.category, avg(d.rating) AS avaliacao_media,
       count(d.review_id) AS total_avaliacoes, min(d.rating) AS pior_nota, max(d.rating) AS melhor_nota
FROM (SELECT i.product_id, r.review_id, min(r.rating) AS rating
      FROM conf_reviews r LEFT JOIN conf_order_items i ON r.order_id = i.order_id GROUP BY i.product_id, r.review_id) d
LEFT JOIN (SELECT product_id, product_name, category FROM conf_products QUALIFY row_number() OVER
           (PARTITION BY product_id ORDER BY product_name NULLS FIRST, category NULLS FIRST) = 1) p ON d.product_id = p.product_id
GROUP BY d.product_id, p.product_name, p.category""",
    "resumo_clientes": f"""
SELECT o.customer_id, c.customer_name, c.state, c.city, count(DISTINCT o.order_id) AS total_pedidos,
       sum(o.total_amount) AS total_gasto, {_avg_half_up('o.total_amount')} AS ticket_medio,
       min(o.order_date) AS primeiro_pedido, max(o.order_date) AS ultimo_pedido
FROM conf_orders o LEFT JOIN conf_customers c ON o.customer_id = c.customer_id
GROUP BY o.customer_id, c.customer_name, c.state, c.city""",
}


def _ctes() -> str:
    parts = []
    for t in fixed.TABLES:
        parts.append(f"raw_{t} AS ({RAW[t]})")
        parts.append(f"dd_{t} AS ({_dedup(t)})")
        parts.append(f"conf_{t} AS ({CONF[t]})")
    for m in fixed.MART_TABLES:
        parts.append(f"mart_{m} AS ({MART[m]})")
    return "WITH " + ",\n".join(parts) + "\n"


def layered(body: str) -> str:
    return _ctes() + body


# -- presentation of typed layer tables ---------------------------------------------------

CONF_PRESENT = {
    "payments": ("payment_id, order_id, payment_type, payment_installments, "
                 f"CAST(payment_value AS DOUBLE) AS payment_value, strftime(_ingested_at, {TS}) AS _ingested_at"),
    "customers": ("customer_id, customer_name, email, state, city, CAST(signup_date AS VARCHAR) AS signup_date, "
                  f"strftime(_ingested_at, {TS}) AS _ingested_at"),
    "orders": ("order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, status, "
               f"CAST(total_amount AS DOUBLE) AS total_amount, strftime(_ingested_at, {TS}) AS _ingested_at"),
    "order_items": ("order_id, item_id, product_id, CAST(quantity AS BIGINT) AS quantity, "
                    f"CAST(unit_price AS DOUBLE) AS unit_price, strftime(_ingested_at, {TS}) AS _ingested_at"),
    "products": ("product_id, product_name, category, CAST(price AS DOUBLE) AS price, "
                 f"CAST(stock AS BIGINT) AS stock, strftime(_ingested_at, {TS}) AS _ingested_at"),
    "reviews": ("review_id, order_id, customer_id, CAST(rating AS BIGINT) AS rating, comment, "
                f"CAST(review_date AS VARCHAR) AS review_date, strftime(_ingested_at, {TS}) AS _ingested_at"),
}

MART_PRESENT = {
    "vendas_por_categoria": ("category, CAST(receita_total AS DOUBLE) AS receita_total, "
                             "CAST(itens_vendidos AS BIGINT) AS itens_vendidos, produtos_distintos, total_pedidos"),
    "pedidos_por_status": ("status, total_pedidos, CAST(receita_total AS DOUBLE) AS receita_total, "
                           "CAST(ticket_medio AS DOUBLE) AS ticket_medio"),
    "avaliacao_produto": ("product_id, product_name, category, avaliacao_media, total_avaliacoes, "
                          "CAST(pior_nota AS BIGINT) AS pior_nota, CAST(melhor_nota AS BIGINT) AS melhor_nota"),
    "resumo_clientes": ("customer_id, customer_name, state, city, total_pedidos, "
                        "CAST(total_gasto AS DOUBLE) AS total_gasto, CAST(ticket_medio AS DOUBLE) AS ticket_medio, "
                        "CAST(primeiro_pedido AS VARCHAR) AS primeiro_pedido, "
                        "CAST(ultimo_pedido AS VARCHAR) AS ultimo_pedido"),
}


# -- quality reports as SQL ---------------------------------------------------------------

def _row(layer, seq, table, check, severity, passed, violations, detail, source="") -> str:
    return (f"SELECT {_lit(layer)} AS layer, CAST({seq} AS BIGINT) AS seq, {_lit(table)} AS \"table\", "
            f"{_lit(check)} AS \"check\", {_lit(severity)} AS severity, {passed} AS passed, "
            f"CAST({violations} AS BIGINT) AS violations, {detail} AS detail{source}")


def _count_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


#: The checks of each layer as they appear in the reports, written out here and
#: not taken from the engine: table, check, severity, and what the check needs besides.
CHECKS = {
    fixed.RAW: """
payments | not_empty | ERROR
payments | columns_exist('_ingested_at',) | ERROR
payments | not_null(_ingested_at) | ERROR
customers | not_empty | ERROR
customers | columns_exist('_ingested_at',) | ERROR
customers | not_null(_ingested_at) | ERROR
orders | not_empty | ERROR
orders | columns_exist('_ingested_at',) | ERROR
orders | not_null(_ingested_at) | ERROR
order_items | not_empty | ERROR
order_items | columns_exist('_ingested_at',) | ERROR
order_items | not_null(_ingested_at) | ERROR
products | not_empty | ERROR
products | columns_exist('_ingested_at',) | ERROR
products | not_null(_ingested_at) | ERROR
reviews | not_empty | ERROR
reviews | columns_exist('_ingested_at',) | ERROR
reviews | not_null(_ingested_at) | ERROR
""",
    fixed.CONFORMED: """
payments | not_empty | ERROR
payments | not_null(payment_id) | ERROR
payments | unique(payment_id) | ERROR
customers | not_empty | ERROR
customers | not_null(customer_id) | ERROR
customers | unique(customer_id) | ERROR
orders | not_empty | ERROR
orders | not_null(order_id) | ERROR
orders | unique(order_id) | ERROR
order_items | not_empty | ERROR
order_items | not_null(order_id) | ERROR
order_items | not_null(item_id) | ERROR
order_items | unique(order_id+item_id) | ERROR
products | not_empty | ERROR
products | not_null(product_id) | ERROR
products | unique(product_id) | ERROR
reviews | not_empty | ERROR
reviews | not_null(review_id) | ERROR
reviews | unique(review_id) | ERROR
customers | not_null(signup_date) | ERROR
orders | not_null(order_date) | ERROR
orders | not_null(total_amount) | ERROR
orders | in_set(status) | ERROR | 'delivered', 'shipped', 'cancelled', 'processing'
orders | non_negative(total_amount) | WARN
orders | referential(customer_id -> customer_id) | WARN | customers | 'desconhecido'
payments | not_null(payment_value) | ERROR
payments | non_negative(payment_value) | WARN
payments | referential(order_id -> order_id) | ERROR | orders |
order_items | not_null(quantity) | ERROR
order_items | not_null(unit_price) | ERROR
order_items | not_null(product_id) | ERROR
order_items | non_negative(quantity) | WARN
order_items | referential(order_id -> order_id) | ERROR | orders |
order_items | referential(product_id -> product_id) | ERROR | products |
reviews | not_null(rating) | ERROR
reviews | not_null(review_date) | ERROR
reviews | range(rating, 1..5) | ERROR
reviews | referential(order_id -> order_id) | ERROR | orders |
reviews | referential(customer_id -> customer_id) | WARN | customers | 'desconhecido'
""",
    fixed.MART: """
vendas_por_categoria | not_empty | ERROR
vendas_por_categoria | not_null(category) | ERROR
vendas_por_categoria | not_null(receita_total) | ERROR
vendas_por_categoria | not_null(itens_vendidos) | ERROR
vendas_por_categoria | not_null(total_pedidos) | ERROR
pedidos_por_status | not_empty | ERROR
pedidos_por_status | not_null(status) | ERROR
pedidos_por_status | not_null(total_pedidos) | ERROR
pedidos_por_status | not_null(receita_total) | ERROR
pedidos_por_status | not_null(ticket_medio) | ERROR
avaliacao_produto | not_empty | ERROR
avaliacao_produto | not_null(product_id) | ERROR
avaliacao_produto | not_null(avaliacao_media) | ERROR
avaliacao_produto | not_null(total_avaliacoes) | ERROR
resumo_clientes | not_empty | ERROR
resumo_clientes | not_null(customer_id) | ERROR
resumo_clientes | not_null(total_pedidos) | ERROR
resumo_clientes | not_null(total_gasto) | ERROR
resumo_clientes | not_null(ticket_medio) | ERROR
avaliacao_produto | range(avaliacao_media, 1..5) | ERROR
vendas_por_categoria | non_negative(receita_total) | WARN
pedidos_por_status | non_negative(receita_total) | WARN
resumo_clientes | non_negative(total_gasto) | WARN
""",
}


def report_sql(checks: str, relations: dict[str, str], columns: dict[str, tuple], layer: str,
               qualify: bool = False) -> str:
    """UNION ALL of one SELECT per check of the list, numbered in its order."""
    selects, seen, seq = [], set(), 0

    def label(t):
        return f"{layer}.{t}" if qualify else t

    for line in checks.strip().splitlines():
        table, name, sev, *more = (x.strip() for x in line.split("|"))
        rel = relations.get(table)
        if table not in seen:
            seen.add(table)
            ok = rel is not None
            selects.append(_row(layer, seq, label(table), "table_exists", "ERROR",
                                "true" if ok else "false", 0 if ok else 1, "''" if ok else "'tabela ausente'"))
            seq += 1
        kind, _, inner = name.partition("(")
        inner = inner.removesuffix(")")
        if rel is None or (kind == "referential" and relations.get(more[0]) is None):
            continue
        lab = label(table)
        if kind == "columns_exist":
            missing = [c for c in re.findall(r"'([^']+)'", inner) if c not in columns[table]]
            selects.append(_row(layer, seq, lab, name, sev, "false" if missing else "true", len(missing),
                                _lit(f"ausentes={missing!r}")))
        elif kind == "not_empty":
            selects.append(_row(layer, seq, lab, name, sev, "count(*) > 0",
                                "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END",
                                "'count=' || CAST(count(*) AS VARCHAR)", f" FROM {rel}"))
        elif kind in ("not_null", "range", "non_negative", "in_set"):
            c = inner.split(",")[0]
            if kind == "not_null":
                cond, suffix = f"{c} IS NULL", " nulos"
            elif kind == "range":
                lo, hi = inner.split(",")[1].split("..")
                cond, suffix = f"{c} < {lo} OR {c} > {hi}", " valores fora da faixa"
            elif kind == "non_negative":
                cond, suffix = f"{c} < 0", " negativos"
            else:
                cond = f"{c} IS NOT NULL" + (f" AND {c} NOT IN ({more[0]})" if more and more[0] else "")
                suffix = " valores fora do conjunto"
            n = _count_if(cond)
            selects.append(_row(layer, seq, lab, name, sev, f"{n} = 0", n,
                                f"CAST({n} AS VARCHAR) || {_lit(suffix)}", f" FROM {rel}"))
        elif kind == "unique":
            keys = inner.replace("+", ", ")
            src = f" FROM (SELECT {keys}, count(*) AS n FROM {rel} GROUP BY {keys}) g"
            rows, nkeys = "coalesce(sum(n), 0)", "count(*)"
            selects.append(_row(layer, seq, lab, name, sev, f"{rows} = {nkeys}", f"{rows} - {nkeys}",
                                f"CAST({rows} AS BIGINT) || ' linhas vs ' || CAST({nkeys} AS VARCHAR) "
                                "|| ' chaves distintas'", src))
        else:
            c, pc = inner.split(" -> ")
            parent, exclude = relations[more[0]], more[1]
            excl = f" AND {c} NOT IN ({exclude})" if exclude else ""
            src = (f" FROM (SELECT DISTINCT {c} AS k FROM {rel} WHERE {c} IS NOT NULL{excl}) ck "
                   f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pc} = ck.k)")
            tail = _lit(f" orfaos (sentinelas [{exclude}] ignoradas)")
            selects.append(_row(layer, seq, lab, name, sev, "count(*) = 0", "count(*)",
                                f"CAST(count(*) AS VARCHAR) || {tail}", src))
        seq += 1
    return "\nUNION ALL\n".join(selects)


def layer_report_sql(layer: str, without: tuple[str, ...] = ()) -> str:
    prefix = {fixed.RAW: "raw_", fixed.CONFORMED: "conf_", fixed.MART: "mart_"}[layer]
    tables = fixed.MART_TABLES if layer == fixed.MART else fixed.TABLES
    relations = {t: prefix + t for t in tables if t not in without}
    return report_sql(CHECKS[layer], relations, _layer_columns(layer), layer, qualify=True)


def _layer_columns(layer: str) -> dict[str, tuple]:
    if layer == fixed.MART:
        return {
            "vendas_por_categoria": ("category", "receita_total", "itens_vendidos", "produtos_distintos",
                                     "total_pedidos"),
            "pedidos_por_status": ("status", "total_pedidos", "receita_total", "ticket_medio"),
            "avaliacao_produto": ("product_id", "product_name", "category", "avaliacao_media",
                                  "total_avaliacoes", "pior_nota", "melhor_nota"),
            "resumo_clientes": ("customer_id", "customer_name", "state", "city", "total_pedidos",
                                "total_gasto", "ticket_medio", "primeiro_pedido", "ultimo_pedido"),
        }
    return {t: tuple(fixed.RAW_COLUMNS[t]) + (fixed.AUDIT_COLUMN,) for t in fixed.TABLES}


DRIVER_COLUMNS = {
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
}


# -- the registered queries -----------------------------------------------------------------

def _operator_sql() -> dict[str, str]:
    gaps = ("CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '   ' "
            "WHEN c_acctbal < 2000 THEN '' ELSE c_mktsegment END")
    price = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
    month = "month(o_orderdate) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
    date_text = (f"CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST({month} AS VARCHAR), 2, '0') "
                 "|| '-' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0')")
    rating_text = "substr(o_orderpriority, 1, CAST(o_orderkey % 2 + 1 AS INTEGER))"
    li_cols = DRIVER_COLUMNS["lineitem"]
    li_rest = [c for c in li_cols if c not in ("l_orderkey", "l_linenumber")]
    def li_col(c: str) -> str:
        if c == "l_shipdate":
            return f"strftime({c}, {TS}) AS {c}"
        return f"CAST({c} AS BIGINT) AS {c}" if c == "l_linenumber" else c

    li_present = ", ".join(li_col(c) for c in li_cols)
    li_key_last = ", ".join([li_col(c) for c in li_cols if c != "l_orderkey"] + ["l_orderkey"])
    return {
        "strip_prefix": "SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', '') AS customer_ref FROM customer",
        "text_normalise": "SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS segment FROM customer",
        "utc_to_zone": (f"SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}', {TS}) AS ts_local "
                        "FROM events"),
        "money_cast": (f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, "
                       f"CAST(try_cast({price} || CAST(l_linenumber AS VARCHAR) AS DECIMAL(10,2)) AS DOUBLE) "
                       "AS amount_rounded, "
                       f"CAST(try_cast({price} || '000' AS DECIMAL(10,2)) AS DOUBLE) AS amount_overflow "
                       "FROM lineitem"),
        "int_try_cast": (f"SELECT o_orderkey, {rating_text} AS rating_text, "
                         f"CAST(try_cast({rating_text} AS INTEGER) AS DOUBLE) AS rating FROM orders"),
        "date_try_cast": (f"SELECT o_orderkey, {date_text} AS date_text, "
                          f"CAST(try_cast({date_text} AS DATE) AS VARCHAR) AS parsed FROM orders"),
        "null_default": f"SELECT c_custkey, coalesce({gaps}, 'desconhecido') AS segment FROM customer",
        "blank_default": (f"SELECT c_custkey, CASE WHEN {gaps} IS NULL OR trim({gaps}) = '' THEN 'desconhecido' "
                          f"ELSE {gaps} END AS segment FROM customer"),
        "sentinel_or_strip": ("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'desconhecido' "
                              "ELSE regexp_replace(printf('C%05d', o_custkey), '^C0*', '') END AS customer_id "
                              "FROM orders"),
        "dedup_by_key": (f"SELECT {li_present} FROM lineitem QUALIFY row_number() OVER "
                         "(PARTITION BY l_orderkey, l_linenumber ORDER BY "
                         + ", ".join(f"{c} ASC NULLS FIRST" for c in li_rest) + ") = 1"),
        "distinct_projection": "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem",
        "column_to_end": f"SELECT {li_key_last} FROM lineitem",
        "audit_column": (f"SELECT o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {TS}) AS o_orderdate, "
                         f"o_orderpriority, strftime({AT}, {TS}) AS _ingested_at, o_orderkey FROM orders"),
        "orphan_keys": ("SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (0, 1) AND NOT EXISTS "
                        "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"),
    }


def _dq_sql() -> dict[str, str]:
    cols = dict(DRIVER_COLUMNS) | {"negative_lines": DRIVER_COLUMNS["lineitem"]}
    plain = {t: t for t in cols}

    def report(checks: str, head: str = "", **other: str) -> str:
        return head + report_sql(checks, plain | other, cols, "source")

    return {
        "dq_not_empty": report("""
lineitem | not_empty | ERROR
lineitem | columns_exist('l_orderkey', 'l_shipdate') | ERROR
negative_lines | not_empty | ERROR
negative_lines | columns_exist('l_receiptdate',) | ERROR
""", "WITH negative_lines AS (SELECT * FROM lineitem WHERE l_quantity < 0) "),
        "dq_unique": report("""
lineitem | unique(l_orderkey+l_linenumber) | ERROR
orders | unique(o_orderkey) | ERROR
"""),
        "dq_not_null": report("""
customer | not_null(c_name) | ERROR
customer | not_null(c_segment) | ERROR
customer | not_null(c_segment) | WARN
""", "WITH c AS (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_segment FROM customer) ", customer="c"),
        "dq_range": report("""
orders | range(rating, 1..5) | ERROR
orders | range(rating, 1..4) | ERROR
orders | range(o_totalprice, 1000..400000) | WARN
""", "WITH o AS (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating FROM orders) ", orders="o"),
        "dq_non_negative": report("""
customer | non_negative(c_acctbal) | WARN
orders | non_negative(o_totalprice) | WARN
customer | non_negative(c_acctbal) | ERROR
"""),
        "dq_in_set": report("""
orders | in_set(o_orderstatus) | ERROR | 'F', 'O', 'P'
orders | in_set(o_orderstatus) | ERROR | 'F', 'O'
orders | in_set(o_orderstatus) | WARN |
"""),
        "dq_referential": report("""
lineitem | referential(l_orderkey -> o_orderkey) | ERROR | orders |
lineitem | referential(l_partkey -> p_partkey) | ERROR | part |
orders | referential(o_orderkey -> l_orderkey) | ERROR | lineitem |
orders | referential(o_orderkey -> l_orderkey) | WARN | lineitem | 0, 1
"""),
        "dq_missing_table": layered(layer_report_sql(fixed.CONFORMED, without=("reviews", "products"))),
    }


def _layer_sql() -> dict[str, str]:
    out = {}
    for t in fixed.TABLES:
        out[f"conform_{t}"] = layered(f"SELECT {CONF_PRESENT[t]} FROM conf_{t}")
    names = {"vendas_por_categoria": "mart_sales_by_category", "pedidos_por_status": "mart_orders_by_status",
             "avaliacao_produto": "mart_product_rating", "resumo_clientes": "mart_customer_summary"}
    for m, q in names.items():
        out[q] = layered(f"SELECT {MART_PRESENT[m]} FROM mart_{m}")
    out["top_customers"] = layered(
        f"SELECT {MART_PRESENT['resumo_clientes']} FROM mart_resumo_clientes ORDER BY total_gasto DESC NULLS LAST, "
        "customer_id ASC NULLS FIRST, customer_name ASC NULLS FIRST, state ASC NULLS FIRST, city ASC NULLS FIRST "
        "LIMIT 10")
    out["status_revenue"] = layered(
        "SELECT status, CAST(sum(receita_total) AS DOUBLE) AS receita, CAST(sum(total_pedidos) AS BIGINT) AS pedidos "
        "FROM mart_pedidos_por_status GROUP BY status")
    orders = {
        "vendas_por_categoria": ("receita_total", ["category"]), "pedidos_por_status": ("receita_total", ["status"]),
        "avaliacao_produto": ("avaliacao_media", ["product_id", "product_name", "category"]),
        "resumo_clientes": ("total_gasto", ["customer_id", "customer_name", "state", "city"]),
    }
    ranked = []
    for m, (metric, keys) in orders.items():
        by = ", ".join([f"{metric} DESC NULLS LAST", *(f"{k} NULLS FIRST" for k in keys)])
        shown = ", ".join(f"coalesce({k}, '-')" for k in keys)
        ranked.append(f"SELECT '{m}' AS mart, row_number() OVER (ORDER BY {by}) AS rank, concat_ws('|', {shown}) AS row_key, CAST({metric} AS DOUBLE) AS metric FROM mart_{m}")
    out["ranked_marts"] = layered("\nUNION ALL\n".join(ranked))
    counts = []
    for layer, prefix, tables in ((fixed.RAW, "raw_", fixed.TABLES), (fixed.CONFORMED, "conf_", fixed.TABLES),
                                  (fixed.MART, "mart_", fixed.MART_TABLES)):
        for t in tables:
            counts.append(f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS rows FROM {prefix}{t}")
    out["layer_row_counts"] = layered("\nUNION ALL\n".join(counts))
    reports = {layer: layer_report_sql(layer) for layer in (fixed.RAW, fixed.CONFORMED, fixed.MART)}
    out["dq_raw_suite"] = layered(reports[fixed.RAW])
    out["dq_conformed_suite"] = layered(reports[fixed.CONFORMED])
    out["dq_mart_suite"] = layered(reports[fixed.MART])
    union = "\nUNION ALL\n".join(f"({r})" for r in reports.values())
    out["dq_summary"] = layered(
        f"SELECT layer, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed, "
        f"count(*) FILTER (WHERE severity = 'ERROR' AND NOT passed) AS errors, "
        f"count(*) FILTER (WHERE severity = 'WARN' AND NOT passed) AS warnings FROM ({union}) r GROUP BY layer")
    out["dq_failures"] = layered(
        f"SELECT layer, severity, \"table\", \"check\", violations, detail FROM ({union}) r WHERE NOT passed")
    return out




# -- sources and sinks -----------------------------------------------------------------------

def _raw_present(table: str) -> str:
    cols = ", ".join(fixed.RAW_COLUMNS[table])
    return f"SELECT {cols}, strftime(_ingested_at, {TS}) AS _ingested_at FROM ({RAW[table]})"


def _io_sql() -> dict[str, str]:
    cols = ", ".join(fixed.RAW_COLUMNS["orders"])
    filled = ", ".join(f"coalesce({c}, '') AS {c}" for c in fixed.RAW_COLUMNS["customers"])
    counts = "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, {f'(SELECT count(*) FROM {prefix}{t})' if prefix else '-1'} AS rows"
        for layer, prefix, tables in ((fixed.RAW, "raw_", fixed.TABLES), (fixed.CONFORMED, "conf_", fixed.TABLES), (fixed.MART, "", fixed.MART_TABLES))
        for t in tables)
    return {
        "csv_keep_empty": f"SELECT {filled} FROM ({RAW['customers']})",
        "rewritten_preview": ("SELECT product_id, product_name, CAST(try_cast(price AS DECIMAL(10,2)) AS DOUBLE) AS price "
                              f"FROM ({RAW['products']}) ORDER BY product_id, product_name NULLS FIRST LIMIT 25"),
        "csv_line_breaks": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, source FROM documents",
        "csv_rejected": """
SELECT CASE WHEN more OR less THEN 'rejected' ELSE 'row' END AS kind, CAST(o_orderkey AS VARCHAR) AS "order",
       CASE WHEN more THEN o_orderkey || ',"' || o_orderpriority || chr(10) || 'says ""' || o_orderstatus || '""' || '",one more'
            WHEN less THEN CAST(o_orderkey AS VARCHAR)
            ELSE o_orderpriority || chr(10) || 'says "' || o_orderstatus || '"' END AS note
FROM (SELECT *, o_orderkey % 11 = 3 AS more, o_orderkey % 13 = 5 AS less FROM orders)""",
        "csv_missing_file": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, true AS found, (SELECT count(*) FROM ({RAW[t]})) AS rows" if i < 4
            else f"SELECT '{t}' AS table_name, false AS found, -1 AS rows" for i, t in enumerate(fixed.TABLES)),
        "strict_overwrite": f"SELECT {', '.join(fixed.RAW_COLUMNS['products'])}, true AS refused FROM ({RAW['products']}) WHERE product_name IS NOT NULL",
        "relocated_store": (f"SELECT {cols}, CASE WHEN lower(trim(status)) = 'delivered' THEN 'second' ELSE 'first' END AS location "
                            f"FROM ({RAW['orders']}) WHERE status IS NOT NULL"),
        "now_in_zone": f"SELECT event_id, date_diff('minute', now() AT TIME ZONE 'UTC', now() AT TIME ZONE '{ZONE}') AS minutes_ahead FROM events",
        "resumed_sales_by_category": layered(f"SELECT {MART_PRESENT['vendas_por_categoria']} FROM mart_vendas_por_categoria"),
        "catalog_customer_summary": layered(f"SELECT {MART_PRESENT['resumo_clientes']} FROM mart_resumo_clientes"),
        "gated_counts": layered(counts),
        "csv_roundtrip_orders": _raw_present("orders"),
        "csv_roundtrip_products": _raw_present("products"),
        "stream_landing_orders": f"SELECT {cols}, true AS stamped FROM ({RAW['orders']})",
        "gated_sales_by_category": layered(f"SELECT {MART_PRESENT['vendas_por_categoria']} FROM mart_vendas_por_categoria"),
        "gated_quality_report": layered("\nUNION ALL\n".join(
            f"({layer_report_sql(layer)})" for layer in (fixed.RAW, fixed.CONFORMED))),
    }


def oracle_sql() -> dict[str, str]:
    return {**_layer_sql(), **_operator_sql(), **_dq_sql(), **_io_sql()}
