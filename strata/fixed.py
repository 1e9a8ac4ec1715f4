"""Fixed values.

These values must equal the behaviour being reproduced (texts written into
data, domains, key registries, report wording), so they are stated here
plainly, together, in their natural order. Code elsewhere only refers to
these names.
"""

from __future__ import annotations

# --- fixed values: layer and table names -----------------------------------
LAYERS = ("bronze", "silver", "gold")
RAW, CONFORMED, MART = LAYERS
TABLES = ("payments", "customers", "orders", "order_items", "products", "reviews")
MART_TABLES = ("vendas_por_categoria", "pedidos_por_status", "avaliacao_produto", "resumo_clientes")

# --- fixed values: raw CSV headers (column order of the landed files) ------
RAW_COLUMNS = {
    "customers": ("customer_id", "customer_name", "email", "state", "city", "signup_date"),
    "orders": ("order_id", "customer_id", "order_date", "status", "total_amount"),
    "order_items": ("order_id", "item_id", "product_id", "quantity", "unit_price"),
    "payments": ("payment_id", "order_id", "payment_type", "payment_installments", "payment_value"),
    "products": ("product_id", "product_name", "category", "price", "stock"),
    "reviews": ("review_id", "order_id", "customer_id", "rating", "comment", "review_date"),
}

# --- fixed values: natural key of each table --------------------------------
NATURAL_KEYS = {
    "payments": ("payment_id",),
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "item_id"),
    "products": ("product_id",),
    "reviews": ("review_id",),
}

# --- fixed values: audit column, zone, money type ---------------------------
AUDIT_COLUMN = "_ingested_at"
LOCAL_ZONE = "America/Sao_Paulo"
MONEY = "decimal(10,2)"

# --- fixed values: texts written for missing data ---------------------------
UNKNOWN = "desconhecido"            # sentinel for missing state / customer id
NOT_INFORMED = "não informado"      # missing e-mail
UNNAMED_PRODUCT = "Produto sem nome"
NO_COMMENT = "sem comentário"
SENTINELS = (UNKNOWN,)

# --- fixed values: ID prefixes stripped by the conformed layer --------------
ID_PREFIXES = {
    "payment_id": "PAY",
    "order_id": "O",
    "customer_id": "C",
    "item_id": "O",
    "product_id": "P",
    "review_id": "R",
}

# --- fixed values: domains ---------------------------------------------------
ALLOWED_STATUSES = ("delivered", "shipped", "cancelled", "processing")
PAYMENT_TYPES = ("credit_card", "debit_card", "boleto", "pix")

# --- fixed values: severities ------------------------------------------------
ERROR = "ERROR"
WARN = "WARN"

# --- fixed values: metric columns that must not be NULL in each mart --------
MART_METRICS = {
    "vendas_por_categoria": ("category", "receita_total", "itens_vendidos", "total_pedidos"),
    "pedidos_por_status": ("status", "total_pedidos", "receita_total", "ticket_medio"),
    "avaliacao_produto": ("product_id", "avaliacao_media", "total_avaliacoes"),
    "resumo_clientes": ("customer_id", "total_pedidos", "total_gasto", "ticket_medio"),
}

# --- fixed values: quality report wording -----------------------------------
# check names
CHECK_TABLE_EXISTS = "table_exists"
CHECK_NOT_EMPTY = "not_empty"
CHECK_COLUMNS_EXIST = "columns_exist{cols}"          # cols rendered as a Python tuple
CHECK_UNIQUE = "unique({cols})"                     # cols joined by "+"
CHECK_NOT_NULL = "not_null({col})"
CHECK_RANGE = "range({col}, {lo}..{hi})"
CHECK_NON_NEGATIVE = "non_negative({col})"
CHECK_IN_SET = "in_set({col})"
CHECK_REFERENTIAL = "referential({col} -> {parent_col})"
# details
DETAIL_MISSING_TABLE = "tabela ausente"
DETAIL_COUNT = "count={n}"
DETAIL_MISSING_COLUMNS = "ausentes={cols}"          # cols rendered as a Python list
DETAIL_UNIQUE = "{rows} linhas vs {keys} chaves distintas"
DETAIL_NULLS = "{n} nulos"
DETAIL_OUT_OF_RANGE = "{n} valores fora da faixa"
DETAIL_NEGATIVE = "{n} negativos"
DETAIL_OUT_OF_SET = "{n} valores fora do conjunto"
DETAIL_ORPHANS = "{n} orfaos (sentinelas {sentinels} ignoradas)"  # sentinels as a sorted Python list
