from strata.operators.conform import ConformOptions, conform_table, shift_audit_zone  # noqa: F401
from strata.operators.marts import (  # noqa: F401
    build_marts,
    customer_summary,
    orders_by_status,
    product_rating,
    sales_by_category,
    status_revenue,
    top_customers,
    top_k,
)
from strata.operators.quality import (  # noqa: F401
    QualityGateError,
    QualityReport,
    check_layer,
    check_tables,
    failures,
    gate,
    orphan_keys,
    summarize,
)
from strata.operators.tables import dedup_by_key, distinct_projection, move_to_end, with_audit  # noqa: F401
