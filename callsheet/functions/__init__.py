"""Column-level building blocks: scalar expressions and predicates (all JVM-side)."""

from callsheet.functions.predicates import (  # noqa: F401
    in_portfolios,
    not_like,
    recent_since,
    created_since,
    usable_phone,
)
from callsheet.functions.scalars import (  # noqa: F401
    agreement_status_label,
    agreement_type,
    concat_labels,
    distinct_concat,
    field_order,
    format_date,
)
