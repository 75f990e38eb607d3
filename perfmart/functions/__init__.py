"""Column-expression builders (built-in functions only)."""

from perfmart.functions.labels import (  # noqa: F401
    category_average,
    is_own_period,
    map_lookup,
    recode_in_scope,
    replace_all,
    strip_leading_label,
)
