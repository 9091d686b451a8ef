"""Column-level operators: headers, operational columns, rescue, casts, keys."""

from shedlake.functions.columns import (
    cast_contract,
    decimals_to_double,
    derive_keys,
    split_quarantine,
    stamp_operational,
    standardize,
)
from shedlake.functions.headers import clean_header, sanitize_headers
from shedlake.functions.rescue import rescue

__all__ = [
    "cast_contract",
    "clean_header",
    "decimals_to_double",
    "derive_keys",
    "rescue",
    "sanitize_headers",
    "split_quarantine",
    "stamp_operational",
    "standardize",
]
