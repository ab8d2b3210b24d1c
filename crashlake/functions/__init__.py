from crashlake.functions.parse import (
    safe_bigint,
    safe_date,
    safe_double,
    safe_int,
    safe_timestamp,
    state_code,
)

__all__ = ["safe_date", "safe_timestamp", "safe_int", "safe_bigint", "safe_double", "state_code"]
