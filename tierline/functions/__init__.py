"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from tierline.functions.columns import (
    code_label,
    distinct_from,
    numeric_text,
    stamp_to_timestamp,
    timestamp_to_stamp,
)

__all__ = ["code_label", "distinct_from", "numeric_text", "stamp_to_timestamp", "timestamp_to_stamp"]
