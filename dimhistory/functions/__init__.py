from dimhistory.functions.columns import (
    FINGERPRINT,
    append_suffix,
    fingerprint,
    format_date,
    normalize_columns,
    normalize_names,
    project,
    quoted,
    sql_date,
    sql_name,
    stamp_date,
    strip_suffix,
    with_constants,
    with_fingerprint,
)

__all__ = [
    "FINGERPRINT",
    "append_suffix",
    "fingerprint",
    "format_date",
    "normalize_columns",
    "normalize_names",
    "project",
    "quoted",
    "sql_date",
    "sql_name",
    "stamp_date",
    "strip_suffix",
    "with_constants",
    "with_fingerprint",
]
