"""Column expressions shared by the layer builders (all JVM-side built-ins)."""

from matchmart.functions.exprs import (
    any_element,
    date_string_from_epoch_s,
    epoch_ms_to_s,
    flag,
    human_ids,
    iso_utc_from_epoch_ms,
    kda_ratio,
    patch_by_split,
    patch_version,
    per_match,
    safe_bigint,
    safe_int,
    timestamp_from_epoch_s,
    timestamp_string_from_epoch_s,
    valid_match,
)

__all__ = [
    "any_element",
    "date_string_from_epoch_s",
    "epoch_ms_to_s",
    "flag",
    "human_ids",
    "iso_utc_from_epoch_ms",
    "kda_ratio",
    "patch_by_split",
    "patch_version",
    "per_match",
    "safe_bigint",
    "safe_int",
    "timestamp_from_epoch_s",
    "timestamp_string_from_epoch_s",
    "valid_match",
]
