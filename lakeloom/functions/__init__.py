"""Column expressions; everything here stays inside generated JVM code."""

from .columns import (
    amount,
    calendar_columns,
    cents,
    date_key,
    exact,
    exact_sum,
    exact_type,
    hours_in,
    in_hours,
    iso_seconds,
    line_amount,
    mapped,
    mask_email,
    mask_text,
    mean_half_up,
    net_cents,
    padded_id,
    plus_seconds,
    seconds_between,
    whole_cents,
)

__all__ = [
    "amount",
    "calendar_columns",
    "cents",
    "date_key",
    "exact",
    "exact_sum",
    "exact_type",
    "hours_in",
    "in_hours",
    "iso_seconds",
    "line_amount",
    "mapped",
    "mask_email",
    "mask_text",
    "mean_half_up",
    "net_cents",
    "padded_id",
    "plus_seconds",
    "seconds_between",
    "whole_cents",
]
