"""Column expressions: lenient casts, instants, partition dates and null defaults."""

from wattline.functions.scalars import (
    default_text,
    partition_date,
    to_float,
    to_instant,
    to_number,
)

__all__ = ["default_text", "partition_date", "to_float", "to_instant", "to_number"]
