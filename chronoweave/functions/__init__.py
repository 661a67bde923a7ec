"""Column expressions (all JVM-side, codegen-friendly)."""

from chronoweave.functions.numeric import floor_to, to_double
from chronoweave.functions.text import (
    last_component,
    null_text_to_zero,
    pack_values,
    quote,
    valid_identifier,
)
from chronoweave.functions.time import epoch_seconds, ntz_literal, parse_time_text

__all__ = [
    "epoch_seconds", "floor_to", "last_component", "ntz_literal",
    "null_text_to_zero", "pack_values", "parse_time_text", "quote", "to_double",
    "valid_identifier",
]
