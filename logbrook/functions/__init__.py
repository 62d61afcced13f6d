"""Column expressions; all of them stay inside the JVM."""

from logbrook.functions.envelope import unwrap_json, wrap_json
from logbrook.functions.numbers import long_from_wire, long_to_wire, parse_long, wrapping_minus
from logbrook.functions.text import words

__all__ = ["long_from_wire", "long_to_wire", "parse_long", "unwrap_json", "words", "wrap_json", "wrapping_minus"]
