"""Scalar Column functions (all JVM-side, codegen-friendly)."""

from carelens.functions.numeric import add_parts, coerce_numeric, nan_to_null, num, to_number
from carelens.functions.text import strip, strip_zeros, to_text, upper

__all__ = [
    "add_parts", "coerce_numeric", "nan_to_null", "num", "to_number",
    "strip", "strip_zeros", "to_text", "upper",
]
