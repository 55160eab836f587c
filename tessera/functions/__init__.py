"""Column builders: every function here returns a ``pyspark.sql.Column``
made only of built-in expressions, so it stays inside whole-stage codegen
(or, for the array lambdas, inside the JVM)."""

from tessera.functions.text import PY_WHITESPACE, py_strip, split_lines_col, is_heading
from tessera.functions.tokens import (
    BYTE_PAD, BYTE_EOS, BYTE_UNK, BYTE_OFFSET, PRESETS, TokenPreset,
    byte_ids, encode_text, decode_ids, clean_up_spaces,
)
from tessera.functions.numeric import (
    round_half_even, argmax, py_float_text, percent, format_minutes,
)

__all__ = [
    "PY_WHITESPACE", "py_strip", "split_lines_col", "is_heading",
    "BYTE_PAD", "BYTE_EOS", "BYTE_UNK", "BYTE_OFFSET", "PRESETS", "TokenPreset",
    "byte_ids", "encode_text", "decode_ids", "clean_up_spaces",
    "round_half_even", "argmax", "py_float_text", "percent", "format_minutes",
]
