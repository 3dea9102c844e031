"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from procura.functions.expr import (
    as_of_lit,
    concat_code,
    convert_amount,
    day,
    decode,
    effective_on,
    flag_is,
    norm_text,
    num_key,
    open_interval_on,
    typed_null,
)

__all__ = [
    "as_of_lit",
    "concat_code",
    "convert_amount",
    "day",
    "decode",
    "effective_on",
    "flag_is",
    "norm_text",
    "num_key",
    "open_interval_on",
    "typed_null",
]
