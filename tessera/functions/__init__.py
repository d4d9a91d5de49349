"""Column-level helpers (all built-in Spark expressions, no Python UDFs)."""

from tessera.functions.dates import (
    date_lit, date_span_label, on_or_after, on_or_after_or_null,
)
from tessera.functions.decisions import comp_type, purchase_source, seat_attribution
from tessera.functions.keys import concat_text, normalize_key, padded_key, prefixed_key
from tessera.functions.recode import recode
from tessera.functions.text import (
    blank_to_null, classify_like, first_nonblank, is_blank, not_blank,
    split_first_word, yes_no, yes_or_null,
)

__all__ = [
    "blank_to_null", "classify_like", "comp_type", "concat_text", "date_lit", "date_span_label",
    "first_nonblank", "is_blank", "normalize_key", "not_blank", "on_or_after",
    "on_or_after_or_null", "padded_key", "prefixed_key", "purchase_source", "recode", "seat_attribution", "split_first_word",
    "yes_no", "yes_or_null",
]
