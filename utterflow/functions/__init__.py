from utterflow.functions.hashing import derived_id, hash_bucket, hash_split, target_split
from utterflow.functions.text import (
    blank_to_null,
    lower_tokens,
    nfkc,
    normalize_text,
    strip_blanks,
    token_count,
    tokens,
)

__all__ = [
    "blank_to_null",
    "derived_id",
    "hash_bucket",
    "hash_split",
    "lower_tokens",
    "nfkc",
    "normalize_text",
    "strip_blanks",
    "target_split",
    "token_count",
    "tokens",
]
