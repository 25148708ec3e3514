"""Column expressions and fixed values shared by the operators."""

from pidlink.functions.text import (  # noqa: F401
    WHITESPACE,
    bracket_content,
    join_sorted,
    last_with_prefix,
    non_blank,
    scheme,
    strip_prefix,
    tokens,
    without_prefix,
)
