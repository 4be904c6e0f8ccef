"""DuckDB SQL fragments shared by oracle queries (byte ids, digests)."""


def bytes_of(expr: str) -> str:
    """DuckDB list of the UTF-8 byte values of a VARCHAR expression."""
    return (f"list_transform(regexp_extract_all(hex({expr}), '..'), "
            f"lambda x: ('0x' || x)::INTEGER)")


def digest(list_expr: str) -> str:
    return f"md5(array_to_string({list_expr}, ','))"


def zeros(n: str, v: str = "0") -> str:
    return f"list_resize([]::INTEGER[], ({n})::BIGINT, {v})"
