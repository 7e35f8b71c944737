"""Driver-side helpers for field names and literals of dynamic properties."""

from __future__ import annotations

import re

_NESTED = re.compile(r"(?:.*\W)?properties[.:](.+)", re.S)


def nested_key(field: str) -> str:
    """`properties.a[2].b` -> `a-2-b`; other names are left alone."""
    found = _NESTED.fullmatch(field)
    if not found:
        return field
    return re.sub(r"\[(\d+)\]", r"-\1", found[1]).replace(".", "-")


def is_digits(text: str) -> bool:
    return bool(re.fullmatch(r"[0-9]+", text))


def is_nested(field: str) -> bool:
    """Names a dynamic property: `properties.x`, `properties:x` or `a.properties.x`."""
    return _NESTED.fullmatch(field) is not None


def split_operator(key: str) -> tuple[str, str | None]:
    """`"timestamp <="` -> `("timestamp", "<=")`; no suffix gives `None`."""
    found = re.fullmatch(r"(.*?)\s*(<=|>=|<|>)", key.strip(), re.S)
    return (found.group(1), found.group(2)) if found else (key.strip(), None)
