"""Small helpers of the Python stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

_KEPT: dict[str, object] = {}


def cached(key: str, build: Callable[[], object]) -> object:
    """A worker's one copy of what tasks of the same job share, such as an automaton; the latest few stay."""
    if key not in _KEPT:
        while len(_KEPT) >= 4:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[key] = build()
    return _KEPT[key]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def texts(column: pa.Array) -> Iterator[str]:
    """Each text; null counts as empty."""
    for value in column:
        yield value.as_py() or ""
