"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without a round trip through ``str``."""
    return column.cast(pa.large_binary()).to_pylist()


def each_text(column: pa.Array | pa.ChunkedArray, rows: int = 256) -> Iterator[bytes | None]:
    """The same one after another; only ``rows`` of them are held as Python objects."""
    for lo in range(0, len(column), rows):
        yield from texts(column.slice(lo, rows))


def blocks(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose lengths add up to ``most``, or one longer item."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
