"""Arrow batches as Python rows and back, a bounded number at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa


def rows_of(batches: Iterable[pa.RecordBatch], *columns: str, step: int = 512) -> Iterator[tuple]:
    """The rows of the batches; only ``step`` of them exist as Python values at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns))


class Out:
    """Collects rows and gives a batch whenever they hold enough rows or bytes."""

    def __init__(self, schema: pa.Schema, rows: int = 4096, size: int = 1 << 22):
        self.schema, self.most, self.size = schema, rows, size
        self.held: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 0) -> bool:
        """True when the rows should be given out."""
        self.held.append(row)
        self.bytes += size
        return len(self.held) >= self.most or self.bytes >= self.size

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.held)) or [()] * len(self.schema)
        self.held, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )
