"""Rows kept as blocks of bounded size in the shared folder.

An operator that has to look at the same texts several times writes them once,
and lets small rows about a block travel instead of its texts. A retried task
writes the same rows under the same names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from plumbline.llm.common import materialise
from plumbline.llm.media import filesystem

LISTED = "block long, size long, measure long"


def slices(batches: Iterator, size: int, column: str = "text") -> Iterator:
    """(record batch, bytes of its texts): parts of the batches with about `size` bytes at most, a row at least."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        at = batch.schema.get_field_index(column)
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
        start = done = 0
        while start < len(total):
            end = max(start + 1, int(np.searchsorted(total, done + size, side="right")))
            yield batch.slice(start, end - start), int(total[end - 1]) - done
            start, done = end, int(total[end - 1])


def store(path: str, block: int, parts: list) -> None:
    import pyarrow as pa

    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{block}", compression=None) as out, pa.ipc.new_stream(out, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as w:
        for p in parts:
            w.write_batch(p)


def load(path: str, block: int):
    """A block's rows as an Arrow table."""
    import pyarrow as pa

    fs, base = filesystem(path)
    with fs.open_input_stream(f"{base}/{block}", compression=None) as f, pa.ipc.open_stream(f) as r:
        return r.read_all()


def keep(path: str, block: int, raw: bytes) -> None:
    """Puts what was worked out of a block beside it."""
    fs, base = filesystem(path)
    with fs.open_output_stream(f"{base}/{block}-kept", compression=None) as out:
        out.write(raw)


def kept(path: str, block: int) -> bytes:
    fs, base = filesystem(path)
    with fs.open_input_stream(f"{base}/{block}-kept", compression=None) as f:
        return f.read()


def texts_of(rows) -> list[str]:
    return [t or "" for t in rows.column("text").to_pylist()]


def write_blocks(docs: DataFrame, path: str, size: int, measure: Callable[[list[str]], int] = len) -> DataFrame:
    """Writes docs in blocks of about `size` bytes of text; a row (block, size, measure of its texts) for each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        parts, n = [], 0

        def done() -> pa.RecordBatch:
            store(path, base + made, parts)
            texts = [t for p in parts for t in texts_of(p)]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (base + made, n, measure(texts))], ["block", "size", "measure"])

        for part, more in slices(batches, size):
            if parts and n + more > size:
                yield done()
                made, parts, n = made + 1, [], 0
            parts.append(part)
            n += more
        if parts:
            yield done()

    return materialise(docs.mapInArrow(run, LISTED), "block-list")
