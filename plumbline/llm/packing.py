"""Bounded-space best-fit packing of token sequences.

Documents are turned into pieces where they are read, and only the lengths and
checksums of these are written and dealt out evenly to as many packers as there
are part_pieces in the corpus: how the input is cut up neither changes the
number of sequences nor gives one task most of the work. A packer has a fixed
number of bins open; a bitset keyed by free space finds the fullest bin that
still takes a piece, and when no bin takes it and all are open, the fullest
closes. Arriving pieces wait in a buffer of `block`, which goes longest first.

Defined results
  null or empty text: the final token alone; repeated rows: packed each
  null doc_id: packed, its doc_id stays null; extra columns: ignored
  no rows: no rows; a text longer than a sequence: cut, the first piece shorter
Sequence numbers are packer << 32 | bin: unique in a result. A retried packer may
get its pieces in another order, but it returns all of them again.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.bytebpe import ByteBpe
from plumbline.llm.common import chunks, materialise, ship, table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SCHEMA = PIECES + ", sequence_id long, offset long"


class OpenBins:
    """At most `most` open bins of `size`, found by their free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.made = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, n: int) -> tuple[int, int]:
        """The bin and the place in it of a piece of n tokens."""
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number, self.made = self.size, self.made, self.made + 1
        left = free - n
        if left:
            self.at[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.at[free].pop()
        if not self.at[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return number


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole sequences, but for the first."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, path: str | None = None, size: int = 2048, end_id: int = 0) -> DataFrame:
    """The rows (doc_id, piece, start, length, ids_crc32) that docs(doc_id, text) are cut into."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe = ByteBpe(path)
        end = np.array([end_id], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for doc_ids, texts in chunks(batches):
            rows = []
            for doc_id, ids in zip(doc_ids, bpe.encode(texts)):
                ids += end
                rows += [(doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, size))]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, path: str | None = None, size: int = 2048, open_bins: int = 8192, block: int = 16384, end_id: int = 0, part_pieces: int = 1_000_000) -> DataFrame:
    """Packs docs(doc_id, text); block: so many pieces are sorted by length before they are placed; part_pieces: the most that one packer gets."""
    cut_up = materialise(pieces(docs, path, size, end_id), "pieces")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        bins, base = OpenBins(size, open_bins), TaskContext.get().partitionId() << 32
        waiting, n = [], 0

        def placed() -> pa.Table:
            rows = pa.Table.from_batches(waiting)
            lengths = rows.column("length").to_numpy()
            order = np.argsort(-lengths, kind="stable")
            put = np.array([bins.put(k) for k in lengths[order].tolist()], np.int64).reshape(-1, 2)
            return rows.take(order).append_column("sequence_id", pa.array(put[:, 0] + base)).append_column("offset", pa.array(put[:, 1]))

        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= block:
                yield from placed().to_batches()
                waiting, n = [], 0
        if n:
            yield from placed().to_batches()

    return cut_up.repartition(max(1, math.ceil(cut_up.count() / part_pieces))).mapInArrow(run, SCHEMA)


def op8_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
