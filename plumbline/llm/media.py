"""Media columns: archives of compressed samples, read by a Spark data source of our own.

Writing: every partition streams its payloads into one archive file of members
(a fixed header, then a PNG of 8-bit grey samples, 576 in a row) and a side
file of fixed-width entries (offset, length). Only archives whose names the
finished tasks returned count, so a retried task leaves nothing double.

Reading: format("archive_media") plans partitions as byte ranges of the
archives; a member belongs to the range in which it starts. A task streams its
members as Arrow batches of bounded bytes, and retries a member alone, at its
offset with a newly opened file, when reading or its checksum fails.

Defined results
  null or empty text: a payload of 576 bytes of 255; repeated rows: a member each
  null doc_id: kept as null; extra columns: ignored; no rows: no rows
  a member that fails all retries: the task fails, naming archive and offset
"""

from __future__ import annotations

import hashlib
import struct
import time
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.llm.common import chunks, materialise, ship, table, work_path

WIDTH = 576
MAGIC = b"PLMEDIA1"
HEADER = "<8sqBQII"  # magic, id, id is null, media bytes, width, crc32 of the media
HEADER_SIZE = struct.calcsize(HEADER)
ENTRY, ENTRY_SIZE = "<QQ", 16
MEDIA_SCHEMA = "doc_id long, media binary"
DIGEST_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def filesystem(path: str):
    """(pyarrow file system, path in it) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def pad(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8")
    return raw + b"\xff" * (WIDTH - len(raw) % WIDTH if len(raw) % WIDTH or not raw else 0)


def to_png(payload: bytes) -> bytes:
    """The payload as 8-bit grey samples, WIDTH in a row."""
    import numpy as np

    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    plain = np.zeros((len(rows), WIDTH + 1), np.uint8)
    plain[:, 1:] = rows

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(plain.tobytes(), 1)) + chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    import numpy as np

    at, body, width = 8, [], WIDTH
    while at < len(media):
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        if kind == b"IHDR":
            width = struct.unpack(">I", media[at + 8 : at + 12])[0]
        elif kind == b"IDAT":
            body.append(media[at + 8 : at + 8 + n])
        at += n + 12
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(-1, width + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered rows are read here")
    return rows[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Mean and deviation of the samples and a 64-bit hash of where its 64 equal parts lie against the mean."""
    import numpy as np

    x = np.frombuffer(payload, np.uint8).astype(np.float64)
    parts = np.add.reduceat(x, np.arange(64) * len(x) // 64) / np.diff(np.append(np.arange(64) * len(x) // 64, len(x)))
    bits = "".join("1" if p > x.mean() else "0" for p in parts)
    return f"{x.mean():.6f}:{x.std():.6f}:{int(bits, 2):016x}"


def write_archives(docs: DataFrame, path: str) -> DataFrame:
    """Writes docs(doc_id, text) as archives under path; a row (archive, members, bytes) for each."""
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, base = filesystem(path)
        name = f"{base}/a-{task.partitionId():06d}-{task.taskAttemptId()}"
        fs.create_dir(base, recursive=True)
        at = members = 0
        with fs.open_output_stream(name + ".members", buffer_size=1 << 20) as out, fs.open_output_stream(name + ".index", buffer_size=1 << 16) as index:
            for ids, texts in chunks(batches):
                for doc_id, text in zip(ids, texts):
                    media = to_png(pad(text))
                    out.write(struct.pack(HEADER, MAGIC, doc_id or 0, doc_id is None, len(media), WIDTH, zlib.crc32(media)))
                    out.write(media)
                    index.write(struct.pack(ENTRY, at, HEADER_SIZE + len(media)))
                    at += HEADER_SIZE + len(media)
                    members += 1
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([name + ".members"]), pa.array([members], pa.int64()), pa.array([at], pa.int64())], ["archive", "members", "bytes"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "archive string, members long, bytes long")


class Range(InputPartition):
    def __init__(self, archive: str, low: int, high: int):
        self.archive, self.low, self.high = archive, low, high


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.listed = [x for x in options.get("archives", "").split("\n") if x]
        self.manifest = options.get("manifest")
        self.range_bytes = int(options.get("rangebytes", 16 << 20))
        self.batch_bytes = int(options.get("batchbytes", 4 << 20))
        self.retries = int(options.get("retries", 3))

    def partitions(self) -> list[Range]:
        from pyarrow import fs as pafs

        if self.manifest:
            from pyarrow import dataset

            fs, base = filesystem(self.manifest)
            rows = dataset.dataset(base, filesystem=fs, format="parquet").to_table(columns=["archive", "bytes"]).sort_by("archive").to_pydict()
            return [Range(name, low, min(low + self.range_bytes, size)) for name, size in zip(rows["archive"], rows["bytes"]) for low in range(0, size, self.range_bytes)]
        fs, base = filesystem(self.path)
        infos = fs.get_file_info(self.listed) if self.listed else [x for x in fs.get_file_info(pafs.FileSelector(base)) if x.path.endswith(".members")]
        return [Range(i.path, low, min(low + self.range_bytes, i.size)) for i in sorted(infos, key=lambda i: i.path) for low in range(0, i.size, self.range_bytes)]

    def member(self, fs, archive: str, offset: int, length: int, opened: list) -> tuple[int | None, bytes]:
        """One member, read again at its offset up to `retries` times."""
        for attempt in range(self.retries + 1):
            try:
                if not opened:
                    opened.append(fs.open_input_file(archive))
                opened[0].seek(offset)
                raw = opened[0].read(length)
                magic, doc_id, none, n, _, crc = struct.unpack_from(HEADER, raw)
                media = raw[HEADER_SIZE :]
                if magic != MAGIC or len(media) != n or zlib.crc32(media) != crc:
                    raise OSError("damaged member")
                return None if none else doc_id, media
            except (OSError, struct.error) as e:
                opened.clear()
                if attempt == self.retries:
                    raise OSError(f"{archive} at {offset}: {e}") from e
                time.sleep(0.05 * 2**attempt)
        raise AssertionError

    def entries(self, fs, part: Range) -> list[tuple[int, int]]:
        """(offset, length) of the members that start in the range: a binary search in the side file, then one read."""
        name = part.archive.removesuffix(".members") + ".index"
        count = fs.get_file_info(name).size // ENTRY_SIZE
        with fs.open_input_file(name) as f:

            def first_from(offset: int) -> int:
                low, high = 0, count
                while low < high:
                    mid = (low + high) // 2
                    f.seek(mid * ENTRY_SIZE)
                    if struct.unpack(ENTRY, f.read(ENTRY_SIZE))[0] < offset:
                        low = mid + 1
                    else:
                        high = mid
                return low

            a, b = first_from(part.low), first_from(part.high)
            f.seek(a * ENTRY_SIZE)
            return list(struct.iter_unpack(ENTRY, f.read((b - a) * ENTRY_SIZE)))

    def read(self, part: Range) -> Iterator:
        import pyarrow as pa

        fs, _ = filesystem(self.path)
        opened: list = []
        ids, media, size = [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "media"])

        for offset, length in self.entries(fs, part):
            if ids and size + length > self.batch_bytes:
                yield batch()
                ids, media, size = [], [], 0
            doc_id, one = self.member(fs, part.archive, offset, length, opened)
            ids.append(doc_id)
            media.append(one)
            size += length
        if ids:
            yield batch()


class ArchiveMedia(DataSource):
    """spark.read.format("archive_media").option("path", ...): rows (doc_id, media)."""

    @classmethod
    def name(cls) -> str:
        return "archive_media"

    def schema(self) -> str:
        return MEDIA_SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, path: str, archives: list[str] | None = None, **options) -> DataFrame:
    """archives: the names that count, one per writing task, or the option manifest: a table of what write_archives returned; without either all archives of the folder."""
    ship(spark)
    spark.dataSource.register(ArchiveMedia)
    reader = spark.read.format("archive_media").option("path", path)
    if archives is not None:
        reader = reader.option("archives", "\n".join(archives))
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def digests(media: DataFrame) -> DataFrame:
    """Per member: what is read back of it."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for one in batch.column(1):
                m = one.as_py()
                payload = from_png(m)
                rows.append((len(payload.rstrip(b"\xff")), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature(payload)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.mapInArrow(run, DIGEST_SCHEMA)


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "media")
    written = materialise(write_archives(table(spark, sf_dir, "documents"), path), "media-listed")  # one row for each writing task
    if written.isEmpty():
        return spark.createDataFrame([], DIGEST_SCHEMA)
    return digests(read_archives(spark, path, manifest=written.inputFiles()[0].rpartition("/")[0]))
