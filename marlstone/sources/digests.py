"""Digests of line-oriented files of any size, computed in one streamed pass.

Files are read split by split from any store that Spark reads; the lines of one source (a file, or a
folder whose files follow each other by name) meet in one task in their order, because SHA-256 has to
see them so. The task sorts with spilling and holds one batch of lines, so a source may be larger
than any memory, and many sources are digested side by side. Lines are bytes until they are hashed:
what is no UTF-8 still has a digest of its bytes, but none of its text.

Spark's reader drops a byte order mark at the beginning of a file. Such a source has null digests,
which equal no expected checksum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COLUMNS = {"source_uri": pa.string(), "sha256": pa.string(), "literal_sha256": pa.string(), "size_bytes": pa.int64(), "line_count": pa.int64()}
_DDL = "source_uri string, sha256 string, literal_sha256 string, size_bytes long, line_count long"

#: Digests of a source without a byte, for which the reader gives no line.
EMPTY = {"sha256": hashlib.sha256(b"").hexdigest(), "literal_sha256": hashlib.sha256(b'""').hexdigest(), "size_bytes": 0, "line_count": 0}


class _Running:
    """The hashes of one source, as far as its lines have come."""

    def __init__(self, source: str) -> None:
        self.source, self.path, self.left = source, None, 0
        self.bytes, self.literal = hashlib.sha256(), hashlib.sha256(b'"')
        self.size = self.lines = 0
        self.whole = self.is_text = True

    def _put(self, data: bytes) -> None:
        self.bytes.update(data)
        self.size += len(data)
        self.left -= len(data)
        try:
            self.literal.update(encode_basestring(data.decode())[1:-1].encode())
        except UnicodeDecodeError:
            self.is_text = False

    def line(self, path: str, file_size: int, data: bytes) -> None:
        if path == self.path:
            self._put(b"\n")
        else:
            self._end_file()
            self.path, self.left = path, file_size
        self._put(data)
        self.lines += 1

    def _end_file(self) -> None:
        """A line feed after a file's last line isn't among the lines; the file's size tells of it."""
        if self.path is not None and self.left == 1:
            self._put(b"\n")
        self.whole &= self.left == 0

    def row(self) -> tuple:
        self._end_file()
        self.literal.update(b'"')
        return (self.source, self.bytes.hexdigest() if self.whole else None, self.literal.hexdigest() if self.whole and self.is_text else None, self.size, self.lines)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Running | None = None
    for batch in batches:
        done = []
        for source, path, size, data in zip(*(batch.column(c).to_pylist() for c in ("source_uri", "path", "size", "line"))):
            if now is None or now.source != source:
                if now is not None:
                    done.append(now.row())
                now = _Running(source)
            now.line(path, size, data)
        if done:
            yield _batch(done)
    if now is not None:
        yield _batch([now.row()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _COLUMNS.values())], names=list(_COLUMNS))


def digests(spark: SparkSession, *paths: str, by_folder: bool = False) -> DataFrame:
    """(source_uri, sha256, literal_sha256, size_bytes, line_count) of files, or of folders of files.

    ``literal_sha256`` is that of the whole text as a JSON string literal, the checksum that manifests
    declare. Sources without a byte give no row (see ``EMPTY``); a path that isn't there is Spark's error.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("line"),
    )
    source = F.regexp_replace("path", "/[^/]*$", "") if by_folder else F.col("path")
    dealt = lines.withColumn("source_uri", source).repartition("source_uri").sortWithinPartitions("source_uri", "path", "block", "place")
    return dealt.select("source_uri", "path", "size", "line").mapInArrow(_digested, _DDL)


def differing(spark: SparkSession, expected: dict[str, str]) -> DataFrame:
    """(source_uri, want, got) of files whose literal's checksum isn't the one expected for their whole path."""
    from marlstone.sources.sinks import qualified

    want = spark.createDataFrame([(qualified(spark, p), c.removeprefix("sha256:")) for p, c in expected.items()], "source_uri string, want string")
    found = digests(spark, *expected).select("source_uri", F.coalesce("literal_sha256", F.lit("unreadable")).alias("got"))
    met = want.join(found, "source_uri", "left").withColumn("got", F.coalesce("got", F.lit(EMPTY["literal_sha256"])))
    return met.where("want <> got")
