"""Integrity of landed compressed files: decoded to the end, with each
member's checksum and length held against its trailer.

A file cut short or damaged in the middle decodes to some lines before it
fails, and a tolerant scan would count those and say nothing. Here every
compressed file is decoded in one task (gzip cannot be split), a piece at a
time. Files up to ``IN_ROW_BYTES`` travel as one row each; a larger one is
read by Spark's own decoder in a job of its own, which checks the trailer as
well, so no file is too large to be checked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IN_ROW_BYTES = 128 << 20
PIECE = 1 << 20

#: What is wrong with a file.
EMPTY = "empty file, no gzip header"
NOT_GZIP = "not a gzip file"
CUT = "cut before the end of member %d"
DAMAGED = "damaged data in member %d"
CHECKSUM = "wrong checksum in member %d"
LENGTH = "wrong length in member %d"
TRAILING = "bytes behind member %d that are no member"

RESULT = "members int, content_bytes long, error string"


def check_gzip(data: bytes) -> tuple[int, int, str | None]:
    """Complete members, decoded bytes and the error (None: sound) of a gzip
    file. Zero bytes behind the last member are padding."""
    if not data:
        return 0, 0, EMPTY
    members, decoded, at = 0, 0, 0
    while at < len(data):
        if data[at:at + 2] != b"\x1f\x8b"[:len(data) - at]:
            rest = data[at:].strip(b"\0")
            return members, decoded, None if members and not rest else TRAILING % members if members else NOT_GZIP
        decoder = zlib.decompressobj(wbits=31)
        try:
            while at < len(data) and not decoder.eof:
                piece = data[at:at + PIECE]
                decoded += len(decoder.decompress(piece))
                at += len(piece) - len(decoder.unused_data)
            if not decoder.eof:
                return members, decoded, CUT % (members + 1)
        except zlib.error as failure:
            what = CHECKSUM if "data check" in str(failure) else LENGTH if "length check" in str(failure) else DAMAGED
            return members, decoded, what % (members + 1)
        members += 1
    return members, decoded, None


def check_files(spark: SparkSession, files: DataFrame, in_row_bytes: int = IN_ROW_BYTES) -> DataFrame:
    """``path, members, content_bytes, error`` of listed gzip files
    (``path, length``). Of a file above ``in_row_bytes`` the error is Spark's
    own, and members and content_bytes are NULL."""
    listed = files.select("path", "length").collect()
    small = [r["path"] for r in listed if r["length"] <= in_row_bytes]
    large = [(r["path"], None, None, _read_error(spark, r["path"])) for r in listed if r["length"] > in_row_bytes]
    out = spark.createDataFrame(large, f"path string, {RESULT}")
    if not small:
        return out

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame([check_gzip(bytes(x)) for x in frame["content"]], columns=["members", "content_bytes", "error"])
            yield found.assign(path=frame["path"].to_numpy())

    whole = spark.read.format("binaryFile").load(small).select("path", "content")
    return out.unionByName(whole.mapInPandas(apply, f"path string, {RESULT}"))


def _read_error(spark: SparkSession, path: str) -> str | None:
    """The innermost error of decoding a whole file with Spark."""
    try:
        spark.read.text(path).select(F.sum(F.length("value"))).collect()
    except Py4JJavaError as failure:
        cause = failure.java_exception
        while cause.getCause() is not None:
            cause = cause.getCause()
        return str(cause.getMessage() or cause.toString()).splitlines()[0]
    except PySparkException as failure:
        return str(failure).splitlines()[0]
    return None
