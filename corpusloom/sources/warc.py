"""Gzipped WARC archives as rows.

Two ways to find records, with one schema:

``length``     records are framed by ``Content-Length``, exact for any body;
               archives are split at gzip members, so one archive feeds many
               tasks; a task holds one record at a time.
``separator``  the text source cuts where a version line follows two line ends;
               all work stays in the JVM and it also works under
               ``readStream``.  A body that holds this is cut in two, which
               ``framing`` reports.

Any version of the format is read.  Records without a usable length are handed
on with ``framing`` ``bad``.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.staging import stage

VERSION = "WARC/"
GAP = "\r\n\r\n"
BATCH_BYTES = 16 << 20
SPLIT_BYTES = 64 << 20


def read_manifests(spark: SparkSession, manifests: str, folder: str = "warcfiles") -> list[str]:
    """Archive paths named by manifests.

    ``manifests`` lists text files separated by ``;``.  Each names one archive
    per line, found in ``folder`` beside the manifest.
    """
    named = [m.strip() for m in manifests.split(";") if m.strip()]
    if not named:
        return []
    lines = spark.read.text(named).where(F.trim("value") != "")
    base = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    rows = lines.select(F.concat(base, F.lit(f"/{folder}/"), F.trim("value")).alias("path"))
    return sorted(row.path for row in rows.collect())  # one name for each archive


def _header(block: Column, name: str) -> Column:
    found = F.regexp_extract(block, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.nullif(F.rtrim(found), F.lit(""))


def parse_records(raw: DataFrame, check: bool = False, warc_type: str | None = None) -> DataFrame:
    """``doc_id, uri, content_type, payload`` of raw records in ``value``.

    With ``check`` a column ``framing`` compares ``Content-Length`` with the
    bytes found: ``ok``, ``mismatch``, ``bad`` where there is no usable length,
    or ``unknown`` where decoding replaced bytes.  Any record type passes unless ``warc_type`` names one.
    """
    head = F.substring_index("value", GAP, 1)
    parts = raw.where(F.length("value") > 0).select(
        F.col("file"), F.col("value"), head.alias("head"),
        F.substr("value", F.length(head) + len(GAP) + 1).alias("body"),
    )
    # The last record of a file keeps the line ends behind it.
    said = _header(F.col("head"), "Content-Length").try_cast("long")
    whole = F.coalesce(said == F.octet_length("body"), F.lit(False))
    body = F.when(
        F.endswith("body", F.lit(GAP)) & ~whole, F.left("body", F.length("body") - len(GAP))
    ).otherwise(F.col("body"))
    parts = parts.withColumn("body", body)
    if warc_type:
        parts = parts.where(F.lower(_header(F.col("head"), "WARC-Type")) == warc_type)
    http = F.when(F.startswith("body", F.lit("HTTP/")), F.substring_index("body", GAP, 1))
    parts = parts.withColumn("http", http)
    payload = F.when(
        F.col("http").isNotNull(), F.substr("body", F.length("http") + len(GAP) + 1)
    ).otherwise(F.col("body"))
    record = _header(F.col("head"), "WARC-Record-ID")
    fallback = F.sha2(F.concat("file", "value"), 256)
    columns = [
        F.coalesce(F.regexp_replace(record, r"^<urn:uuid:|[<>]", ""), fallback).alias("doc_id"),
        F.coalesce(_header(F.col("head"), "WARC-Target-URI"), F.lit("Unknown")).alias("uri"),
        F.coalesce(_header(F.col("http"), "Content-Type"), F.lit("unknown")).alias("content_type"),
        F.regexp_replace(payload, "\r\n?", "\n").alias("payload"),
    ]
    if check:
        columns.append(
            F.when(said.isNull(), "bad").when(F.contains("body", F.lit("�")), "unknown")
            .when(said == F.octet_length("body"), "ok").otherwise("mismatch").alias("framing")
        )
    return parts.select(*columns)


def separator_records(reader, paths) -> DataFrame:
    """Raw records from ``spark.read`` or ``spark.readStream`` by version line."""
    raw = reader.option("lineSep", GAP + VERSION).text(paths)
    # Cut by position: a pattern over the value would replace bytes that are no text.
    line = F.substring_index("value", "\r\n", 1)
    rest = F.when(line.rlike(rf"^(?:{VERSION})?[0-9.]+[ \t]*$"), F.substr("value", F.length(line) + 3))
    return raw.select(F.coalesce(rest, "value").alias("value"), F.col("_metadata.file_path").alias("file"))


#: Schemes of Hadoop's file systems and pyarrow's names for the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gs": "gs", "hdfs": "hdfs"}


def _raw(path: str):
    """The compressed bytes of an archive, seekable."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + re.sub(r"^file:/+", "", path)
    scheme, sep, rest = path.partition("://")
    if sep and scheme in SCHEMES:
        path = f"{SCHEMES[scheme]}://{rest}"
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _open(path: str):
    return gzip.GzipFile(fileobj=_raw(path))


def framed_at(stream) -> Iterator[tuple[int, str]]:
    """``(offset, record)``: decoded records of a stream cut by ``Content-Length``, and where each begins.

    ``stream`` needs ``readline``, ``read`` and ``tell``.
    """
    held, at = b"", 0
    while True:
        if not held:
            at = stream.tell()
        line = held or stream.readline()
        if not line:
            return
        held = b""
        if not line.startswith(b"WARC/"):
            continue
        head, length = b"", None
        while (row := stream.readline()).strip():
            head += row
            name, _, value = row.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                length = int(value)
        if length is None:
            # Without a length the record ends where the next one begins.
            body = b""
            while True:
                next_at = stream.tell()
                row = stream.readline()
                if not row or (row.startswith(b"WARC/") and body.endswith(b"\r\n\r\n")):
                    break
                body += row
            yield at, (head.rstrip() + b"\r\n\r\n" + body.removesuffix(b"\r\n\r\n") + b"\r\n\r\n").decode("utf-8", "replace")
            held, at = row, next_at
            continue
        body = stream.read(length)
        yield at, (head.rstrip() + b"\r\n\r\n" + body + b"\r\n\r\n").decode("utf-8", "replace")


def framed(stream) -> Iterator[str]:
    """Decoded records of one archive, cut by ``Content-Length``."""
    for _, record in framed_at(io.BufferedReader(_Counted(stream))):
        yield record


class _Counted(io.RawIOBase):
    """A readable stream that knows how many bytes it has given."""

    def __init__(self, inner):
        self.inner, self.at = inner, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.inner.read(len(buffer))
        buffer[:len(data)] = data
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at


class Members(io.RawIOBase):
    """Gzip members decompressed one after the other from a compressed offset on.

    ``starts`` holds ``(decompressed offset, compressed offset)`` of each member
    begun so far, so a record's position tells the member it begins in.
    """

    def __init__(self, raw, offset: int):
        self.raw, self.offset, self.at = raw, offset, 0
        self.starts = [(0, offset)]
        self.unzip, self.pending = zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer) -> int:
        while True:
            if self.unzip.eof:
                rest = self.unzip.unused_data
                self.unzip = zlib.decompressobj(31)
                self.pending = rest + self.pending
                self.starts.append((self.at, self.offset - len(self.pending)))
            if not self.pending:
                self.pending = self.raw.read(1 << 20)
                self.offset += len(self.pending)
                if not self.pending:
                    return 0
            data = self.unzip.decompress(self.pending, len(buffer))
            self.pending = self.unzip.unconsumed_tail
            if data:
                buffer[:len(data)] = data
                self.at += len(data)
                return len(data)

    def member_of(self, at: int) -> int:
        """Compressed offset of the member holding decompressed offset ``at``."""
        return self.starts[bisect_right(self.starts, (at, float("inf"))) - 1][1]


def member_offsets(raw) -> Iterator[tuple[int, int]]:
    """``(offset, length)`` of every gzip member of a compressed stream; output is not kept."""
    start = pos = 0
    unzip, buf = zlib.decompressobj(31), b""
    while True:
        if not buf:
            buf = raw.read(1 << 20)
            if not buf:
                break
        before = len(buf)
        unzip.decompress(buf, 1 << 16)
        if unzip.eof:
            rest = unzip.unused_data
            pos += before - len(rest)
            yield start, pos - start
            start, unzip, buf = pos, zlib.decompressobj(31), rest
        else:
            buf = unzip.unconsumed_tail
            pos += before - len(buf)
    if pos > start:
        yield start, pos - start  # a member cut short is read as far as it goes


def _splits_of_files(batches: Iterator[pd.DataFrame], split_bytes: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["file"]:
            starts, ends, first = [], [], None
            with _raw(path) as raw:
                for offset, length in member_offsets(raw):
                    first = offset if first is None else first
                    if offset + length - first >= split_bytes:
                        starts.append(first)
                        ends.append(offset + length)
                        first = None
            if first is not None:
                starts.append(first)
                ends.append(2**62)
            elif ends:
                ends[-1] = 2**62
            yield pd.DataFrame({"file": path, "start": starts, "end": ends})


def _split_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records that begin in members of ``[start, end)``; the last may read on into later members."""
    for batch in batches:
        for path, start, end in zip(batch["file"], batch["start"], batch["end"], strict=True):
            held, size = [], 0
            with _raw(path) as raw:
                raw.seek(start)
                members = Members(raw, start)
                for at, value in framed_at(io.BufferedReader(members, 1 << 16)):
                    if members.member_of(at) >= end:
                        break
                    held.append(value)
                    size += len(value)
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame({"value": held, "file": path})
                        held, size = [], 0
            if held:
                yield pd.DataFrame({"value": held, "file": path})


def length_records(spark: SparkSession, paths: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw records by ``Content-Length``, in splits of about ``split_bytes`` compressed bytes.

    A first pass finds the gzip members of every archive (one task per archive,
    decompressing without keeping anything) and groups consecutive members into
    splits; the splits are then read by as many tasks, each seeking to its first
    member.  A split owns the records that begin in its members, so records
    that span members are read whole once.  Archives of one gzip member are one
    split.  Folders and globs are listed by Spark; archives are opened by
    pyarrow, with ``s3a``/``s3n`` read as ``s3`` and ``abfss`` as ``abfs``.
    """
    spark_files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))
    names = sorted(row.file for row in spark_files.collect())  # one name for each archive
    if not names:
        return spark.createDataFrame([], "value string, file string")
    files = spark.createDataFrame([(n,) for n in names], "file string").repartition(len(names))
    splits = stage(files.mapInPandas(partial(_splits_of_files, split_bytes=split_bytes), "file string, start bigint, end bigint"), "warc-splits")
    count = splits.count()
    return splits.repartition(max(1, count)).mapInPandas(_split_records, "value string, file string")


def read_warc(
    spark: SparkSession,
    paths: str | list[str],
    framing: str = "length",
    check: bool = False,
    warc_type: str | None = None,
) -> DataFrame:
    """``doc_id, uri, content_type, payload``: one row per record.

    With ``length`` framing archives are read in splits of gzip members; the
    ``separator`` form reads one archive in one task.
    """
    if framing == "length":
        raw = length_records(spark, [paths] if isinstance(paths, str) else list(paths))
    elif framing == "separator":
        raw = separator_records(spark.read, paths)
    else:
        raise ValueError("framing is 'separator' or 'length'")
    return parse_records(raw, check, warc_type)


def _whole_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield from _split_records(iter([pd.DataFrame({"file": batch["file"], "start": 0, "end": 2**62})]))


def read_warc_stream(
    spark: SparkSession, path: str, max_files: int = 1000, check: bool = False, framing: str = "length"
) -> DataFrame:
    """The same rows as a stream over a folder of archives.

    With ``length`` framing the stream carries the paths of new archives only
    (Spark's binary file source, its content column pruned), and tasks frame
    each archive by ``Content-Length`` as the batch form does, exactly for any
    body; an archive is read by one task.  ``separator`` keeps all work in the JVM.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if framing == "separator":
        return parse_records(separator_records(reader, path), check)
    if framing != "length":
        raise ValueError("framing is 'separator' or 'length'")
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = reader.format("binaryFile").schema(schema).load(path).select(F.col("path").alias("file"))
    return parse_records(files.mapInPandas(_whole_files, "value string, file string"), check)
