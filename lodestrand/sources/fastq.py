"""FASTQ as a Spark data source: ``spark.read.format("fastq").load(path)``.

Records may run over several lines; a file (gz too) is one partition, read as
a stream.  Plain files whose records have four lines can be read in ranges:
the option ``splitBytes`` says how many bytes are read at once; a partition
takes such ranges of a file one after the other, TASK_BYTES at most (or one range).  Columns:
file, number (from 0 in the file; in ranges, a growing number), name, comment,
seq and qual (null for FASTA records).  A quality of another length than its sequence
is an error.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


#: Bytes of a file that a task reads, if its ranges are smaller: a task costs as much as reading them.
TASK_BYTES = 1 << 21


def parse(lines: Iterator[str]) -> Iterator[tuple[str, str, str, str | None]]:
    """(name, comment, seq, qual) of FASTA and FASTQ records."""
    line = next(lines, None)
    while line is not None:
        head = line.rstrip("\r\n")
        if not head or head[0] not in ">@":
            line = next(lines, None)
            continue
        seq, quality = [], None
        line = next(lines, None)
        while line is not None and line[0] not in ">@+":
            seq.append(line.strip())
            line = next(lines, None)
        bases = "".join(seq)
        if line is not None and line[0] == "+":
            quality = ""
            while len(quality) < len(bases) and (line := next(lines, None)) is not None:
                quality += line.rstrip("\r\n")
            if len(quality) != len(bases):
                raise ValueError(f"quality and sequence of {head} differ in length")
            line = next(lines, None)
        name, _, comment = head[1:].replace("\t", " ").partition(" ")
        yield name, comment, bases, quality


class FilePart(InputPartition):
    def __init__(self, path: str, start: int = 0, end: int | None = None) -> None:
        self.path, self.start, self.end = path, start, end


def _first_record(raw, start: int, size: int) -> int:
    """Where the first four-line record at or behind start begins (size, where none does)."""
    raw.seek(max(0, start - 1))
    if start and raw.read(1) != b"\n":
        raw.readline()
    ahead: list[tuple[int, bytes]] = []
    while True:
        while len(ahead) < 4:
            at, line = raw.tell(), raw.readline()
            if not line:
                return size
            ahead.append((at, line.rstrip(b"\r\n")))
        (at, head), (_, seq), (_, plus), (_, qual) = ahead[:4]
        # a quality line may begin with @ as well, but is not followed by a sequence, + and as long a quality
        if head[:1] == b"@" and plus[:1] == b"+" and len(seq) == len(qual):
            return at
        ahead.pop(0)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.where, self.bytes = options["path"], int(options.get("splitbytes", options.get("splitBytes", 0)))

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.where) if "://" in self.where else (pafs.LocalFileSystem(), self.where)

    def partitions(self) -> list[FilePart]:
        fs, path = self._fs()
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.Directory:
            found = sorted((f for f in fs.get_file_info(pafs.FileSelector(path)) if f.type == pafs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)
        else:
            found = [info]
        parts = []
        for f in found:
            step = self.bytes if self.bytes and not f.path.endswith(".gz") else 0
            whole = max(1, TASK_BYTES // step) * step if step else 0
            parts += [FilePart(f.path, at, at + whole) for at in range(0, f.size, whole)] if step else [FilePart(f.path)]
        return parts

    def _records(self, part: FilePart) -> Iterator[tuple[int, tuple]]:
        fs = self._fs()[0]
        if part.end is not None:
            with fs.open_input_file(part.path) as file:
                size, raw = file.size(), io.BufferedReader(file)
                last = min(part.end, size)
                at = _first_record(raw, part.start, size)
                for start in range(part.start, last, self.bytes):
                    stop = min(start + self.bytes, last)
                    # a record that is longer than a range leaves the ranges behind it empty
                    end = size if stop >= size else at if stop <= at else _first_record(raw, stop, size)
                    raw.seek(at)
                    # numbers grow with the place in the file
                    for n, record in enumerate(parse(iter(raw.read(end - at).decode("utf-8").splitlines(keepends=True)))):
                        yield start + n, record
                    at = end
            return
        with fs.open_input_stream(part.path, compression=None) as raw:
            stream = gzip.open(raw) if part.path.endswith(".gz") else io.BufferedReader(raw)
            yield from enumerate(parse(iter(io.TextIOWrapper(stream, "utf-8"))))

    def read(self, part: FilePart) -> Iterator[pa.RecordBatch]:
        records = self._records(part)
        while rows := list(islice(records, 8_192)):
            names, comments, seqs, quals = zip(*(r for _, r in rows))
            columns = [[part.path] * len(rows), [n for n, _ in rows], names, comments, seqs, quals]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), *[pa.string()] * 4))], names=["file", "number", "name", "comment", "seq", "qual"])


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "file string, number long, name string, comment string, seq string, qual string"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)
