"""Record files as a Spark sink: ``df.write.format("records").option("layout", "fastq").mode("append").save(path)``.

Each task writes files of its own under ``path/_temporary/<write>/``, named by
partition and attempt, and reports them; the driver's commit moves the reported
ones to ``path`` and puts ``_SUCCESS`` beside them.  What a failed or doubled
attempt wrote was never reported and goes with the temporary folder, as does
all of an aborted write, so readers see a write as a whole or not at all
(``overwrite`` deletes the files that were there when the new ones are moved).

Options: ``layout`` (fastq, fasta, sam, vcf, lines), ``codec`` (none, gzip),
``width`` (bases of a FASTA line; 0: one line), ``header`` (text that begins
every file), ``split`` (a column; each of its values has files of its own, the
value in their names, and is not written).  Layouts take the columns of the
same names: fastq name, seq and qual; fasta name and seq; sam and vcf their
fields in order (a column ``tags`` of sam holds a map, one of vcf is missing),
lines ``value``.  Nulls are * in SAM, . in VCF and empty elsewhere.
"""

from __future__ import annotations

import gzip
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

# The fields of a SAM and of a VCF line, in order.
SAM_FIELDS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
VCF_FIELDS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample"]
ENDINGS = {"fastq": "fastq", "fasta": "fasta", "sam": "sam", "vcf": "vcf", "lines": "txt"}


def opened(where: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(where) if "://" in where or where.startswith("file:") else (pafs.LocalFileSystem(), where)


def _text(batch: pa.RecordBatch, name: str, null: str = "") -> pa.Array:
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.string()), null)


def _fields(batch: pa.RecordBatch, names: list[str], null: str) -> list[pa.Array]:
    return [_text(batch, n, null) for n in names if n in batch.schema.names]


def lines_of(batch: pa.RecordBatch, layout: str, width: int = 0) -> list[str]:
    """The text of each row, line breaks at its end included."""
    if layout == "fasta":
        names, seqs = _text(batch, "name").to_pylist(), _text(batch, "seq").to_pylist()
        step = [width or max(1, len(s)) for s in seqs]
        return [f">{n}\n" + "".join(f"{s[i : i + w]}\n" for i in range(0, len(s), w)) for n, s, w in zip(names, seqs, step)]
    if layout == "fastq":
        name, seq, qual = (_text(batch, c) for c in ("name", "seq", "qual"))
        joined = pc.binary_join_element_wise(pc.binary_join_element_wise("@", name, ""), seq, "+", qual, "\n")
    elif layout == "lines":
        joined = _text(batch, "value")
    else:
        cells = _fields(batch, *((SAM_FIELDS, "*") if layout == "sam" else (VCF_FIELDS, ".")))
        joined = pc.binary_join_element_wise(*cells, "\t")
        if layout == "sam" and "tags" in batch.schema.names:
            tags = batch.column(batch.schema.get_field_index("tags")).to_pylist()
            return [line + "".join(f"\t{k}:Z:{v}" for k, v in sorted(t or ())) + "\n" for line, t in zip(joined.to_pylist(), tags)]
    return pc.binary_join_element_wise(joined, "", "\n").to_pylist()


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    rows: int = 0


class _Sink:
    """One file that is being written."""

    def __init__(self, fs: pafs.FileSystem, path: str, gz: bool, header: str) -> None:
        self.raw = fs.open_output_stream(path, compression=None)
        self.out = gzip.GzipFile(filename="", fileobj=self.raw, mode="wb", mtime=0) if gz else self.raw
        if header:
            self.write(header if header.endswith("\n") else header + "\n")

    def write(self, text: str) -> None:
        self.out.write(text.encode())

    def close(self) -> None:
        if self.out is not self.raw:
            self.out.close()
        self.raw.close()


class RecordWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        held = {k.lower(): v for k, v in options.items()}
        self.where, self.overwrite, self.id = held["path"], overwrite, uuid.uuid4().hex
        self.layout, self.width, self.header, self.split = held.get("layout", "lines"), int(held.get("width", 0)), held.get("header", ""), held.get("split")
        self.gz = {"none": False, "gzip": True}[held.get("codec", "none")]
        if self.layout not in ENDINGS:
            raise ValueError(f"no layout {self.layout}; there are {', '.join(ENDINGS)}")
        self.temporary = posixpath.join("_temporary", self.id)

    def _folder(self, *below: str) -> tuple[pafs.FileSystem, str]:
        fs, path = opened(self.where)
        return fs, posixpath.join(path, *below)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        fs, folder = self._folder(self.temporary)
        fs.create_dir(folder, recursive=True)
        sinks, said = {}, Written()
        stem = f"part-{task.partitionId():05}-{task.taskAttemptId()}-{self.id[:8]}"
        for b in batches:
            if not len(b):
                continue
            said.rows += len(b)
            keys = _text(b, self.split, "none").to_pylist() if self.split else [""] * len(b)
            texts: dict[str, list[str]] = {}
            for key, line in zip(keys, lines_of(b, self.layout, self.width)):
                texts.setdefault(key, []).append(line)
            for key, lines in texts.items():
                if key not in sinks:
                    name = f"{stem}{f'_{key}' if self.split else ''}.{ENDINGS[self.layout]}{'.gz' if self.gz else ''}"
                    said.files.append(name)
                    sinks[key] = _Sink(fs, posixpath.join(folder, name), self.gz, self.header)
                sinks[key].write("".join(lines))
        for sink in sinks.values():
            sink.close()
        return said

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = self._folder()
        fs.create_dir(folder, recursive=True)
        if self.overwrite:
            for old in fs.get_file_info(pafs.FileSelector(folder)):
                if old.type == pafs.FileType.File:
                    fs.delete_file(old.path)
        for m in messages:
            for name in m.files if m else ():
                fs.move(posixpath.join(folder, self.temporary, name), posixpath.join(folder, name))
        self._clear(fs, folder)
        with fs.open_output_stream(posixpath.join(folder, "_SUCCESS")):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*self._folder())

    def _clear(self, fs: pafs.FileSystem, folder: str) -> None:
        mine, others = posixpath.join(folder, self.temporary), posixpath.join(folder, "_temporary")
        if fs.get_file_info(mine).type == pafs.FileType.Directory:
            fs.delete_dir(mine)
        if fs.get_file_info(others).type == pafs.FileType.Directory and not fs.get_file_info(pafs.FileSelector(others)):
            fs.delete_dir(others)


class RecordSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "records"

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordSink)
