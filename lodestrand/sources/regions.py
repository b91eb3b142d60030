"""FASTA files with an index of offsets, so that a region is a few bytes and not a scan.

``build_index`` scans the files once, in byte ranges that each are a task: a
range reports the lines that begin in it as stretches (header, first byte,
bases, width of a line), and stretches of one record are summed up by the place of its
header.  Only where a range begins within a record its header is looked up, in a
table of one row a range.

``fetch`` joins regions with the index, turns them into byte ranges by
arithmetic, deals them to tasks in file order and reads just these bytes; its
column ``bytes`` counts them.  ``spark.read.format("fasta_regions")`` does the same for
a list of regions in an option, from a ``.fai`` file beside the FASTA file.

Defined results: a region is cut to its sequence; one of an unknown name or
outside of its sequence has no row; sequences of lines of different widths (the
last aside) are read whole and then cut; line breaks may be \\n or \\r\\n;
compressed files are an error.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lodestrand.operators.work import keep
from lodestrand.sources.text import write_table
from lodestrand.sources.writers import opened

#: Bytes of a range that one task scans, and of ranges that one task fetches.
SPLIT_BYTES, FETCH_BYTES = 64 << 20, 64 << 20
_STRETCH = "file string, part long, header long, name string, first long, bases long, lines long, line_bases long, line_width long, even boolean, short boolean, last long"


def files_of(path: str) -> list[pafs.FileInfo]:
    fs, where = opened(path)
    info = fs.get_file_info(where)
    if info.type != pafs.FileType.Directory:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(where))
    return sorted((f for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", "."))), key=lambda f: f.path)


class _Stretch:
    """Lines of bases that stand together under one header (or none in this range)."""

    def __init__(self, header: int | None, name: str | None, first: int) -> None:
        self.header, self.name, self.first, self.last = header, name, first, first
        self.bases, self.lines, self.line_bases, self.line_width, self.even, self.short = 0, 0, 0, 0, True, False

    def add(self, at: int, line: bytes) -> None:
        n = len(line.rstrip(b"\r\n"))
        self.last = at + len(line)
        if not n:
            return
        if not self.lines:
            self.first, self.line_bases, self.line_width = at, n, len(line)
        else:
            # a line after a shorter one, one longer than the first, or one that does not begin where the first line's width says, breaks the order
            self.even &= not self.short and n <= self.line_bases and at == self.first + self.lines * self.line_width
            self.short |= n < self.line_bases
        self.lines, self.bases = self.lines + 1, self.bases + n


def _scan(where: str, path: str, start: int, end: int) -> Iterator[_Stretch]:
    fs = opened(where)[0]
    with fs.open_input_file(path) as file:
        raw = io.BufferedReader(file, 1 << 20)
        at = start
        if start:
            raw.seek(start - 1)
            at = start - 1 + len(raw.readline())  # the line that begins before belongs to the range before
        raw.seek(at)
        now = _Stretch(None, None, at)
        while at < end and (line := raw.readline()):
            if line[:1] == b">":
                if now.name is not None or now.lines:
                    yield now
                words = line[1:].split()
                now = _Stretch(at, words[0].decode("utf-8", "replace") if words else "", at + len(line))
            else:
                now.add(at, line)
            at += len(line)
        if now.name is not None or now.lines:
            yield now


def build_index(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, name, length, offset, line_bases, line_width, even and end (behind the last byte) of every sequence of the files at path."""
    found = files_of(path)
    for f in found:
        if f.path.endswith((".gz", ".bz2", ".zst")):
            raise ValueError(f"{f.path} is compressed and has no places to jump to")
    ranges = [(f.path, at, min(at + split_bytes, f.size)) for f in found for at in range(0, f.size, split_bytes)]
    given = spark.createDataFrame(ranges, "file string, start long, stop long")
    given = given.repartition(max(1, min(len(ranges), 10_000)), "file", "start") if ranges else given

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows = [(r["file"], r["start"], s.header, s.name, s.first, s.bases, s.lines, s.line_bases, s.line_width, s.even, s.short, s.last) for s in _scan(path, r["file"], r["start"], r["stop"])]
                yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, row)) for row in rows], schema=_ARROW)

    # a row for each record or range, far smaller than the files
    seen = keep(given.mapInArrow(run, _STRETCH), "stretches")
    order = Window.partitionBy("file").orderBy("part")
    heads = given.select("file", F.col("start").alias("part")).join(seen.groupBy("file", "part").agg(F.max("header").alias("_last")), ["file", "part"], "left")
    before = heads.select("file", "part", F.last("_last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    whole = seen.join(before, ["file", "part"]).withColumn("header", F.coalesce("header", "_before")).where("header is not null")
    same = Window.partitionBy("file", "header").orderBy("part")
    # across ranges, too, only the last line may be shorter, and lines must be of one width and follow each other
    goes_on = (F.lag(F.col("first") + F.col("lines") * F.col("line_width")).over(same) == F.col("first")) & ~F.lag("short").over(same)
    alike = (F.lag("line_bases").over(same) == F.col("line_bases")) & (F.lag("line_width").over(same) == F.col("line_width"))
    tail = (F.col("lines") == 1) & F.lead("lines").over(same).isNull() & (F.lag("line_bases").over(same) >= F.col("line_bases"))
    follows = F.lag("lines").over(same).isNull() | F.coalesce(goes_on & (alike | tail), F.lit(False))
    real = whole.where("lines > 0").withColumn("_ok", F.col("even") & follows)
    names = whole.where("name is not null").select("file", "header", "name", F.col("first").alias("_start"), F.col("last").alias("_stop"))
    sums = real.groupBy("file", "header").agg(
        F.sum("bases").alias("length"), F.min("first").alias("offset"), F.min_by("line_bases", "part").alias("line_bases"), F.min_by("line_width", "part").alias("line_width"), F.min("_ok").alias("even"), F.max("last").alias("end")
    )
    out = names.join(sums, ["file", "header"], "left")
    none = F.lit(0).cast("long")
    return out.select("file", "name", F.coalesce("length", none).alias("length"), F.coalesce("offset", "_start").alias("offset"), F.coalesce("line_bases", none).alias("line_bases"), F.coalesce("line_width", none).alias("line_width"), F.coalesce("even", F.lit(True)).alias("even"), F.coalesce("end", "_stop").alias("end"))


_ARROW = pa.schema([("file", pa.string()), ("part", pa.int64()), ("header", pa.int64()), ("name", pa.string()), *[(n, pa.int64()) for n in ("first", "bases", "lines", "line_bases", "line_width")], ("even", pa.bool_()), ("short", pa.bool_()), ("last", pa.int64())])
_NAMES = _ARROW.names


def _place(at: F.Column) -> F.Column:
    """The byte of a base of an evenly broken sequence."""
    return F.col("offset") + F.floor(at / F.col("line_bases")) * F.col("line_width") + at % F.col("line_bases")


def byte_ranges(index: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of regions(name, start, end; half-open, from 0) that meet a sequence, with file, from and until (bytes) and cut (bases to leave out before)."""
    held = regions.join(index, "name").withColumn("start", F.greatest(F.col("start").cast("long"), F.lit(0))).withColumn("end_", F.least(F.col("end").cast("long"), F.col("length")))
    held = held.where("start < end_")
    first, last = _place(F.col("start")), _place(F.col("end_") - 1) + 1
    return held.select(*[c for c in regions.columns if c not in ("start", "end")], "start", F.col("end_").alias("end"), "file", F.when(F.col("even"), first).otherwise(F.col("offset")).cast("long").alias("from"), F.when(F.col("even"), last).otherwise(F.col("_stop")).cast("long").alias("until"), F.when(F.col("even"), 0).otherwise(F.col("start")).cast("long").alias("cut"))


def fetch(index: DataFrame, regions: DataFrame, path: str, task_bytes: int = FETCH_BYTES) -> DataFrame:
    """regions' columns with start and end as cut to their sequence, seq, and bytes (how many were read for it)."""
    wanted = byte_ranges(index.withColumnRenamed("end", "_stop"), regions)
    total = wanted.agg(F.sum(F.col("until") - F.col("from"))).first()[0] or 0
    tasks = int(max(1, min(10_000, -(-total // task_bytes))))
    dealt = wanted.repartitionByRange(tasks, "file", "from").sortWithinPartitions("file", "from")
    schema = dealt.drop("file", "from", "until", "cut").schema.add("seq", "string").add("bytes", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, name, file = opened(path)[0], None, None
        for b in batches:
            seqs, sizes = [], []
            for f, start, stop, cut, at, end in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("file", "from", "until", "cut", "start", "end"))):
                if f != name:
                    if file:
                        file.close()
                    name, file = f, fs.open_input_file(f)
                file.seek(start)
                text = file.read(stop - start).translate(None, b"\r\n")
                sizes.append(stop - start)
                seqs.append(text[cut : cut + end - at].decode("utf-8", "replace"))
            kept = [c for c in b.schema.names if c not in ("file", "from", "until", "cut")]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in kept], pa.array(seqs, pa.string()), pa.array(sizes, pa.int64())], names=[*kept, "seq", "bytes"])
        if file:
            file.close()

    return dealt.mapInArrow(run, schema)


def write_fai(index: DataFrame, path: str) -> None:
    """The index of one file as the five columns of a .fai file, in the order of the file."""
    uneven = index.where("not even").select("name").first()
    if uneven:
        raise ValueError(f"lines of {uneven.name} differ in width")
    write_table(index.orderBy("offset").select("name", "length", "offset", "line_bases", "line_width"), path)


# ------------------------------------------------------ few regions by option


class RegionPart(InputPartition):
    def __init__(self, regions: list[tuple[str, int, int, int, int]]) -> None:
        self.regions = regions  # name, start, end, first byte, behind the last byte


def parse_region(text: str) -> tuple[str, int, int | None]:
    """name, start (from 0) and end of ``name``, ``name:from`` or ``name:from-to`` (from 1, to included)."""
    name, _, span = text.rpartition(":")
    low, _, high = span.replace(",", "").partition("-")
    if not name or not low.isdigit() or high and not high.isdigit():
        return text, 0, None
    return name, int(low) - 1, int(high) if high else None


class RegionReader(DataSourceReader):
    """``regions`` (separated by blanks) of the FASTA file at ``path``, by the index at ``index`` (default: path with .fai behind)."""

    def __init__(self, options: dict) -> None:
        held = {k.lower(): v for k, v in options.items()}
        self.path, self.regions = held["path"], held.get("regions", "").split()
        self.index, self.bytes = held.get("index", self.path + ".fai"), int(held.get("taskbytes", FETCH_BYTES))

    def partitions(self) -> list[RegionPart]:
        wanted: dict[str, list[tuple[int, int | None]]] = {}
        for r in self.regions:
            name, start, end = parse_region(r)
            wanted.setdefault(name, []).append((start, end))
        spans = []
        for f in files_of(self.index):
            with opened(self.index)[0].open_input_stream(f.path) as raw:  # line by line; only wanted ones are held
                for line in io.TextIOWrapper(io.BufferedReader(raw), "utf-8"):
                    name, length, offset, bases, width = line.rstrip("\n").split("\t")[:5]
                    for start, end in wanted.get(name, ()):
                        start, stop = max(0, start), min(int(length), int(length) if end is None else end)
                        if start < stop:
                            place = lambda p, o=int(offset), b=int(bases), w=int(width): o + p // b * w + p % b
                            spans.append((name, start, stop, place(start), place(stop - 1) + 1))
        parts, size = [[]], 0
        for s in sorted(spans, key=lambda s: s[3]):
            if parts[-1] and size + s[4] - s[3] > self.bytes:
                parts.append([])
                size = 0
            parts[-1].append(s)
            size += s[4] - s[3]
        return [RegionPart(p) for p in parts]

    def read(self, part: RegionPart) -> Iterator[tuple[str, int, int, str]]:
        if not part.regions:
            return
        fs, path = opened(self.path)
        with fs.open_input_file(path) as file:
            for name, start, end, first, last in part.regions:
                file.seek(first)
                yield name, start, end, file.read(last - first).translate(None, b"\r\n").decode("utf-8", "replace")


class RegionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta_regions"

    def schema(self) -> str:
        return "name string, start long, end long, seq string"

    def reader(self, schema) -> RegionReader:
        return RegionReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RegionSource)
