"""FASTQ, FASTA and SAM readers."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tissueframe.functions.scalar import mate_of_path, sample_of_path, species_of_path

SPLIT_BYTES = 64 << 20
#: Partitions into which small ranges of files are cut at most; neighbours are read as one beyond it.
MOST_PARTS = 1024
#: Bytes that are read at once, and by a range no more than it holds, but for its last record.
READ_BYTES = 1 << 20
BATCH_ROWS = 10_000


class FileRange(InputPartition):
    """Records that start in ``[start, end)`` of a file; ``end`` None is the file's end."""

    def __init__(self, path: str, start: int = 0, end: int | None = None):
        self.path, self.start, self.end = path, start, end


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(path: str, endings: tuple[str, ...]) -> list:
    """Files at or below ``path`` with one of the endings, with their sizes."""
    from pyarrow import fs

    system, local = _filesystem(path)
    info = system.get_file_info(local)
    prefix = path[: len(path) - len(local)] if path.endswith(local) else ""
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(local, recursive=True))
    return sorted(
        ((prefix + f.path, f.size) for f in found if f.is_file and f.path.endswith(endings)), key=lambda f: f[0]
    )


def _ranges(files: list, split: int) -> list[FileRange]:
    """One range per compressed file, several per large plain file.

    Ranges of ``split`` bytes grow up to :data:`SPLIT_BYTES` where there would be more than :data:`MOST_PARTS`.
    """
    out = []
    plain = sum(size for path, size in files if not path.endswith(".gz"))
    split = max(split, min(SPLIT_BYTES, -(-plain // MOST_PARTS)))
    for path, size in files:
        if path.endswith(".gz") or size <= split:
            out.append(FileRange(path))
        else:
            edges = list(range(0, size, split)) + [size]
            out += [FileRange(path, a, b) for a, b in zip(edges, edges[1:])]
    return out


def _lines_from(path: str, start: int, end: int | None = None) -> Iterator[tuple[int, str]]:
    """Lines with their byte offset, from the first whole line at or after ``start``; beyond ``end`` little is read at once."""
    system, local = _filesystem(path)
    if path.endswith(".gz"):
        stream = system.open_input_stream(local, compression="gzip")
        offset = 0
    else:
        stream = system.open_input_file(local)
        offset = max(0, start - 1)
        stream.seek(offset)
    with stream:
        rest = b""
        skip = start > 0
        left = READ_BYTES if end is None else end - start
        while True:
            chunk = stream.read(max(1 << 14, min(READ_BYTES, left)))
            if not chunk:
                break
            left = READ_BYTES if end is None else left - len(chunk)
            parts = (rest + chunk).split(b"\n")
            rest = parts.pop()
            for line in parts:
                if not skip:
                    yield offset, line.rstrip(b"\r").decode()
                skip = False
                offset += len(line) + 1
        if rest and not skip:
            yield offset, rest.rstrip(b"\r").decode()


def _fasta_pieces(part: FileRange) -> Iterator[tuple[str | None, bytes]]:
    """Headers ``(text, b"")`` and stretches of sequence ``(None, bytes)`` of the contigs that begin in a range.

    A sequence line is handed on as it is read, however long it is.
    """
    system, local = _filesystem(part.path)
    packed = part.path.endswith(".gz")
    stream = system.open_input_stream(local, compression="gzip") if packed else system.open_input_file(local)
    offset = 0 if packed else max(0, part.start - 1)
    if offset:
        stream.seek(offset)
    mode, fresh, header = "skip", part.start == 0, b""
    with stream:
        while chunk := stream.read(1 << 20):
            at = 0
            while at < len(chunk):
                if fresh:
                    fresh = False
                    if chunk[at : at + 1] == b">":
                        if part.end is not None and offset + at >= part.end:
                            return
                        mode, header = "head", b""
                    elif mode == "head":
                        mode = "seq"
                stop = chunk.find(b"\n", at)
                piece = chunk[at : stop if stop >= 0 else len(chunk)]
                if mode == "head":
                    header += piece
                elif mode == "seq":
                    yield None, piece.replace(b"\r", b"")
                if stop < 0:
                    break
                if mode == "head":
                    yield header[1:].decode().rstrip("\r"), b""
                at, fresh = stop + 1, True
            offset += len(chunk)
    if mode == "head" and not fresh:
        yield header[1:].decode().rstrip("\r"), b""


def _fastq_records(part: FileRange) -> Iterator[tuple[str, str, str]]:
    """Four-line records of a range; a range inside a file finds its first record."""
    window: list[tuple[int, str]] = []
    synced = part.start == 0
    for item in _lines_from(part.path, part.start, part.end):
        window.append(item)
        if len(window) < 4:
            continue
        head, seq, plus, qual = (text for _, text in window)
        # A quality line may start with @, but a sequence never with +.
        whole = head.startswith("@") and plus.startswith("+") and len(seq) == len(qual)
        if not synced and not whole:
            window.pop(0)
            continue
        if part.end is not None and window[0][0] >= part.end:
            return
        if not whole:
            raise ValueError(f"broken FASTQ record in {part.path} at byte {window[0][0]}")
        synced = True
        yield head[1:], seq, qual
        window = []


# File name endings of the two formats; each may be followed by .gz.
FASTQ_ENDINGS = (".fastq", ".fq")
FASTA_ENDINGS = (".fa", ".fna", ".fasta")


def _endings(options, usual: tuple[str, ...]) -> tuple[str, ...]:
    listed = options.get("endings")
    plain = tuple(listed.split(",")) if listed else usual
    return plain + tuple(f"{e}.gz" for e in plain)


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.endings = _endings(options, FASTQ_ENDINGS)
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self):
        return _ranges(_files(self.path, self.endings), self.split)

    def read(self, partition):
        import pyarrow as pa

        columns: tuple[list, list, list, list] = ([], [], [], [])
        names = ["path", "read_id", "seq", "qual"]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)

        for head, seq, qual in _fastq_records(partition):
            for column, value in zip(columns, (partition.path, head.split(" ")[0], seq, qual)):
                column.append(value)
            if len(columns[0]) == BATCH_ROWS:
                yield batch()
                columns = ([], [], [], [])
        if columns[0]:
            yield batch()


class FastqSource(DataSource):
    """``spark.read.format("fastq")``: plain or gzip FASTQ files below a path."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "path string, read_id string, seq string, qual string"

    def reader(self, schema):
        return FastqReader(self.options)


class FastaReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.endings = _endings(options, FASTA_ENDINGS)
        self.chunk = int(options.get("chunk", 100_000))
        self.overlap = int(options.get("overlap", 0))
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self):
        return _ranges(_files(self.path, self.endings), self.split)

    def read(self, partition):
        import pyarrow as pa

        names = ["path", "name", "offset", "seq"]
        step, keep = self.chunk, self.overlap

        def batch(name, offset, seq):
            arrays = [pa.array([partition.path]), pa.array([name]), pa.array([offset], pa.int64()), pa.array([seq])]
            return pa.RecordBatch.from_arrays(arrays, names)

        decode = codecs.getincrementaldecoder("utf-8")().decode
        name, held, size, offset = None, [], 0, 0
        for head, piece in _fasta_pieces(partition):
            if head is not None:
                if size > (keep if offset else 0):
                    yield batch(name, offset, "".join(held))
                name, held, size, offset = head.split(" ")[0], [], 0, 0
                continue
            held.append(decode(piece))
            size += len(held[-1])
            if size < step + keep:
                continue
            text, at = "".join(held), 0
            while len(text) - at >= step + keep:
                yield batch(name, offset, text[at : at + step + keep])
                at, offset = at + step, offset + step
            held, size = [text[at:]], len(text) - at
        if size > (keep if offset else 0):
            yield batch(name, offset, "".join(held))


class FastaSource(DataSource):
    """``spark.read.format("fasta")``: contigs in chunks of ``chunk`` letters.

    Neighbouring chunks share ``overlap`` letters (``k - 1`` for k-mers), so no
    row is as long as a chromosome and no k-mer is lost or doubled.
    """

    @classmethod
    def name(cls):
        return "fasta"

    def schema(self):
        return "path string, name string, offset bigint, seq string"

    def reader(self, schema):
        return FastaReader(self.options)


def read_fastq(
    spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, endings: tuple[str, ...] = FASTQ_ENDINGS
) -> DataFrame:
    """Reads ``sample, mate, read_id, seq, qual``; mate and sample come from the path."""
    spark.dataSource.register(FastqSource)
    raw = spark.read.format("fastq").option("splitbytes", str(split_bytes)).option("endings", ",".join(endings)).load(path)
    return raw.select(
        sample_of_path(F.col("path")).alias("sample"), mate_of_path(F.col("path")).alias("mate"), "read_id", "seq", "qual"
    )


def read_fasta(
    spark: SparkSession,
    path: str,
    chunk: int = 100_000,
    overlap: int = 0,
    endings: tuple[str, ...] = FASTA_ENDINGS,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Contig chunks ``species, name, offset, seq`` with ACGTN in upper case.

    Plain files are cut into ranges; a contig is read by the range it begins in.
    """
    spark.dataSource.register(FastaSource)
    options = {"chunk": str(chunk), "overlap": str(overlap), "endings": ",".join(endings), "splitbytes": str(split_bytes)}
    raw = spark.read.format("fasta").options(**options).load(path)
    species = F.coalesce(F.nullif(F.regexp_extract("path", "(host|graft)", 1), F.lit("")), species_of_path(F.col("path")))
    return raw.select(species.alias("species"), "name", "offset", F.translate("seq", "acgtn", "ACGTN").alias("seq"))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Exon and intron intervals ``species, chrom, start, end, kind, gene_id, strand`` of GTF text.

    Intervals are half open on one-based positions, as alignments count them.
    Introns are the gaps between consecutive exons of a transcript; an interval
    that several transcripts of a gene share comes once. Species is in the path.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    field = F.split("value", "\t")

    def attribute(name):
        return F.nullif(F.regexp_extract("value", rf'{name} "([^"]+)"', 1), F.lit(""))

    exons = lines.where(field[2] == "exon").select(
        species_of_path(F.col("_metadata.file_path")).alias("species"), field[0].alias("chrom"), field[3].cast("long").alias("start"),
        (field[4].cast("long") + 1).alias("end"), attribute("gene_id").alias("gene_id"), field[6].alias("strand"),
        attribute("transcript_id").alias("_transcript"),
    )
    # A transcript has few exons, so its window is small.
    after = Window.partitionBy("species", "chrom", "strand", "gene_id", "_transcript").orderBy("start", "end")
    gaps = exons.withColumn("_next", F.lead("start").over(after)).where(F.col("_next") > F.col("end"))
    names = ["species", "chrom", "start", "end", "kind", "gene_id", "strand"]
    introns = gaps.withColumns({"start": F.col("end"), "end": F.col("_next"), "kind": F.lit("intron")}).select(*names)
    return exons.withColumn("kind", F.lit("exon")).select(*names).unionByName(introns).distinct()


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text with cell, molecule and gene tags; ``*`` is NULL."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    field = F.split("value", "\t")

    def tag(name):
        return F.nullif(F.regexp_extract("value", rf"\t{name}:Z:([^\t]+)", 1), F.lit(""))

    def text(i):
        return F.nullif(field[i], F.lit("*"))

    where = F.col("_metadata.file_path")
    return lines.select(
        sample_of_path(where).alias("sample"),
        species_of_path(where).alias("species"),
        field[0].alias("read_id"),
        text(2).alias("chrom"),
        field[3].cast("long").alias("pos"),
        field[4].cast("int").alias("mapq"),
        text(5).alias("cigar"),
        text(9).alias("seq"),
        text(10).alias("qual"),
        tag("CB").alias("cb"),
        tag("UB").alias("ub"),
        tag("GX").alias("gene_id"),
    )
