import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tissueframe.sources import images, mtx, sequences, tables


def test_samplesheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("mpp,sample,image,fastq,grid,roifile,extra\n0.25159999999999999,a,/i.tif,,,,x\n0.22075,b,,/f,/g,,y\n")
    rows = {r.sample: r for r in tables.read_samplesheet(spark, str(path)).collect()}
    assert rows["a"].fastq is None and rows["a"].mpp == 0.2516 and rows["b"].grid == "/g"
    path.write_text("sample,image\na,x\na,y\n")
    with pytest.raises(ValueError):
        tables.read_samplesheet(spark, str(path))


def test_positions_with_and_without_header(spark, tmp_path):
    line = "AAC-1,1,0,2,100,200\n"
    for name, text in (("a", line), ("b", "barcode,in_tissue,array_row,array_col,pxl_row_in_fullres,pxl_col_in_fullres\n" + line)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "tissue_positions.csv").write_text(text)
    rows = tables.read_positions(spark, str(tmp_path / "*")).collect()
    assert sorted((r.sample, r.barcode, r.pxl_col_in_fullres) for r in rows) == [("a", "AAC-1", 200), ("b", "AAC-1", 200)]


def fastq(path, n, opener=open):
    with opener(path, "wt") as f:
        for i in range(n):
            seq = "ACGTN"[i % 5] * (20 + i % 7)
            f.write(f"@read{i} extra\n{seq}\n+\n{'@' + 'I' * (len(seq) - 1)}\n")


@pytest.mark.parametrize("split", [64, 257, 1000, 1 << 20])
def test_fastq_ranges_lose_nothing(spark, tmp_path, split):
    fastq(tmp_path / "x_R2_001.fastq", 200)
    found = sequences.read_fastq(spark, str(tmp_path), split_bytes=split)
    rows = found.collect()
    assert sorted(r.read_id for r in rows) == sorted(f"read{i}" for i in range(200))
    assert {r.mate for r in rows} == {2}
    assert all(len(r.seq) == len(r.qual) and r.qual[0] == "@" for r in rows)


def test_small_fastq_ranges_are_merged(spark, tmp_path, monkeypatch):
    (tmp_path / "sample=s" / "mate=R2").mkdir(parents=True)
    path = tmp_path / "sample=s" / "mate=R2" / "part-0.txt"
    fastq(path, 3000)
    size = path.stat().st_size
    assert len(sequences._ranges([(str(path), size)], 64)) <= sequences.MOST_PARTS < size / 64
    assert [(r.start, r.end) for r in sequences._ranges([("x", 1000)], 400)] == [(0, 400), (400, 800), (800, 1000)]
    rows = sequences.read_fastq(spark, str(tmp_path), split_bytes=64, endings=(".txt",)).collect()
    assert sorted(r.read_id for r in rows) == sorted(f"read{i}" for i in range(3000))
    assert {(r.sample, r.mate) for r in rows} == {("s", 2)}
    # A range reads what it holds and little more, not a megabyte.
    read = []
    system, local = sequences._filesystem(str(path))

    class Seen:
        def open_input_file(self, name):
            self.file = system.open_input_file(name)
            return self

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            chunk = self.file.read(n)
            read.append(len(chunk))
            return chunk

    monkeypatch.setattr(sequences, "_filesystem", lambda _: (Seen(), local))
    assert list(sequences._fastq_records(sequences.FileRange(str(path), 1000, 2000)))
    assert sum(read) <= 1 << 14 < size


def test_gzip_fastq(spark, tmp_path):
    fastq(tmp_path / "x_R1_001.fastq.gz", 50, gzip.open)
    assert sequences.read_fastq(spark, str(tmp_path)).where("mate = 1").count() == 50


@pytest.mark.parametrize("chunk,overlap", [(10, 3), (7, 0), (1000, 4)])
def test_fasta_chunks_keep_every_kmer_once(spark, tmp_path, chunk, overlap):
    seqs = {"one": "ACGTACGGTTAACCGGATATTTACG", "two": "acgtn", "three": "A" * 20}
    with gzip.open(tmp_path / "host.fa.gz", "wt") as f:
        for name, seq in seqs.items():
            f.write(f">{name} note\n" + "\n".join(seq[i : i + 6] for i in range(0, len(seq), 6)) + "\n")
    rows = sequences.read_fasta(spark, str(tmp_path), chunk, overlap).collect()
    k = overlap + 1
    for name, seq in seqs.items():
        pieces = sorted((r.offset, r.seq) for r in rows if r.name == name)
        at = sorted(o + i for o, s in pieces for i in range(len(s) - k + 1))
        assert at == list(range(len(seq) - k + 1))
        assert all(seq.upper()[o : o + len(s)] == s for o, s in pieces)
    assert {r.species for r in rows} == {"host"}


def test_sam_tags(spark, tmp_path):
    line = "r1\t0\tchr1\t7\t60\t5M\t*\t0\t0\tACGTA\tIIIII\tNM:i:0\tCB:Z:AAC-1\tUB:Z:TTT\tGX:Z:ENSG1\n"
    bare = "r2\t4\t*\t0\t0\t*\t*\t0\t0\tACGTA\tIIIII\n"
    (tmp_path / "a.sam").write_text("@HD\tVN:1.6\n" + line + bare)
    rows = {r.read_id: r for r in sequences.read_sam(spark, str(tmp_path / "a.sam")).collect()}
    assert (rows["r1"].pos, rows["r1"].cb, rows["r1"].ub, rows["r1"].gene_id) == (7, "AAC-1", "TTT", "ENSG1")
    assert rows["r2"].chrom is None and rows["r2"].cb is None and rows["r2"].cigar is None


def test_matrix_market_folder(spark, tmp_path):
    folder = tmp_path / "s1"
    folder.mkdir()
    for name, text in (
        ("matrix.mtx.gz", "%%MatrixMarket matrix coordinate integer general\n%note\n2 3 3\n1 1 5\n2 3 3\n1 2 7\n"),
        ("features.tsv.gz", "G1\tname1\nG2\tname2\n"),
        ("barcodes.tsv.gz", "B1\nB2\nB3\n"),
    ):
        with gzip.open(folder / name, "wt") as f:
            f.write(text)
    rows = sorted((r.sample, r.barcode, r.gene_id, r.gene_name, r["count"]) for r in mtx.read_mtx(spark, str(tmp_path)).collect())
    # The entry "2 3 3" reads like the size line and must be kept.
    assert rows == [("s1", "B1", "G1", "name1", 5), ("s1", "B2", "G1", "name1", 7), ("s1", "B3", "G2", "name2", 3)]


def test_written_matrix_is_a_valid_file(spark, tmp_path):
    counts = spark.createDataFrame([("s", "b", "g2", 4), ("s", "a", "g1", 1), ("s", "b", "g1", 2)], "sample string, barcode string, gene_id string, count int")
    mtx.write_mtx(counts, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "matrix.mtx.gz" / "sample=s" / "species=none").glob("part-*.gz"))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in parts).decode().splitlines()
    assert text == [mtx.HEADER, "2 2 3", "1 1 1", "1 2 2", "2 2 4"]


def test_matrix_keeps_names_and_empty_rows(spark, tmp_path):
    counts = spark.createDataFrame([("s", "human", "b1", "g1", 4), ("s", "mouse", "b1", "g1", 5)], "sample string, species string, barcode string, gene_id string, count int")
    genes = spark.createDataFrame([("s", "human", f"g{i:03}", f"name {i}", "T") for i in range(300)], "sample string, species string, gene_id string, gene_name string, gene_type string")
    barcodes = spark.createDataFrame([("s", "human", "b0")], "sample string, species string, barcode string")
    root = str(tmp_path / "out")
    mtx.write_mtx(counts, root, genes, barcodes)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = sorted((r.species, r.barcode, r.gene_id, r["count"]) for r in mtx.read_mtx(spark, root, written=True).collect())
        assert found == [("human", "b1", "g1", 4), ("mouse", "b1", "g1", 5)]
        back = {(r.species, r.gene_id): (r.gene_name, r.gene_type, r.ordinal) for r in mtx.read_mtx_genes(spark, root, written=True).collect()}
        assert len(back) == 302 and back["human", "g007"] == ("name 7", "T", 8) and back["mouse", "g1"] == ("g1", mtx.GENE_TYPE, 1)
        assert [(r.ordinal, r.barcode) for r in mtx.read_mtx_barcodes(spark, root, written=True).where("species = 'human'").orderBy("ordinal").collect()] == [(1, "b0"), (2, "b1")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def png(path, rows):
    raw = b"".join(b"\0" + bytes(v for p in row for v in p) for row in rows)
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", len(rows[0]), len(rows), 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_as_blocks(spark, tmp_path):
    from tissueframe.operators.features import blocks_to_pixels

    folder = tmp_path / "slide1"
    folder.mkdir()
    rows = [[(x * 10, y * 20, 7) for x in range(5)] for y in range(4)]
    png(folder / "thumb.png", rows)
    meta = images.read_image_meta(spark, str(tmp_path / "*")).first()
    assert (meta.sample, meta.width, meta.height, meta.channels) == ("slide1", 5, 4, 3)
    px = blocks_to_pixels(images.read_image_blocks(spark, str(tmp_path / "*"), size=3)).collect()
    assert {(r.x, r.y): (r.r, r.g, r.b) for r in px} == {(x, y): rows[y][x] for x in range(5) for y in range(4)}


def test_images_written_and_read_back(spark, tmp_path):
    from tissueframe.operators.features import blocks_to_pixels, pixels_to_blocks

    # Odd widths need padded rows; cells without a pixel are white.
    cells = [("a", x, y, x * 20, y * 30, 10) for x in range(7) for y in range(5) if (x, y) != (3, 2)] + [("b", 0, 0, 13, 10, 26)]
    px = spark.createDataFrame(cells, "sample string, x int, y int, r int, g int, b int")
    path = str(tmp_path / "slides")
    images.write_images(pixels_to_blocks(px, 4), path)
    meta = {r["sample"]: (r.width, r.height, r.channels) for r in images.read_image_meta(spark, path + "/*").collect()}
    assert meta == {"a": (7, 5, 3), "b": (1, 1, 3)}
    back = {tuple(r) for r in blocks_to_pixels(images.read_image_blocks(spark, path + "/*", size=3)).collect()}
    assert back == set(cells) | {("a", 3, 2, 255, 255, 255)}


def test_publish_keeps_or_replaces(spark, tmp_path):
    a = spark.createDataFrame([("s1", 1), ("s2", 1)], "sample string, v int")
    b = spark.createDataFrame([("s2", 2), ("s3", 2)], "sample string, v int")
    out = str(tmp_path)

    def stored(name):
        return sorted((r.sample, r.v) for r in spark.read.parquet(f"{out}/{name}").collect())

    tables.publish(a, out, "kept", overwrite=False)
    tables.publish(b, out, "kept", overwrite=False)
    assert stored("kept") == [("s1", 1), ("s2", 1), ("s3", 2)]
    tables.publish(a, out, "new")
    tables.publish(b, out, "new")
    assert stored("new") == [("s1", 1), ("s2", 2), ("s3", 2)]


def test_run_record(spark, tmp_path):
    samples = spark.createDataFrame([("a", 0.25)], "sample string, mpp double")
    tables.export_run(spark, {"target_mpp": 0.25}, samples, str(tmp_path))
    assert spark.read.json(str(tmp_path / "parameters")).first().target_mpp == "0.25"
    assert spark.read.json(str(tmp_path / "info")).select(F.col("mpp")).first().mpp == 0.25


def test_fasta_ranges_and_long_lines(spark, tmp_path):
    folder = tmp_path / "human"
    folder.mkdir()
    contigs = {f"c{i}": "".join("ACGT"[(i * k + k // 5) % 4] for k in range(n)) for i, n in enumerate((0, 1, 90, 1000, 2_500_000))}
    with open(folder / "g.fa", "w") as f:
        for i, (name, text) in enumerate(contigs.items()):
            width = 60 if i == 3 else max(1, len(text))
            f.write(f">{name} note\r\n" + "".join(text[a : a + width] + "\n" for a in range(0, len(text), width)))
    for split in (1 << 30, 50, 700):
        if split == 50:
            (folder / "g.fa").write_text((folder / "g.fa").read_text().split(">c4")[0])
            del contigs["c4"]
        chunks = sequences.read_fasta(spark, str(folder), chunk=300, overlap=4, split_bytes=split).collect()
        for name, text in contigs.items():
            own = sorted((c.offset, c.seq) for c in chunks if c.name == name)
            assert all(text[a : a + len(s)] == s and len(s) <= 304 for a, s in own)
            assert "".join(s[:300] if a + len(s) < len(text) else s for a, s in own) == text
    assert {c.species for c in chunks} == {"human"}


def test_many_folders_are_written_by_several_tasks(spark, tmp_path):
    info = spark.range(40).coalesce(1).selectExpr("concat('S', id) AS sample", "CAST(id AS INT) AS x", "CAST(7 AS INT) AS y")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    tables.write_grid_info(info, str(tmp_path / "grid"))
    files = [f.name for f in (tmp_path / "grid").rglob("part-*.json")]
    assert len(files) == 40 and len({f.split("-")[1] for f in files}) > 1
    found = {(r["sample"], r.x, r.y) for r in tables.read_grid_info(spark, str(tmp_path / "grid")).collect()}
    assert found == {(f"S{i}", i, 7) for i in range(40)}
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    tables.export_run(spark, {"a": 1}, info, str(tmp_path / "run"))
    assert len({f.name.split("-")[1] for f in (tmp_path / "run" / "info").rglob("part-*.txt")}) > 1


def test_dimensions_of_a_matrix_are_several_parts(spark, tmp_path):
    """A large dimension table is neither written by one task nor read as one row; its lines are numbered over all parts."""
    rows = [(s, f"b{i % 37:02}", f"g{i:04}", 1 + i % 5) for s in ("s", "t") for i in range(900)]
    counts = spark.createDataFrame(rows, "sample string, barcode string, gene_id string, count int")
    root = str(tmp_path / "out")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mtx.write_mtx(counts, root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = sorted((tmp_path / "out" / "features.tsv.gz" / "sample=s" / "species=none").glob("part-*.gz"))
    assert len(parts) > 1
    text = b"".join(gzip.decompress(p.read_bytes()) for p in parts).decode().splitlines()
    assert [line.split("\t")[0] for line in text] == [f"g{i:04}" for i in range(900)]
    genes = mtx.read_mtx_genes(spark, root, written=True)
    assert sorted((r.sample, r.ordinal, r.gene_id) for r in genes.collect()) == [(s, i + 1, f"g{i:04}") for s in ("s", "t") for i in range(900)]
    assert "wholetext" not in genes._jdf.queryExecution().toString() and "Generate" not in genes._jdf.queryExecution().toString()
    found = mtx.read_mtx(spark, root, written=True)
    assert sorted((r.sample, r.barcode, r.gene_id, r["count"]) for r in found.collect()) == sorted(rows)


def test_lines_of_plain_dimension_files_are_numbered_over_blocks(spark, tmp_path):
    for sample, ending in (("s1", "\n"), ("s2", "\r\n")):
        (tmp_path / sample).mkdir()
        (tmp_path / sample / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n300 1 1\n300 1 5\n")
        (tmp_path / sample / "features.tsv").write_bytes("".join(f"G{i}\tn{i}{ending}" if i != 4 else ending for i in range(1, 301)).encode())
        (tmp_path / sample / "barcodes.tsv").write_bytes(f"B1{ending}".encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        genes = mtx.read_mtx_genes(spark, str(tmp_path)).collect()
        found = mtx.read_mtx(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.sample, r.ordinal, r.gene_id) for r in genes) == [(s, i, f"G{i}") for s in ("s1", "s2") for i in range(1, 301) if i != 4]
    assert sorted((r.sample, r.barcode, r.gene_id, r["count"]) for r in found) == [(s, "B1", "G300", 5) for s in ("s1", "s2")]
