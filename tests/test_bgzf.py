"""Block-compressed files: ranges cut lines as the whole file has them, parts
are one valid file, the index finds what a filter finds."""

import glob
import gzip
import os
import random

import numpy as np
import pytest

from varlake.sources import bgzf
from varlake.sources.bgzf import bins_of, bins_over, read_bgzf, read_region, write_vcf
from varlake.sources.vcf import header_lines, read_vcf, vcf_records, vcf_schema

HEAD = ['##fileformat=VCFv4.2', '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
        "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "S1"])]


def blocks_of(data, sizes):
    out, at = [], 0
    while at < len(data):
        n = next(sizes)
        out.append(bgzf.block(data[at:at + n]))
        at += n
    return b"".join(out) + bgzf.END_BLOCK


def range_lines(path, split):
    size = os.path.getsize(path)
    out = []
    for begin in range(0, size, split):
        with bgzf.open_store(path) as handle:
            for batch in bgzf._batches("f", bgzf._range_lines(handle, size, begin, begin + split)):
                out += batch["line"].to_pylist()
    return out


def test_ranges_give_every_line_once(tmp_path):
    rng = random.Random(4)
    path = str(tmp_path / "x.gz")
    for _ in range(60):
        lines = ["".join(rng.choice("abc\t") for _ in range(rng.choice([1, 3, 40, 300])))
                 for _ in range(rng.randrange(0, 60))]
        text = "".join(x + rng.choice(["\n", "\n", "\r\n"]) for x in lines).encode()
        if text and rng.random() < 0.5:
            text = text[:-1]
        most = rng.choice([1, 2, 7, 60, 500])
        data = blocks_of(text, iter(lambda: rng.randrange(1, most + 1), 0))
        with open(path, "wb") as f:
            f.write(data)
        assert gzip.decompress(data) == text
        assert range_lines(path, rng.choice([29, 100, 1000, 1 << 20])) == lines


def test_blocks_are_found_behind_data_that_looks_like_one(tmp_path):
    """Stored (uncompressed) blocks that hold the bytes of a block's head."""
    import struct
    import zlib
    fake = bgzf._MAGIC + b"\x00" * 4 + b"\x00\xff" + bgzf._EXTRA + struct.pack("<H", 40)
    path, lines = str(tmp_path / "x.gz"), []
    with open(path, "wb") as f:
        for i in range(300):
            data = fake.replace(b"\n", b"") + b"%d\n" % i
            lines.append(data[:-1])
            deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
            body = deflate.compress(data) + deflate.flush()
            f.write(bgzf._MAGIC + b"\x00" * 4 + b"\x00\xff" + bgzf._EXTRA
                    + struct.pack("<H", len(body) + 25) + body
                    + struct.pack("<II", zlib.crc32(data), len(data)))
        f.write(bgzf.END_BLOCK)
    size = os.path.getsize(path)
    got = []
    for begin in range(0, size, 101):
        with bgzf.open_store(path) as handle:
            got += b"".join(bgzf._range_lines(handle, size, begin, begin + 101)).split(b"\n")[:-1]
    assert got == lines


def test_a_wrong_checksum_is_an_error(tmp_path):
    data = bytearray(bgzf.block(b"a line\n" * 500) + bgzf.END_BLOCK)
    data[len(data) - len(bgzf.END_BLOCK) - 8] ^= 1
    path = tmp_path / "x.gz"
    path.write_bytes(bytes(data))
    with pytest.raises(OSError, match="checksum"):
        range_lines(str(path), 1 << 20)


def _records(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        chrom = rng.choice(["chr1", "chr2", "chr10", "chrX", "chrUn_1"])
        ref = "A" * rng.choice([1, 1, 1, 2, 40, 30_000 if i % 500 == 0 else 3])
        rows.append("\t".join([chrom, str(rng.randrange(1, 3_000_000)), f"id{i}", ref, "C", "50", "PASS",
                               f"QD={rng.random():.6f}", "GT", "0/1"]))
    return rows


@pytest.fixture(scope="module")
def written_vcf(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("vcf"))
    rows = _records(8000)
    with open(f"{at}/in.vcf", "w") as f:
        f.write("\n".join(HEAD + rows) + "\n")
    write_vcf(vcf_records(read_vcf(spark, f"{at}/in.vcf")), HEAD, f"{at}/out", partitions=5)
    return at, rows


def test_parts_are_one_sorted_file(written_vcf):
    at, rows = written_vcf
    parts = sorted(glob.glob(f"{at}/out/*"))
    assert [os.path.basename(p) for p in parts] == [f"part-{i:06d}.vcf.gz" for i in range(7)]
    whole = b"".join(open(p, "rb").read() for p in parts)
    text = gzip.decompress(whole).decode().splitlines()
    assert text[:3] == HEAD and sorted(text[3:]) == sorted(rows) and whole.endswith(bgzf.END_BLOCK)
    order = {"chr1": 1, "chr2": 2, "chr10": 10, "chrX": 23, "chrUn_1": 30}
    place = [(order[r.split("\t")[0]], int(r.split("\t")[1])) for r in text[3:]]
    assert place == sorted(place)
    assert not glob.glob(f"{at}/out.staging*")


def test_one_file_is_read_by_many_tasks(spark, written_vcf, tmp_path):
    at, rows = written_vcf
    path = str(tmp_path / "one.vcf.gz")
    with open(path, "wb") as out:
        for p in sorted(glob.glob(f"{at}/out/*")):
            out.write(open(p, "rb").read())
    df = read_bgzf(spark, path, split_bytes=8_000)
    assert df.rdd.getNumPartitions() > 5
    assert sorted(r["line"] for r in df.collect()) == sorted(HEAD + rows)
    assert header_lines(df).count() == 3 and vcf_schema(df).sample_list == ["S1"]
    plain = str(tmp_path / "plain.vcf.gz")
    with gzip.open(plain, "wb") as out:
        out.write("\n".join(HEAD + rows).encode())
    df = read_bgzf(spark, [plain, path], split_bytes=8_000)
    counts = {r["file"].rsplit("/", 1)[1]: r["count"] for r in df.groupBy("file").count().collect()}
    assert counts == {"plain.vcf.gz": len(rows) + 3, "one.vcf.gz": len(rows) + 3}
    assert read_bgzf(spark, plain, split_bytes=8_000).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("contig,begin,end", [
    ("chr1", 1, 3_000_000), ("chr2", 500_000, 500_400), ("chr10", 16_384, 16_385), ("chrX", 1, 1),
    ("chr1", 1_000_000, 1_200_000), ("chrUn_1", 2_990_000, 9_000_000), ("chr7", 1, 1_000_000)])
def test_the_index_finds_what_a_filter_finds(spark, written_vcf, contig, begin, end):
    at, rows = written_vcf
    want = []
    for r in rows:
        chrom, pos, _, ref, *_ = r.split("\t")
        if chrom == contig and int(pos) <= end and int(pos) + len(ref) > begin:
            want.append(r.split("\t")[2])
    got = read_region(spark, f"{at}/out", contig, begin, end)
    assert sorted(r["ID"] for r in got.collect()) == sorted(want)
    if contig == "chr2":  # few blocks of the whole
        from varlake.sources.bgzf import _INDEX
        chunks = spark.read.schema(_INDEX).parquet(f"{at}/out.index/rows").where("bin IS NOT NULL")
        assert chunks.count() > 100


def test_bins_hold_their_intervals():
    rng = np.random.default_rng(3)
    begin = rng.integers(0, 1 << 29, 2000)
    end = np.minimum(begin + rng.integers(1, 1 << 24, 2000), 1 << 29)
    end[:1000] = begin[:1000] + 1
    for b, x, y in zip(bins_of(begin, end).tolist(), begin.tolist(), end.tolist()):
        assert any(lo <= b <= hi for lo, hi in bins_over(x, y))
    assert bins_of(np.array([0, 16384]), np.array([16384, 16385])).tolist() == [4681, 4682]
    assert bins_of(np.array([0]), np.array([1 << 29])).tolist() == [0]


def test_a_written_folder_is_not_overwritten_and_may_be_empty(spark, written_vcf, tmp_path):
    at, _ = written_vcf
    none = vcf_records(read_vcf(spark, f"{at}/in.vcf")).where("false")
    with pytest.raises(FileExistsError):
        write_vcf(none, HEAD, f"{at}/out")
    path = str(tmp_path / "empty")
    write_vcf(none, HEAD, path)
    assert gzip.decompress(b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{path}/*")))
                           ).decode().splitlines() == HEAD
    assert read_region(spark, path, "chr1", 1, 10).count() == 0


def test_many_short_ranges_share_tasks(tmp_path):
    """However many ranges, no more tasks than the bound; every line is read once."""
    import json

    from varlake.sources import bgzf

    text = b"".join(b"line %d of the file\n" % i for i in range(40_000))
    path = tmp_path / "a.vcf.gz"
    path.write_bytes(b"".join(bgzf.block(text[i:i + 5_000]) for i in range(0, len(text), 5_000)) + bgzf.END_BLOCK)
    reader = bgzf.BgzfReader({"files": json.dumps([[str(path), path.stat().st_size]]), "splitbytes": "50"})
    partitions = reader.partitions()
    ranges = [r for p in partitions for r in (p.ranges if isinstance(p, bgzf.BlockRanges) else [p])]
    assert len(ranges) > bgzf.MOST_TASKS >= len(partitions) > 100
    assert [r.begin for r in ranges] == list(range(0, path.stat().st_size, 50))
    lines = [line for p in partitions for batch in reader.read(p) for line in batch["line"].to_pylist()]
    assert lines == text.decode().splitlines()


def test_part_writer_looks_at_runs_of_records():
    """the index is made a run of records at a time, as record by record."""
    import io

    import numpy as np
    import pyarrow as pa

    from varlake.sources.bgzf import WINDOW_BITS, _PartWriter, bins_of

    class Counted(dict):
        asked = 0

        def setdefault(self, *a):
            self.asked += 1
            return super().setdefault(*a)

    rng = np.random.default_rng(3)
    contig = ["chr1"] * 3000 + ["chr2"] * 1000 + ["chr1"] * 5 + [None] * 3
    begin = np.concatenate([np.sort(rng.integers(0, 90_000, 3000)), np.sort(rng.integers(0, 90_000, 1000)),
                            [0, 1, 2, 3, 4, 0, 0, 0]])
    end = begin + np.where(rng.random(len(begin)) < 0.01, 40_000, 1)
    texts = ["x" * int(n) for n in rng.integers(0, 50, len(begin))]
    out = _PartWriter(io.BytesIO())
    out.windows = Counted()
    for a in range(0, len(begin), 700):
        out.add(pa.array(texts[a:a + 700]), contig[a:a + 700], begin[a:a + 700], end[a:a + 700])
    chunks, windows, at, bins = [], {}, 0, bins_of(begin, end)
    for i, name in enumerate(contig):
        upto = at + len(texts[i]) + 1
        if chunks and chunks[-1][:2] == [name, bins[i]]:
            chunks[-1][3] = upto
        else:
            chunks.append([name, bins[i], at, upto])
        for w in range(int(begin[i]) >> WINDOW_BITS, (int(end[i]) - 1 >> WINDOW_BITS) + 1):
            windows.setdefault((name, w), at)
        at = upto
    assert out.chunks == chunks and out.windows == windows and out.text == at
    assert out.windows.asked < 400
