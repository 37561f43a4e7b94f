"""Block-compressed text: read in parallel, VCF files written in parallel.

BGZF is gzip cut into blocks of at most 64 KB, each of which says how long it
is.  Reading (:func:`read_bgzf`) is a Python data source whose partitions are
byte ranges of the files.  A task looks for the first block at or after its
range's begin, inflates the blocks that begin in its range, and cuts lines as
the text source does: a line belongs to the range in which it begins, so a task
skips to its first line end and reads on to the one after its range.  A plain
gzip file has no blocks and is one range.

Writing (:func:`write_vcf`) gives a folder of part files in chromosome order:
the header, the sorted records of a task each, and the empty block that ends a
BGZF file.  Every part is made of whole blocks, so the bytes of all parts, one
after the other, are one valid ``.vcf.gz``; nothing has to pass one task for that.
A position index comes with it, as a table beside the folder: per contig and
bin of the usual binning scheme the places of its records, and per 16 kb window
the first place with a record that overlaps it.  :func:`read_region` reads the
blocks that the index names.

Tasks open files through ``pyarrow.fs`` and need this package.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from varlake.functions.keys import chromosome_rank, strip_chr, to_long
from varlake.sources.vcf import FIXED_FIELDS, open_store, vcf_records

SPLIT_BYTES = 16 << 20  # compressed bytes that one task reads
BLOCK = 65_280  # text bytes of a written block
WINDOW_BITS = 14  # windows of the linear index: 16 kb
BATCH_LINES = 16_384
MOST_TASKS = 1_000  # of one read; more ranges share tasks

# The first bytes of a BGZF block, and the empty block that ends
# a file.
_MAGIC = b"\x1f\x8b\x08\x04"
_EXTRA = b"\x06\x00BC\x02\x00"
END_BLOCK = (b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00\x1b\x00\x03\x00"
             b"\x00\x00\x00\x00\x00\x00\x00\x00")
_HEAD = 18  # bytes before a block's data
_LONGEST = 1 << 16


def block(data: bytes) -> bytes:
    """One BGZF block of at most ``BLOCK`` bytes of text."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = len(body) + _HEAD + 8
    return (_MAGIC + b"\x00\x00\x00\x00\x00\xff" + _EXTRA + struct.pack("<H", size - 1) + body
            + struct.pack("<II", zlib.crc32(data), len(data)))


def block_size(head: bytes) -> int | None:
    """Bytes of the block that begins with ``head``; None if none does."""
    if len(head) < _HEAD or head[:4] != _MAGIC or head[10:16] != _EXTRA:
        return None
    return struct.unpack("<H", head[16:18])[0] + 1


def _inflated(data: bytes) -> bytes:
    out = zlib.decompress(data[_HEAD:-8], -15)
    if zlib.crc32(out) != struct.unpack("<I", data[-8:-4])[0]:
        raise OSError("a BGZF block's checksum is wrong")
    return out


class _Blocks:
    """The blocks of a file from a byte on."""

    def __init__(self, handle, at: int, size: int):
        self.handle, self.at, self.size = handle, at, size
        self.held, self.held_at = b"", at

    def _bytes(self, n: int) -> bytes:
        begin = self.at - self.held_at
        if begin + n > len(self.held) and self.held_at + len(self.held) < self.size:
            self.handle.seek(self.at)
            self.held, self.held_at, begin = self.handle.read(max(n, 1 << 20)), self.at, 0
        return self.held[begin:begin + n]

    def seek_block(self) -> bool:
        """Go to the first block from here on.  Compressed data may look like
        a block's head; a real one is followed by another, or by the end."""
        while self.at < self.size:
            window = self._bytes(2 * _LONGEST)
            begin = window.find(_MAGIC)
            while begin >= 0:
                size = block_size(window[begin:begin + _HEAD])
                if size:
                    after = self.at + begin + size
                    follows = window[begin + size:begin + size + _HEAD]
                    if after == self.size or block_size(follows):
                        self.at += begin
                        return True
                if begin > _LONGEST:
                    break
                begin = window.find(_MAGIC, begin + 1)
            step = begin if begin > _LONGEST else max(len(window) - 3, 1)
            self.at += min(step, len(window)) or 1
        return False

    def next(self) -> bytes | None:
        """The text of the block here; None at the end."""
        if self.at >= self.size:
            return None
        size = block_size(self._bytes(_HEAD))
        if not size or self.at + size > self.size:
            raise OSError(f"no whole BGZF block at byte {self.at}")
        data = self._bytes(size)
        self.at += size
        return _inflated(data)


def _range_lines(handle, size: int, begin: int, end: int) -> Iterator[bytes]:
    """Runs of whole lines that begin in the blocks of a byte range."""
    blocks = _Blocks(handle, begin, size)
    if begin and not blocks.seek_block():
        return
    skipping, rest = begin > 0, b""
    while blocks.at < min(end, size):
        data = blocks.next()
        if skipping:
            cut = data.find(b"\n")
            if cut < 0:
                continue
            skipping, data = False, data[cut + 1:]
        cut = data.rfind(b"\n") + 1
        if cut:
            yield rest + data[:cut]
            rest = data[cut:]
        else:
            rest += data
    if skipping:
        return  # an earlier range's line covers this one
    while (data := blocks.next()) is not None:  # the line that goes on, or begins, here
        cut = data.find(b"\n") + 1
        rest += data[:cut] if cut else data
        if cut:
            break
    if rest:
        yield rest


def _place_lines(handle, size: int, begin: int, end: int) -> Iterator[bytes]:
    """Text between two places (block's byte << 16 | byte of its text)."""
    blocks = _Blocks(handle, begin >> 16, size)
    while blocks.at < size and blocks.at <= end >> 16:
        at = blocks.at
        if at == end >> 16 and not end & 0xFFFF:
            return
        data = blocks.next()
        upto = end & 0xFFFF if at == end >> 16 else len(data)
        yield data[(begin & 0xFFFF) if at == begin >> 16 else 0:upto]


def _gzip_lines(handle) -> Iterator[bytes]:
    import gzip

    with gzip.open(handle) as text:
        while data := text.read(1 << 20):
            yield data


def _batches(name: str, chunks: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """``file, line`` rows of the non-empty lines of a text."""
    def batch(lines: Sequence[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(lines), pa.string()), pa.array(lines, pa.binary()).cast(pa.string())],
            names=["file", "line"])

    held, rest = [], b""
    for data in chunks:
        data = rest + data
        cut = data.rfind(b"\n") + 1
        rest = data[cut:]
        # Lines end at LF, CR LF or CR, as for the text source.
        held += [line for line in data[:cut].replace(b"\r", b"\n").split(b"\n") if line]
        if len(held) >= BATCH_LINES:
            yield batch(held)
            held = []
    held += [line for line in rest.replace(b"\r", b"\n").split(b"\n") if line]
    if held:
        yield batch(held)


class BlockRange(InputPartition):
    """A byte range of one file, or with ``places`` a range of places."""

    def __init__(self, path: str, begin: int, end: int, places: bool = False):
        super().__init__((path, begin, end))
        self.path, self.begin, self.end, self.places = path, begin, end, places


class BlockRanges(InputPartition):
    """Ranges that one task reads one after the other."""

    def __init__(self, ranges: list[BlockRange]):
        super().__init__([r.value for r in ranges])
        self.ranges = ranges


def shared_out(ranges: list[BlockRange], most: int = MOST_TASKS) -> list[InputPartition]:
    """A partition for each range, or if there are more than ``most``, runs of
    neighbouring ranges: short ranges of much text are not a task each."""
    each = -(-len(ranges) // most)
    if each < 2:
        return ranges
    return [BlockRanges(ranges[i:i + each]) for i in range(0, len(ranges), each)]


class BgzfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = json.loads(options["files"])
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        self.places = options.get("places") == "true"

    def partitions(self) -> list[InputPartition]:
        if self.places:
            return [BlockRange(*f, places=True) for f in self.files] or [BlockRange("", 0, 0)]
        out = []
        for path, size in self.files:
            step = size
            if size > self.split:
                with open_store(path) as handle:
                    step = self.split if block_size(handle.read(_HEAD)) else size
            out += [BlockRange(path, at, min(at + step, size)) for at in range(0, size, step)]
        return shared_out(out) or [BlockRange("", 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, BlockRanges):
            for part in partition.ranges:
                yield from self.read(part)
            return
        if not partition.path:
            return
        with open_store(partition.path) as handle:
            size = handle.size()
            if partition.places:
                chunks = _place_lines(handle, size, partition.begin, partition.end)
            else:
                blocked = block_size(handle.read(_HEAD)) is not None
                handle.seek(0)
                chunks = (_range_lines(handle, size, partition.begin, partition.end) if blocked
                          else _gzip_lines(handle))
            yield from _batches(partition.path, chunks)


class BgzfLines(DataSource):
    """``file, line`` of the files in the option ``files`` (JSON of paths and
    sizes, or of paths and places)."""

    @classmethod
    def name(cls) -> str:
        return "varlake_bgzf"

    def schema(self) -> str:
        return "file string, line string"

    def reader(self, schema) -> BgzfReader:
        return BgzfReader(dict(self.options))


def _load(spark: SparkSession, files: list, **options: str) -> DataFrame:
    spark.dataSource.register(BgzfLines)
    return spark.read.format("varlake_bgzf").options(files=json.dumps(files), **options).load()


def read_bgzf(spark: SparkSession, paths: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """S1 for ``.vcf.gz`` files: lines as :func:`varlake.sources.vcf.read_vcf`
    gives them.  Block-compressed files are cut into ranges of
    ``split_bytes``, others are read by one task each.  Only the listing comes
    to the driver."""
    listing = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("file"), "length").orderBy("file").collect()
    df = _load(spark, [[r["file"], r["length"]] for r in listing if r["length"]],
               splitBytes=str(split_bytes))
    df.vcf_paths = [paths] if isinstance(paths, str) else list(paths)
    return df


# ---------------------------------------------------------------------- writing
def bins_of(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest bin that holds each 0-based half-open interval: five levels
    of bins from 16 kb on, each eight times as wide, and one for all."""
    bins = np.zeros(len(begin), np.int64)
    left = np.ones(len(begin), bool)
    for level in range(5):
        shift = WINDOW_BITS + 3 * level
        first = ((1 << (3 * (5 - level))) - 1) // 7
        fits = left & (begin >> shift == (end - 1) >> shift)
        bins[fits] = first + (begin[fits] >> shift)
        left &= ~fits
    return bins


def bins_over(begin: int, end: int) -> list[tuple[int, int]]:
    """All bins whose interval meets a 0-based half-open one: first and last of
    each level."""
    out = [(0, 0)]
    for level in range(5):
        shift = WINDOW_BITS + 3 * level
        first = ((1 << (3 * (5 - level))) - 1) // 7
        out.append((first + (begin >> shift), first + ((end - 1) >> shift)))
    return out


def _changes(moved: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where ``moved`` holds or a value isn't the one before."""
    out = moved.copy()
    out[1:] |= values[1:] != values[:-1]
    return out


class _PartWriter:
    """Blocks of one part file, and what the index says of it."""

    def __init__(self, sink):
        self.sink, self.rest, self.text, self.bytes = sink, b"", 0, 0
        self.block_at: list[int] = []  # where each block of BLOCK text bytes begins
        self.chunks: list[list] = []  # contig, bin, begin, end (text bytes)
        self.windows: dict[tuple[str, int], int] = {}  # first record over a window

    def _write(self, data: bytes) -> None:
        self.block_at.append(self.bytes)
        self.bytes += self.sink.write(block(data))

    def add(self, lines: pa.Array, contig: list[str], begin: np.ndarray, end: np.ndarray) -> None:
        texts = lines.cast(pa.binary()).to_pylist()
        at = self.text + np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        bins, low, high = bins_of(begin, end), begin >> WINDOW_BITS, end - 1 >> WINDOW_BITS
        names = np.array(contig, object)
        moved = np.ones(len(names), bool)  # off the contig of the record before
        moved[1:] = names[1:] != names[:-1]
        first = np.flatnonzero(_changes(moved, bins))
        for i, j in zip(first, [*first[1:], len(names)]):
            mine = self.chunks[-1] if self.chunks else None
            if mine and mine[0] == names[i] and mine[1] == bins[i]:
                mine[3] = int(at[j])
            else:
                self.chunks.append([names[i], int(bins[i]), int(at[i]), int(at[j])])
        # A record over the same windows as the one before is the first of none.
        for i in np.flatnonzero(_changes(moved, low) | _changes(moved, high)):
            for w in range(int(low[i]), int(high[i]) + 1):
                self.windows.setdefault((names[i], w), int(at[i]))
        self.text = int(at[-1])
        data = self.rest + b"\n".join(texts) + b"\n"
        upto = len(data) - len(data) % BLOCK
        for b in range(0, upto, BLOCK):
            self._write(data[b:b + BLOCK])
        self.rest = data[upto:]

    def close(self) -> None:
        if self.rest:
            self._write(self.rest)

    def place(self, text_byte: int) -> int:
        whole, within = divmod(text_byte, BLOCK)
        if whole == len(self.block_at):
            return self.bytes << 16  # the part's end
        return self.block_at[whole] << 16 | within

    def rows(self) -> Iterator[tuple]:
        """contig, bin, window, begin, end: a bin's run of records, or a window's
        first."""
        for contig, b, begin, end in self.chunks:
            yield contig, b, None, self.place(begin), self.place(end)
        for (contig, w), begin in self.windows.items():
            yield contig, None, w, self.place(begin), None


_INDEX = ("part int, name string, bytes long, records long, contig string, bin int, window int, "
          "begin long, end long")


def _write_parts(folder: str):
    """The work of one task: its sorted records as one part file; yields the
    file's row and its index rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() + 1
        name, writer, records = f"{uuid.uuid4().hex}", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                sink = open_store(f"{folder}/{name}", write=True)
                writer = _PartWriter(sink)
            records += batch.num_rows
            begin = np.maximum(batch["pos"].to_numpy() - 1, 0)
            writer.add(batch["line"], batch["contig"].to_pylist(), begin,
                       begin + np.maximum(batch["width"].to_numpy(), 1))
        if writer is None:
            return
        writer.close()
        sink.close()
        rows = [(part, name, writer.bytes, records, None, None, None, None, None),
                *((part, name, None, None, *r) for r in writer.rows())]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(),
                 pa.int64(), pa.int64()]
        names = [f.split()[0] for f in _INDEX.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return work


def write_vcf(records: DataFrame, header: Sequence[str], path: str, partitions: int | None = None) -> None:
    """K5: a VCF file in parts under ``path``: ``header`` (``##`` lines and the
    ``#CHROM`` line), the records (fixed fields + ``samples``) in chromosome and
    position order, and the end of the file.  The bytes of all part files in
    the order of their names are one ``.vcf.gz``.  Beside it, ``<path>.index`` is
    the position index.

    A task writes under a name of its own in a staging folder; only the files
    that the job's rows name are moved to ``path``, so a task that ran twice
    does no harm.  Records without a position go first on their contig.
    """
    spark = records.sparkSession
    path = path.rstrip("/")
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    fields = [F.col(f"`{c}`") for c in FIXED_FIELDS]
    lines = records.select(
        F.concat_ws("\t", *fields, F.col("samples")).alias("line"),
        F.col("`#CHROM`").alias("contig"),
        F.coalesce(to_long("POS"), F.lit(0)).alias("pos"),
        F.length("REF").cast("long").alias("width"))
    rank = chromosome_rank(strip_chr("contig"))
    order = [rank.alias("rank"), F.col("contig"), F.col("pos"), F.xxhash64("line"), F.col("line")]
    ranged = (lines.repartitionByRange(partitions, *order) if partitions
              else lines.repartitionByRange(*order))
    make_folder(path)
    make_folder(staging)
    index = f"{path}.index"
    # The keys are columns: a sort works an expression out in every comparison of two rows.
    keys = [f"__by_{i}" for i in range(len(order))]
    ranged.withColumns(dict(zip(keys, order))).sortWithinPartitions(*keys).select(
        *lines.columns).mapInArrow(_write_parts(staging), _INDEX).write.mode("overwrite").parquet(f"{index}/rows")
    parts = spark.read.schema(_INDEX).parquet(f"{index}/rows").where(
        F.col("bytes").isNotNull()).orderBy("part").collect()
    head = b"".join(line.encode() + b"\n" for line in header)
    with open_store(f"{path}/part-000000.vcf.gz", write=True) as out:
        for at in range(0, len(head), BLOCK):
            out.write(block(head[at:at + BLOCK]))
    for n, r in enumerate(parts, 1):  # of metadata; no bytes pass the driver
        move_file(f"{staging}/{r['name']}", f"{path}/part-{n:06d}.vcf.gz")
    with open_store(f"{path}/part-{len(parts) + 1:06d}.vcf.gz", write=True) as out:
        out.write(END_BLOCK)
    remove_folder(staging)
    files = [(r["name"], f"part-{n:06d}.vcf.gz") for n, r in enumerate(parts, 1)]
    spark.createDataFrame(files, "name string, file string").write.mode("overwrite").parquet(
        f"{index}/files")


def read_region(spark: SparkSession, path: str, contig: str, begin: int, end: int) -> DataFrame:
    """Records (:func:`varlake.sources.vcf.vcf_records`) of a written VCF that
    overlap ``begin..end`` (1-based, both included) of ``contig``, read from the
    blocks that the index names."""
    path = path.rstrip("/")
    low, high = max(begin - 1, 0), end
    rows = spark.read.schema(_INDEX).parquet(f"{path}.index/rows").where(F.col("contig") == contig)
    files = spark.read.parquet(f"{path}.index/files")
    # Nothing before a window's first record overlaps it or a later window.
    first = rows.where(F.col("window").between(low >> WINDOW_BITS, (high - 1) >> WINDOW_BITS)).groupBy(
        "name").agg(F.min("begin").alias("first"))
    wanted = F.lit(False)
    for least, most in bins_over(low, high):
        wanted = wanted | F.col("bin").between(least, most)
    chunks = rows.where(wanted).join(first, "name").where(
        F.col("end") > F.col("first")).join(F.broadcast(files), "name").select(
        "file", F.greatest("begin", "first").alias("begin"), "end").orderBy("file", "begin").collect()
    merged: list[list] = []  # a region's places, next to each other
    for r in chunks:
        name = f"{path}/{r['file']}"
        if merged and merged[-1][0] == name and r["begin"] <= merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], r["end"])
        else:
            merged.append([name, r["begin"], r["end"]])
    records = vcf_records(_load(spark, merged, places="true"))
    return records.where((F.col("`#CHROM`") == contig) & overlaps(begin, end))


def overlaps(begin: int, end: int) -> Column:
    """Whether a record's reference bases meet ``begin..end``."""
    pos = to_long("POS")
    return (pos <= end) & (pos + F.greatest(F.length("REF"), F.lit(1)) > begin)


def _store(path: str):
    from pyarrow import fs

    plain = re.sub(r"^file:/+", "/", path)
    if plain.startswith("/"):
        return fs.LocalFileSystem(), plain
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    """A new folder; an error if there is something in its place."""
    from pyarrow import fs

    store, place = _store(path)
    if store.get_file_info(place).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    store.create_dir(place, recursive=True)


def move_file(source: str, target: str) -> None:
    store, place = _store(source)
    store.move(place, _store(target)[1])


def remove_folder(path: str) -> None:
    store, place = _store(path)
    store.delete_dir(place)
