"""VCF text as DataFrames.

``read_vcf`` scans one file or a whole cohort of files: plain text with
``spark.read.text``, split by ``spark.sql.files.maxPartitionBytes``; paths that end
in ``.gz`` or ``.bgz`` by their blocks (:mod:`varlake.sources.bgzf`), where tasks can
open the store by themselves.

The header is metadata, read from the head of each file only
(:func:`header_lines`): tasks open the files of a listing and stop at the
first record.  The distinct ``##INFO`` / ``##FORMAT`` definitions, which say
what columns a table has, come to the driver; what differs by file (sample
names, the order of the annotation's sub-fields) stays a table joined on
``file``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.vcf import clean_annotation_name, worked_out
from varlake.operators.joins import left_join_lookup

# The eight fixed VCF columns and FORMAT, in file order.
FIXED_FIELDS = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
# Pattern of a trailing non-sample column (pedigree notes).
EXTRA_LAST_PATTERN = re.compile(r"inheritance|parent", re.IGNORECASE)
# Annotation INFO keys holding per-transcript records.
TRANSCRIPT_KEYS = ("CSQ", "ANN")


@dataclass
class VcfSpec:
    """What the headers say about the records."""

    info_ids: list[str] = field(default_factory=list)
    format_ids: list[str] = field(default_factory=list)
    csq_key: str | None = None
    csq_fields: list[str] = field(default_factory=list)
    sample_list: list[str] = field(default_factory=list)
    extra_last: str | None = None
    # True when every file has the same ``#CHROM`` line (same samples).
    uniform_samples: bool = True
    # Every distinct order of the annotation's sub-fields, by header line;
    # records are brought to the order of ``csq_fields``.
    csq_layouts: dict[str, list[str]] = field(default_factory=dict)
    # ``(file, line)`` of all headers, for what differs by file.
    heads: DataFrame | None = None

    @property
    def samples(self) -> list[str]:
        """Sample names; of files that differ, those of all files (collected
        on request, no plan needs them)."""
        if self.uniform_samples or self.heads is None:
            return self.sample_list
        names = sample_names(self.heads).select(F.explode("sample_names").alias("s"))
        return sorted(r["s"] for r in names.distinct().collect())

    def csq_index(self, name: str, case_insensitive: bool = False) -> int | None:
        for i, f in enumerate(self.csq_fields):
            if f == name or (case_insensitive and f.lower() == name.lower()):
                return i
        return None

    @property
    def pick_index(self) -> int | None:
        return self.csq_index("PICK")

    @property
    def canonical_index(self) -> int | None:
        return self.csq_index("CANONICAL")


def read_vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of one or many VCF files as ``(file, line)``; empty lines
    dropped.  Compressed files are read by :func:`varlake.sources.bgzf.read_bgzf`
    if all paths name such files.  The text reader already ends lines at LF, CR LF or CR, so no
    per-line trimming expression is needed (one would be re-evaluated by
    every predicate Catalyst pushes below the record projection)."""
    given = [paths] if isinstance(paths, str) else list(paths)
    if all(p.endswith((".gz", ".bgz")) and _opens(p) for p in given):
        from varlake.sources.bgzf import read_bgzf

        return read_bgzf(spark, given)
    df = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")
    )
    df = df.where(F.length("line") > 0)
    df.vcf_paths = given
    return df


def header_lines(lines: DataFrame) -> DataFrame:
    """``file, line`` of the header lines; a file that has records but no
    ``#CHROM`` line before them also has a row with a NULL line.  For files
    (:func:`read_vcf`) a listing is read, not the text, and each file is opened
    up to its first record; lines of another origin, and stores that only
    Spark reads, are filtered."""
    paths = getattr(lines, "vcf_paths", None)
    if not paths or not all(map(_opens, paths)):
        is_header = F.col("line").startswith("#")
        bare = lines.groupBy("file").agg(
            F.max(F.col("line").startswith("#CHROM")).alias("named"),
            F.max(~is_header).alias("records")).where(F.col("records") & ~F.col("named"))
        return lines.where(is_header).select("file", "line").unionByName(
            bare.select("file", F.lit(None).cast("string").alias("line")))
    # The content column of this source isn't selected, so it isn't read.
    listing = lines.sparkSession.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("file"))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = list(_head(name))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found, pa.string())],
                    names=["file", "line"])

    return listing.mapInArrow(heads, "file string, line string")


def _opens(path: str) -> bool:
    """Whether tasks can open files of this store by themselves."""
    from pyarrow import fs

    scheme = path.split(":", 1)[0] if re.match(r"\w+:/", path) else "file"
    if scheme == "file":
        return True
    try:
        fs.FileSystem.from_uri(path.split("*", 1)[0])
        return True
    except (pa.ArrowException, OSError):
        return False


def open_store(path: str, write: bool = False):
    """An open file of a store that ``pyarrow.fs`` knows: random access for
    reading, or a stream to write."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", path)
    if uri.startswith("/"):  # the listing percent-encodes odd characters
        from urllib.parse import unquote

        store, place = fs.LocalFileSystem(), unquote(uri) if uri != path else uri
    else:
        store, place = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(place, compression=None) if write else store.open_input_file(place)


def _head(path: str) -> Iterator[str | None]:
    """Header lines of one (gzipped or plain) file; None if a record comes
    before any ``#CHROM`` line."""
    import gzip
    import io

    with open_store(path) as raw:
        plain = gzip.open(raw) if path.endswith((".gz", ".bgz")) else io.BufferedReader(raw, 1 << 16)
        named = False
        for line in io.TextIOWrapper(plain, "utf-8", newline=None):
            line = line.rstrip("\r\n")
            if line and not line.startswith("#"):
                if not named:
                    yield None
                return
            if line:
                named = named or line.startswith("#CHROM")
                yield line


# How a header describes the keys that the gene tag adds to INFO.
GENE_TAG_HEADER = [
    '##INFO=<ID=Gene.refGene,Number=1,Type=String,Description="Gene symbol of the picked transcript">',
    '##INFO=<ID=Func.refGene,Number=1,Type=String,Description="Consequence of the picked transcript">',
]
_DEFINITION = r"^##(INFO|FORMAT|FILTER|ALT|contig)="


def output_header(spec: VcfSpec, added: Sequence[str] = GENE_TAG_HEADER) -> list[str]:
    """Header lines for records of all files of ``spec``, which must name the
    same samples: the lines of the first file, definitions that only others
    have, ``added`` definitions, and the ``#CHROM`` line."""
    if spec.heads is None or not spec.uniform_samples:
        raise ValueError("one header needs files that name the same samples")
    numbered = spec.heads.where(F.col("line").isNotNull()).withColumn(
        "__at", F.monotonically_increasing_id())
    first = numbered.where(F.col("line").startswith("#CHROM")).agg(F.min("file")).first()[0]
    found = numbered.where((F.col("file") == first) | F.col("line").rlike(_DEFINITION)).groupBy(
        "line").agg(F.min(F.struct(F.col("file") != first, "file", "__at")).alias("__at")).orderBy(
        "__at").collect()
    lines = [r["line"] for r in found]
    meta = [line for line in lines if line.startswith("##")]
    return [*meta, *(line for line in added if line not in meta),
            *(line for line in lines if line.startswith("#CHROM"))]


# Options of the text writer: fast gzip in files that one task each reads.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def write_text(lines: DataFrame, path: str, files: int | None = None, packed: bool = False) -> str:
    """Write a ``line`` column as text under ``path``: a part file per
    partition, or ``files`` of them; ``packed`` as gzipped files of bounded size."""
    out = lines.select("line")
    out = out if files is None else out.coalesce(files)
    out.write.options(**(PACKED_TEXT if packed else {})).text(path)
    return path


def vcf_lines(lines: DataFrame, file_id: str = "input") -> DataFrame:
    """Adopt a DataFrame with a ``line`` column (e.g. derived text) as VCF
    lines of one file."""
    if "file" in lines.columns:
        return lines.select("file", "line")
    return lines.select(F.lit(file_id).alias("file"), F.col("line"))


def split_header(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: (``##`` meta lines, ``#CHROM`` line + records)."""
    meta = lines.where(F.col("line").startswith("##"))
    body = lines.where(~F.col("line").startswith("##"))
    return meta, body


_INFO_RE = re.compile(r"^##INFO=<ID=([^=,]+),")
_FORMAT_RE = re.compile(r"^##FORMAT=<ID=([^=,]+),")
_DESC_FORMAT_RE = re.compile(r'Description="[^"]*?(?:Format|Functional annotations):\s*([^"]+)"')


def parse_header(header_lines: list[str]) -> VcfSpec:
    """S2 on a list of header lines (in file order)."""
    spec = VcfSpec()
    for line in header_lines:
        m = _INFO_RE.match(line)
        if m:
            key = m.group(1)
            if key in TRANSCRIPT_KEYS:
                d = _DESC_FORMAT_RE.search(line)
                if d and spec.csq_key in (None, key):
                    spec.csq_key = key
                    names = d.group(1).strip().split("|")
                    if key == "ANN":
                        names = [clean_annotation_name(n) for n in names]
                    spec.csq_layouts[line] = names
                    spec.csq_fields += [n for n in names if n not in spec.csq_fields]
            elif key not in spec.info_ids:
                spec.info_ids.append(key)
            continue
        m = _FORMAT_RE.match(line)
        if m:
            if m.group(1) not in spec.format_ids:
                spec.format_ids.append(m.group(1))
            continue
        if line.startswith("#CHROM"):
            cols = line.split("\t")
            extra = cols[-1] if len(cols) > 9 and EXTRA_LAST_PATTERN.search(cols[-1]) else None
            samples = cols[9:-1] if extra else cols[9:]
            spec.extra_last = extra
            spec.sample_list += [s for s in samples if s not in spec.sample_list]
    return spec


def complete_headers(heads: DataFrame, *, header_of: str = "file",
                     given: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``heads`` (see :func:`header_lines`) in which files without a ``#CHROM``
    line have the header lines that ``given`` has under their file name, or,
    with ``header_of='folder'``, those of the file in their folder that has one
    (part files of a body that was split)."""
    if header_of not in ("file", "folder"):
        raise ValueError("header_of must be 'file' or 'folder'")
    bare = F.col("line").isNull()
    name = F.substring_index("file", "/", -1)
    folder = F.expr("left(file, length(file) - length(substring_index(file, '/', -1)))")
    if given:
        rows = [(k, line) for k, head in given.items() for line in head]
        told = heads.sparkSession.createDataFrame(rows, "__name string, __line string")
        files = heads.where(bare).select("file", name.alias("__name"))
        found = files.join(F.broadcast(told), "__name").select(
            "file", F.col("__line").alias("line"))
        heads = heads.join(found.select("file").distinct().withColumn("__told", F.lit(True)),
                           "file", "left").where(F.col("__told").isNull() | ~bare).drop(
            "__told").unionByName(found)
    if header_of == "folder":
        own = heads.where(F.col("line").startswith("#CHROM")).groupBy(
            folder.alias("__folder")).agg(F.min("file").alias("__from"),
                                          F.countDistinct("line").alias("__kinds"))
        lent = heads.where(bare).select("file", folder.alias("__folder")).join(
            own.where(F.col("__kinds") == 1), "__folder").select("file", "__from")
        found = lent.join(heads.where(~bare).withColumnRenamed("file", "__from"), "__from").select(
            "file", "line")
        heads = heads.join(lent.select("file", F.lit(True).alias("__lent")), "file", "left").where(
            F.col("__lent").isNull() | ~bare).drop("__lent").unionByName(found)
    return heads


def require_headers(heads: DataFrame) -> None:
    """An error that names files whose records no header describes."""
    bare = heads.where(F.col("line").isNull()).agg(
        F.count(F.lit(1)).alias("n"), F.min("file").alias("first"), F.max("file").alias("last"))
    found = bare.first()
    if found["n"]:
        files = sorted({found["first"], found["last"]})
        raise ValueError(
            f"{found['n']} file(s) have records but no #CHROM line, and the other files' headers "
            f"differ or are none: {', '.join(files)}; pass header_of='folder' if they are parts of a "
            "file in their folder, or their header lines in given={file name: lines}")


def vcf_schema(lines: DataFrame, *, header_of: str = "file",
               given: Mapping[str, Sequence[str]] | None = None) -> VcfSpec:
    """The header spec of all files in ``lines``.

    The distinct ``##INFO`` and ``##FORMAT`` definitions are gathered in the
    order of first appearance (by file name, then line); one ``#CHROM`` line
    comes along, and whether there are others.  While all headers agree, a file
    without one is taken to be described by them.  If they differ, such a
    file needs one from its folder or the caller (:func:`complete_headers`);
    without, it is an error.
    """
    heads = written(complete_headers(header_lines(lines), header_of=header_of, given=given))
    numbered = heads.withColumn("__at", F.monotonically_increasing_id())
    defs = (
        numbered.where(F.col("line").startswith("##INFO=") | F.col("line").startswith("##FORMAT="))
        .groupBy("line").agg(F.min(F.struct("file", "__at")).alias("__at"))
        .orderBy("__at").collect()
    )
    chrom = heads.where(F.col("line").startswith("#CHROM")).agg(
        F.min("line").alias("least"), F.max("line").alias("most")).first()
    spec = parse_header([r["line"] for r in defs] + ([chrom["least"]] if chrom["least"] else []))
    spec.uniform_samples = chrom["least"] == chrom["most"]
    spec.heads = heads
    layouts = {tuple(names) for names in spec.csq_layouts.values()}
    if chrom["least"] is None or not spec.uniform_samples or len(layouts) > 1:
        require_headers(heads)
    return spec


def vcf_records(lines: DataFrame) -> DataFrame:
    """Data lines split into the fixed fields, ``sample1`` (the first
    column after FORMAT), ``samples`` (every column after FORMAT, in header
    order, including a trailing non-sample column if the header has one)
    and ``file``.  A line is split once up to its samples, those where they are read."""
    n = len(FIXED_FIELDS)
    body = worked_out(lines.where(~F.col("line").startswith("#")).select("file", "line"),
                      __f=F.split("line", "\t", n + 1))
    cols = [F.get("__f", F.lit(i)).alias(name) for i, name in enumerate(FIXED_FIELDS)]
    rest = F.get("__f", F.lit(n))
    samples = F.when(rest.isNotNull(), F.split(rest, "\t", -1)).otherwise(
        F.array().cast("array<string>"))
    return body.select("file", *cols, F.substring_index(rest, "\t", 1).alias("sample1"),
                       samples.alias("samples"))


def sample_names(heads: DataFrame) -> DataFrame:
    """Per file: ``file, sample_names`` (array) from its ``#CHROM`` line,
    without a trailing non-sample column."""
    chrom = heads.where(F.col("line").startswith("#CHROM"))
    f = F.split(F.col("line"), "\t", -1)
    n = F.greatest(F.size(f) - len(FIXED_FIELDS), F.lit(0))
    last = F.element_at(f, -1).rlike("(?i)" + EXTRA_LAST_PATTERN.pattern)
    n = F.when((n > 1) & last, n - 1).otherwise(n)
    return chrom.select("file", F.slice(f, len(FIXED_FIELDS) + 1, n).alias("sample_names"))


def with_sample_names(records: DataFrame, spec: VcfSpec, limits: Limits = DEFAULT_LIMITS
                      ) -> DataFrame:
    """``records`` plus ``__names``: the sample names of the record's own file."""
    if spec.uniform_samples or spec.heads is None:
        # One literal, however many samples there are.
        names = F.split(F.lit("\t".join(spec.sample_list)), "\t") if spec.sample_list else (
            F.array().cast("array<string>"))
        return records.withColumn("__names", names)
    names = sample_names(spec.heads).withColumnRenamed("sample_names", "__names")
    unnamed = F.raise_error(F.concat(F.lit("no header names the samples of "), F.col("file")))
    return left_join_lookup(records, names, ["file"], limits=limits).withColumn(
        "__names", F.coalesce("__names", unnamed.cast("array<string>")))


def _moved(places: list[int | None]):
    """One transcript's sub-fields in the order ``places``; None is empty."""
    def transcript(t: F.Column) -> F.Column:
        parts = F.split(t, r"\|", -1)
        return F.concat_ws("|", *[
            F.lit("") if p is None else F.coalesce(F.get(parts, F.lit(p)), F.lit(""))
            for p in places])

    return transcript


def records_of(lines: DataFrame, spec: VcfSpec, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The records of ``lines`` with every file's annotation sub-fields in
    the order of ``spec.csq_fields``, whatever order its own header gives."""
    recs = vcf_records(lines)
    if len({tuple(names) for names in spec.csq_layouts.values()}) < 2 or spec.heads is None:
        return recs
    layouts = list(spec.csq_layouts.items())
    layout = F.lit(None).cast("int")
    for i, (line, _) in enumerate(layouts):
        layout = F.when(F.col("line") == line, i).otherwise(layout)
    by_file = spec.heads.select("file", layout.alias("__layout")).where(
        F.col("__layout").isNotNull()).groupBy("file").agg(F.min("__layout").alias("__layout"))
    recs = left_join_lookup(recs, by_file, ["file"], limits=limits)

    def reordered(item: F.Column) -> F.Column:
        """One INFO item; the annotation's is rewritten by the file's layout."""
        unknown = F.raise_error(F.concat(
            F.lit("no header gives the annotation's sub-fields of "), F.col("file")))
        out = F.when(F.col("__layout").isNull() & item.startswith(f"{spec.csq_key}="),
                     unknown.cast("string")).otherwise(item)
        for i, (_, names) in enumerate(layouts):
            places = [names.index(n) if n in names else None for n in spec.csq_fields]

            value = F.substr(item, F.lit(len(spec.csq_key) + 2))
            moved = F.concat(F.lit(f"{spec.csq_key}="), F.array_join(
                F.transform(F.split(value, ","), _moved(places)), ","))
            if places != list(range(len(names))):
                out = F.when((F.col("__layout") == i) & item.startswith(f"{spec.csq_key}="),
                             moved).otherwise(out)
        return out

    return recs.withColumn("INFO", F.array_join(
        F.transform(F.split("INFO", ";"), reordered), ";")).drop("__layout")
