"""VCF text as tidy tables (S9) that hold any header: ``meta`` (a row for each
definition), ``fix`` (a row for each record, INFO as a map) and ``gt`` (a row for
each call, its values as a map); and sparse calls for joint files of many samples.

No table has a column per INFO key or sample, so plans and schemas stay the
same size whatever the headers say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.config import DEFAULT_LIMITS, Limits, written
from varlake.functions.keys import chromosome_rank, strip_chr, to_double, to_long
from varlake.functions.vcf import HOM_REF, NO_CALL, bound, format_places, sample_calls, worked_out
from varlake.operators.joins import left_join_lookup
from varlake.sources.vcf import VcfSpec, records_of, sample_names, vcf_schema, with_sample_names


def vcf_meta(lines: DataFrame, spec: VcfSpec | None = None) -> DataFrame:
    """``file, Tag, ID, Number, Type, Description`` of every INFO and FORMAT
    definition of every file."""
    spec = spec or vcf_schema(lines)
    line = F.col("line")

    def value(name: str) -> Column:
        v = F.regexp_extract(line, f"[<,]{name}=([^,>]*)", 1)
        return F.when(v != "", v)

    text = F.regexp_extract(line, r'Description="((?:[^"\\]|\\.)*)"', 1)
    return spec.heads.where(line.rlike("^##(INFO|FORMAT)=<")).select(
        "file", F.regexp_extract(line, "^##([A-Z]+)=", 1).alias("Tag"), value("ID").alias("ID"),
        value("Number").alias("Number"), value("Type").alias("Type"),
        F.when(text != "", text).alias("Description"))


def _first_of_each(items: Column, key) -> Column:
    """Elements of ``items`` whose key no earlier element has."""
    keys = F.transform(items, key)
    return F.filter(items, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def info_map(info: str | Column = "INFO") -> Column:
    """INFO as a map; a flag's value is NULL, of a repeated key the first counts.
    ``.`` and empty text are an empty map."""
    info = F.col(info) if isinstance(info, str) else info
    items = F.filter(F.split(info, ";"), lambda x: (x != "") & (x != "."))
    name = lambda x: F.substring_index(x, "=", 1)
    entry = lambda x: F.struct(name(x).alias("key"), F.when(
        F.length(name(x)) < F.length(x), F.substr(x, F.length(name(x)) + 2)).alias("value"))
    return F.map_from_entries(F.transform(_first_of_each(items, name), entry))


def call_keys(fmt: str | Column) -> Column:
    """A struct of a FORMAT's ``keys``, each once, and of their first ``places`` (from 1)."""
    return bound(F.split(F.col(fmt) if isinstance(fmt, str) else fmt, ":"), lambda all_: bound(
        F.array_distinct(all_), lambda keys: F.struct(keys.alias("keys"), F.transform(
            keys, lambda k: F.array_position(all_, k).cast("int")).alias("places"))))


def call_map(keys: Column, sample: Column) -> Column:
    """A call's values by FORMAT key (``keys``: :func:`call_keys`); ``.`` and dropped
    trailing ones are NULL."""
    return bound(F.split(sample, ":"), lambda values: F.map_from_arrays(
        keys["keys"], F.transform(keys["places"], lambda i: F.nullif(
            F.get(values, i - 1), F.lit(".")))))


def with_chrom_key(records: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``records`` plus ``ChromKey``: the number of their contig in chromosome
    order among all contigs present, from 1."""
    from pyspark.sql import Window

    # As many rows as contigs; numbered in one place.
    contigs = records.select("#CHROM").distinct()
    order = Window.orderBy(chromosome_rank(strip_chr("#CHROM")), F.col("`#CHROM`"))
    # Written: counted and joined, and found in the records but once.
    numbered = written(contigs.withColumn("ChromKey", F.row_number().over(order)))
    return left_join_lookup(records, numbered, ["#CHROM"], limits=limits)


def vcf_fix(lines: DataFrame, spec: VcfSpec | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """A row for each record: ``file, ChromKey, CHROM, POS, ID, REF, ALT, QUAL,
    FILTER`` and ``INFO`` as a map; ``.`` is NULL but in REF and ALT."""
    spec = spec or vcf_schema(lines)
    recs = with_chrom_key(records_of(lines, spec, limits), limits)
    known = lambda c: F.nullif(F.col(c), F.lit(".")).alias(c)
    return recs.select(
        "file", "ChromKey", F.col("#CHROM").alias("CHROM"), to_long("POS").alias("POS"), known("ID"),
        "REF", "ALT", to_double("QUAL").alias("QUAL"), known("FILTER"), info_map().alias("INFO"))


def vcf_gt(lines: DataFrame, spec: VcfSpec | None = None, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """A row for each record and sample: ``file, ChromKey, POS, REF, ALT, Indiv``
    and ``gt``, its values by FORMAT key.  Records without samples have none."""
    spec = spec or vcf_schema(lines)
    recs = with_sample_names(with_chrom_key(records_of(lines, spec, limits), limits), spec, limits)
    # A generator's output: the conditions of the next one would split the samples anew.
    recs = worked_out(recs, __own=F.slice("samples", 1, F.size("__names")), __keys=call_keys("FORMAT"))
    calls = recs.select("file", "ChromKey", "POS", "REF", "ALT", "__keys", "__names",
                        F.posexplode("__own").alias("__i", "__call"))
    return calls.select(
        "file", "ChromKey", to_long("POS").alias("POS"), "REF", "ALT",
        F.get("__names", F.col("__i")).alias("Indiv"),
        call_map(F.col("__keys"), F.col("__call")).alias("gt"))


# ------------------------------------------------------------------ sparse calls
def sample_dictionary(lines: DataFrame, spec: VcfSpec | None = None) -> DataFrame:
    """``file, sample_index, sample``: a row for each sample that a file names."""
    spec = spec or vcf_schema(lines)
    return sample_names(spec.heads).select(
        "file", F.posexplode("sample_names").alias("sample_index", "sample"))


def sparse_calls(lines: DataFrame, spec: VcfSpec | None = None, limits: Limits = DEFAULT_LIMITS
                 ) -> DataFrame:
    """A row for each record: fixed fields and ``calls``, an array of ``index,
    genotype, depth, quality`` of the samples whose genotype (adjusted by allele
    depths as in P0) is a variant call, so the row of a joint record is as long
    as it has carriers.  :func:`sample_dictionary` names the samples."""
    spec = spec or vcf_schema(lines)
    recs = with_sample_names(records_of(lines, spec, limits), spec, limits)
    recs = worked_out(recs, __own=F.slice("samples", 1, F.size("__names")),
                      __places=format_places("FORMAT", "GT", "AD", "DP", "GQ"))
    call = lambda c, i: F.struct(
        i.alias("index"), c["genotype"].alias("genotype"),
        to_double(c["DP"]).cast("int").alias("depth"), to_double(c["GQ"]).alias("quality"))
    carried = lambda c: ~F.coalesce(c["genotype"], F.lit(NO_CALL)).isin(NO_CALL, HOM_REF)
    recs = worked_out(recs, calls=F.filter(F.transform(sample_calls("__own", "__places"), call), carried))
    return recs.select("file", "#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "calls")


def calls_long(sparse: DataFrame, dictionary: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """:func:`sparse_calls` as a row for each call, with the sample's name."""
    long = sparse.select(*[F.col(f"`{c}`") for c in sparse.columns if c != "calls"],
                         F.inline("calls"))
    return left_join_lookup(long, dictionary, {"file": "file", "index": "sample_index"}, limits=limits)
