"""P0 ``vcf_to_table`` and P6 ``vcf_transcripts``: VCF text to tables.

P0: site QC, gene tag, then one row per record (``layout='wide'``: one
column per INFO key, per CSQ sub-field of the picked transcript and per
sample FORMAT key, as the flattened TSV has them) or one row per record and
sample (``layout='long'``, the cohort form: sample names come from each
file's own ``#CHROM`` line, so files with different samples stack).

P6: one row per Ensembl transcript and sample (the tidy form).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.config import DEFAULT_LIMITS, Limits
from varlake.functions.vcf import (
    PICK_OR_CANONICAL_VALUES,
    PICK_VALUES,
    FORMAT_SEP,
    InfoParts,
    allele_depths,
    call_genotype,
    call_inputs,
    format_value,
    info_value,
    keyed_value,
    picked_of,
    subfield,
    tagged_info,
    transcript_id,
    transcripts,
    unescape,
    worked_out,
)
from varlake.operators.vcf_qc import (
    DEFAULT_THRESHOLDS,
    SiteThresholds,
    drop_star_alt,
    ensembl_transcripts,
    sample_qc,
    site_qc,
    variant_calls_only,
)
from varlake.sources.vcf import VcfSpec, records_of, vcf_schema, with_sample_names

FIRST_SEVEN = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER"]


def tag_genes(records: DataFrame, spec: VcfSpec) -> DataFrame:
    """X7 on the INFO column (pick/symbol/consequence located by name,
    case-insensitive, as the QC step does)."""
    pick = spec.csq_index("PICK", case_insensitive=True)
    symbol = spec.csq_index("SYMBOL", case_insensitive=True)
    cons = spec.csq_index("Consequence", case_insensitive=True)
    if pick is None or symbol is None:
        return records
    split = worked_out(records, __all=transcripts(info_value("INFO", spec.csq_key or "CSQ", missing_dot=False)))
    last = worked_out(split, __last=picked_of(F.col("__all"), pick, which="last", fallback_first=False))
    return last.withColumn("INFO", tagged_info(F.col("INFO"), F.col("__last"), symbol, cons)).drop(
        "__all", "__last")


def vcf_qc_records(
    lines: DataFrame,
    spec: VcfSpec | None = None,
    *,
    mode: str = "drop",
    require_csq: bool = True,
    primary_only: bool = True,
    drop_targeted: bool = True,
    thresholds: SiteThresholds = DEFAULT_THRESHOLDS,
    sample_rule: str = "any",
) -> DataFrame:
    """F1-F6 + X7: QC-passed (or flagged) records with the gene tag in INFO."""
    spec = spec or vcf_schema(lines)
    recs = site_qc(records_of(lines, spec), mode=mode, sample_rule=sample_rule, require_csq=require_csq,
                   primary_only=primary_only, drop_targeted=drop_targeted,
                   thresholds=thresholds, csq_key=spec.csq_key or "CSQ")
    return tag_genes(recs, spec)


def flatten_records(
    records: DataFrame,
    spec: VcfSpec,
    *,
    layout: str = "wide",
    canonical_fallback: bool = True,
    fallback_first: bool = True,
    drop_star: bool = True,
    variants_only: bool = True,
    sample_mode: str | None = None,
    carry: list[str] | tuple[str, ...] = (),
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """P0 flatten.

    INFO: ``INFO_<id>`` per header id (``.`` -> NULL).  CSQ: ``CSQ_<field>``
    of the transcript with PICK = 1 (or CANONICAL = YES when the header has
    no PICK and ``canonical_fallback``), else the first transcript; empty
    sub-fields NULL.  Samples (wide): ``<sample>_FORMAT_<key>`` per header
    FORMAT id and ``<sample>_AdjustedGenotype``.  A single-sample table keeps
    only rows whose adjusted genotype is a variant call (``variants_only``).
    Samples (long): a row each, named by its own file's header; ``sample_mode``
    (``drop`` or ``flag``) judges depth and quality per row (F4).
    """
    df = drop_star_alt(records) if drop_star else records
    pick_i = spec.pick_index
    values = PICK_VALUES
    if pick_i is None and canonical_fallback:
        pick_i, values = spec.canonical_index, PICK_OR_CANONICAL_VALUES
    elif canonical_fallback:
        values = PICK_OR_CANONICAL_VALUES
    cols = [F.col(f"`{c}`") for c in FIRST_SEVEN]
    if spec.info_ids or spec.csq_fields:
        df = InfoParts.of(df)
    df = df.withColumns({f"__info{i}": InfoParts.value(k) for i, k in enumerate(spec.info_ids)})
    cols += [F.col(f"__info{i}").alias(f"INFO_{k}") for i, k in enumerate(spec.info_ids)]
    if spec.csq_fields:
        csq = InfoParts.value(spec.csq_key, missing_dot=False)
        df = worked_out(df, __all=transcripts(csq)).withColumn("__t", picked_of(
            F.col("__all"), pick_i, values, fallback_first=fallback_first)).drop("__all")
    df = InfoParts.dropped(df)
    if spec.csq_fields:
        cols += [subfield(F.col("__t"), i).alias(f"CSQ_{n}") for i, n in enumerate(spec.csq_fields)]
    extra = [F.element_at("samples", -1).alias(spec.extra_last)] if spec.extra_last else []
    extra += [F.col(c) for c in carry]

    if layout == "wide":
        if not spec.uniform_samples:
            raise ValueError("files name different samples: use layout='long'")
        keys, vals, depths, inputs, calls = F.col("__keys"), {}, {}, {}, {}
        for i, s in enumerate(spec.samples):
            sample = F.col("sample1") if i == 0 and "sample1" in df.columns else F.get(F.col("samples"), i)
            own, ad = F.col(f"__v{i}"), F.col(f"__ad{i}")
            vals[f"__v{i}"], depths[f"__ad{i}"] = F.split(sample, FORMAT_SEP), allele_depths(keys, own)
            inputs[f"__g{i}"] = call_inputs(sample, keys, own, ad)
            cols += [keyed_value(keys, own, k).alias(f"{s}_FORMAT_{k}") for k in spec.format_ids]
            calls[f"__gt{i}"] = call_genotype(F.col(f"__g{i}"))
            cols.append(F.col(f"__gt{i}").alias(f"{s}_AdjustedGenotype"))
        if inputs:
            df = worked_out(df, __keys=F.split("FORMAT", FORMAT_SEP), **vals)
            for made in (depths, inputs, calls):
                df = worked_out(df, **made)
        out = df.select(*cols, *extra)
        if variants_only and len(spec.samples) == 1:
            out = variant_calls_only(out, f"{spec.samples[0]}_AdjustedGenotype")
        return out

    if layout == "long":
        base = with_sample_names(df, spec, limits)
        base = base.withColumn("__s", F.slice("samples", 1, F.size("__names"))).withColumn(
            "__n", F.size("__s"))
        exploded = base.select("*", F.posexplode_outer("__s").alias("__i", "__sample"))
        sample, keys, vals = F.col("__sample"), F.col("__keys"), F.col("__vals")
        exploded = worked_out(exploded, __keys=F.split("FORMAT", FORMAT_SEP), __vals=F.split(sample, FORMAT_SEP))
        if sample_mode:
            exploded = sample_qc(exploded, sample, mode=sample_mode,
                                 value=lambda key: keyed_value(keys, vals, key))
        per = [F.get(F.col("__names"), F.col("__i")).alias("sample")]
        per += [keyed_value(keys, vals, k).alias(f"FORMAT_{k}") for k in spec.format_ids]
        per.append(F.col("__gt").alias("AdjustedGenotype"))
        exploded = worked_out(exploded, __ad=allele_depths(keys, vals))
        exploded = worked_out(exploded, __g=call_inputs(sample, keys, vals, F.col("__ad")))
        exploded = worked_out(exploded, __gt=call_genotype(F.col("__g")))
        out = exploded.select(*cols, *per, *extra, "__n")
        if variants_only:
            # Per record: a single-sample record keeps only variant calls.
            out = out.where(
                (F.col("__n") > 1) | F.col("AdjustedGenotype").isNull()
                | ~F.col("AdjustedGenotype").isin("./.", "0/0")
            )
        return out.drop("__n")
    raise ValueError("layout must be 'wide' or 'long'")


def vcf_to_table(
    lines: DataFrame,
    spec: VcfSpec | None = None,
    *,
    qc: bool = True,
    mode: str = "drop",
    layout: str = "wide",
    canonical_fallback: bool = True,
    fallback_first: bool = True,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """VCF lines -> QC -> gene tag -> flattened table (``Flagged`` kept
    as the last column in ``mode='flag'``)."""
    spec = spec or vcf_schema(lines)
    long = layout == "long"
    if qc:
        recs = vcf_qc_records(lines, spec, mode=mode, sample_rule="none" if long else "any")
    else:
        recs = records_of(lines, spec, limits)
    carry = ["Flagged"] if qc and mode == "flag" else []
    return flatten_records(recs, spec, layout=layout, canonical_fallback=canonical_fallback,
                           fallback_first=fallback_first, carry=carry,
                           sample_mode=mode if qc and long else None, limits=limits)


def vcf_transcripts(lines: DataFrame, spec: VcfSpec | None = None,
                    limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """P6 (S9, X3, F9, X9, X10, X12, J22): one row per Ensembl transcript of a
    record and per sample.

    Columns: ``chromosome, start, ID, reference, alternate, quality, FILTER``,
    ``INFO_<id>``, one column per CSQ/ANN sub-field (ANN transcript ids
    without version), ``Indiv`` and ``gt_<key>`` per FORMAT key; ``\\x3b`` and
    ``\\x3d`` escapes decoded in every text column.  Transcripts and samples
    are paired within their own record; each file names its own samples, and
    a record without samples keeps its transcripts with NULL genotypes.
    """
    spec = spec or vcf_schema(lines)
    recs = with_sample_names(records_of(lines, spec, limits), spec, limits)
    csq = info_value("INFO", spec.csq_key or "CSQ", missing_dot=False)
    base = recs.select(
        F.col("#CHROM").alias("chromosome"), F.col("POS").try_cast("bigint").alias("start"),
        F.col("ID"), F.col("REF").alias("reference"), F.col("ALT").alias("alternate"),
        F.col("QUAL").alias("quality"), F.col("FILTER"),
        *[info_value("INFO", k).alias(f"INFO_{k}") for k in spec.info_ids],
        F.explode(transcripts(csq)).alias("__t"), F.col("FORMAT"), F.col("samples"),
        F.col("__names"),
    )
    feature = "Feature_ID" if spec.csq_key == "ANN" else "Feature"
    tcols = [subfield(F.col("__t"), i).alias(n) for i, n in enumerate(spec.csq_fields)]
    t = base.select(*[F.col(f"`{c}`") for c in base.columns if c != "__t"], *tcols)
    if feature in spec.csq_fields:
        t = ensembl_transcripts(t, feature)
        if spec.csq_key == "ANN":
            t = t.withColumn(feature, transcript_id(feature))
    own = F.slice("samples", 1, F.size("__names"))
    g = t.select("*", F.posexplode_outer(own).alias("__i", "__s"))
    out = g.select(
        *[F.col(f"`{c}`") for c in t.columns if c not in ("FORMAT", "samples", "__names")],
        F.get("__names", F.col("__i")).alias("Indiv"),
        *[format_value("FORMAT", F.col("__s"), k).alias(f"gt_{k}") for k in spec.format_ids],
    )
    return out.select([
        unescape(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`") for f in out.schema.fields
    ])
