"""Column expressions over VCF text fields.

Every function takes and returns ``Column``s built from Spark built-ins: the
per-record parsing of the reference's Perl and R scripts becomes projection
expressions that run inside whole-stage codegen, on as many tasks as the text
has splits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.functions.keys import col_of, to_double

# Markers of the VCF format.
VCF_MISSING = "."
INFO_SEP = ";"
TRANSCRIPT_SEP = ","
CSQ_SUBFIELD_SEP = "|"
FORMAT_SEP = ":"
# Transcript selection markers (PICK flag, CANONICAL flag).
PICK_VALUES = ("1",)
PICK_OR_CANONICAL_VALUES = ("1", "YES")
# Allele-balance genotype calling.
ALLELE_BALANCE = 0.8
NO_CALL = "./."
HOM_ALT = "1/1"
HET = "0/1"
HOM_REF = "0/0"


def worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus ``columns``, each worked out once for a row.  They are a generator's
    output: Catalyst pushes the predicates on them no lower, where each predicate
    would take the text apart anew."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` reads it:
    there it is a lambda's variable."""
    return F.get(F.transform(F.array(value), body), 0)


def _info_raw(info: str | Column, key: str) -> Column:
    """Text after the first ``key=`` of an INFO field, up to the next ``;``
    (``''`` when the key is absent).  Plain string splitting; the INFO text is
    referenced once."""
    text = F.concat(F.lit(INFO_SEP), col_of(info))
    return F.substring_index(F.split_part(text, F.lit(INFO_SEP + key + "="), F.lit(2)), INFO_SEP, 1)


def info_value(info: str | Column, key: str, missing_dot: bool = True) -> Column:
    """Value of ``key`` in an INFO text (``k=v;k2=v2;FLAG``).

    Exact key match anywhere in the field (first, middle or last; the first
    occurrence wins); absent key, empty value and (with ``missing_dot``)
    ``.`` are NULL.
    """
    raw = _info_raw(info, key)
    bad = ["", VCF_MISSING] if missing_dot else [""]
    return F.when(~raw.isin(*bad), raw)


def info_number(info: str | Column, key: str) -> Column:
    """X1 + X22: numeric INFO value; absent, ``.`` or non-numeric -> NULL."""
    return _info_raw(info, key).try_cast("double")


def info_has(info: str | Column, key: str) -> Column:
    """Whether INFO carries ``key`` as a flag or as ``key=value``."""
    text = F.concat(F.lit(INFO_SEP), col_of(info), F.lit(INFO_SEP))
    found = (F.instr(text, INFO_SEP + key + INFO_SEP) > 0) | (F.instr(text, INFO_SEP + key + "=") > 0)
    return F.coalesce(found, F.lit(False))


class InfoParts:
    """The items of an INFO text, split once for all the keys that are read of it: two
    columns made by :meth:`of`, an item's key ends in ``=`` unless it is a flag."""

    ITEMS, KEYS = "__info_items", "__info_keys"

    @classmethod
    def of(cls, df: DataFrame, info: str = "INFO") -> DataFrame:
        keys = F.regexp_replace(info, f"=[^{INFO_SEP}]*", "=")
        return worked_out(df, **{cls.ITEMS: F.split(info, INFO_SEP), cls.KEYS: F.split(keys, INFO_SEP)})

    @classmethod
    def raw(cls, key: str) -> Column:
        """Text of the first ``key=`` item; NULL when the key is absent."""
        at = F.array_position(cls.KEYS, F.lit(f"{key}=")).cast("int")
        item = F.get(F.col(cls.ITEMS), at - 1)
        return F.when(at > 0, F.substr(item, F.lit(len(key) + 2)))

    @classmethod
    def value(cls, key: str, missing_dot: bool = True) -> Column:
        """:func:`info_value` of split items."""
        raw = cls.raw(key)
        return F.when(~raw.isin(*["", VCF_MISSING] if missing_dot else [""]), raw)

    @classmethod
    def number(cls, key: str) -> Column:
        """:func:`info_number` of split items."""
        return cls.raw(key).try_cast("double")

    @classmethod
    def has(cls, key: str) -> Column:
        """:func:`info_has` of split items."""
        keys = F.col(cls.KEYS)
        return F.coalesce(F.array_contains(keys, key) | F.array_contains(keys, f"{key}="), F.lit(False))

    @classmethod
    def dropped(cls, df: DataFrame) -> DataFrame:
        return df.drop(cls.ITEMS, cls.KEYS)


def transcripts(csq: str | Column) -> Column:
    """CSQ/ANN text -> array of transcripts, each an array of sub-fields
    (trailing empty sub-fields kept)."""
    return F.transform(
        F.split(col_of(csq), TRANSCRIPT_SEP),
        lambda t: F.split(t, "\\" + CSQ_SUBFIELD_SEP, -1),
    )


def picked_transcript(
    csq: str | Column,
    pick_index: int | None,
    pick_values: Sequence[str] = PICK_VALUES,
    which: str = "first",
    fallback_first: bool = True,
) -> Column:
    """The transcript whose sub-field ``pick_index`` is in
    ``pick_values`` (``which='first'`` or ``'last'`` of them); without one,
    the first transcript (``fallback_first``) or NULL."""
    return picked_of(transcripts(csq), pick_index, pick_values, which, fallback_first)


def picked_of(arr: Column, pick_index: int | None, pick_values: Sequence[str] = PICK_VALUES,
              which: str = "first", fallback_first: bool = True) -> Column:
    """:func:`picked_transcript` of transcripts that are split already."""
    if pick_index is None:
        picked = None
    else:
        chosen = F.filter(arr, lambda t: F.get(t, pick_index).isin(*pick_values))
        picked = F.get(chosen, 0) if which == "first" else F.get(chosen, F.size(chosen) - 1)
    if picked is None:
        return F.get(arr, 0) if fallback_first else F.lit(None)
    return F.coalesce(picked, F.get(arr, 0)) if fallback_first else picked


def subfield(transcript: Column, index: int) -> Column:
    """Sub-field ``index`` of a split transcript; empty or absent -> NULL."""
    v = F.get(transcript, index)
    return F.when(v != F.lit(""), v)


def format_value(fmt: str | Column, sample: str | Column, key: str) -> Column:
    """Value of FORMAT ``key`` in one sample column (``GT:AD:DP`` /
    ``0/1:7,3:10``); a key absent from FORMAT or a value dropped at the end
    of the sample is NULL, ``.`` is kept."""
    return keyed_value(F.split(col_of(fmt), FORMAT_SEP), F.split(col_of(sample), FORMAT_SEP), key)


def keyed_value(keys: Column, vals: Column, key: str) -> Column:
    """:func:`format_value` of a FORMAT and a sample that are split already."""
    pos = F.array_position(keys, F.lit(key)).cast("int")
    return F.when(pos > 0, F.get(vals, pos - 1))


def genotype_inputs(fmt: str | Column, sample: str | Column) -> Column:
    """The values X6 needs, parsed once: a struct of ``missing`` (sample or
    DP is ``.``), ``two`` (exactly two allele depths), ``total`` (their sum),
    ``share`` (ALT depth / total) and ``gt`` (the called GT)."""
    keys, vals = F.split(col_of(fmt), FORMAT_SEP), F.split(col_of(sample), FORMAT_SEP)
    return call_inputs(col_of(sample), keys, vals, allele_depths(keys, vals))


def allele_depths(keys: Column, vals: Column) -> Column:
    """The AD values of a split sample, as text."""
    return F.split(keyed_value(keys, vals, "AD"), ",")


def call_inputs(sample: Column, keys: Column, vals: Column, ad: Column) -> Column:
    """:func:`genotype_inputs` of a FORMAT, a sample and allele depths that are split
    already."""
    def value(key):
        return keyed_value(keys, vals, key)

    ref_d, alt_d = to_double(F.get(ad, 0)), to_double(F.get(ad, 1))
    return F.struct(
        ((sample == F.lit(VCF_MISSING)) | F.coalesce(value("DP") == F.lit(VCF_MISSING), F.lit(False)))
        .alias("missing"),
        F.coalesce(F.size(ad) == 2, F.lit(False)).alias("two"),
        (ref_d + alt_d).alias("total"),
        F.try_divide(alt_d, ref_d + alt_d).alias("share"),
        value("GT").alias("gt"),
    )


def call_genotype(inputs: Column) -> Column:
    """X6 from :func:`genotype_inputs`.

    Sample ``.`` or DP ``.`` -> ``./.``.  With exactly two allele depths: sum
    0 (or not numeric) -> ``./.``; ALT share >= 0.8 -> ``1/1``; >= 1 - 0.8 ->
    ``0/1``; else ``0/0``.  Otherwise the GT as called.
    """
    g = inputs.getField
    two, total, share = g("two"), g("total"), g("share")
    return (
        F.when(g("missing"), F.lit(NO_CALL))
        .when(two & (total.isNull() | (total == 0)), F.lit(NO_CALL))
        .when(two & (share >= F.lit(ALLELE_BALANCE)), F.lit(HOM_ALT))
        .when(two & (share >= F.lit(1 - ALLELE_BALANCE)), F.lit(HET))
        .when(two, F.lit(HOM_REF))
        .otherwise(g("gt"))
    )


def adjusted_genotype(fmt: str | Column, sample: str | Column) -> Column:
    """X6 in one expression (see :func:`call_genotype`).  Where the result is
    also filtered on, prefer a ``genotype_inputs`` column plus
    ``call_genotype``: the inputs are then parsed in one projection."""
    return call_genotype(genotype_inputs(fmt, sample))


def format_places(fmt: str | Column, *names: str) -> Column:
    """A struct of the place (from 1; 0: none) that each of ``names`` has in a FORMAT."""
    return bound(F.split(col_of(fmt), FORMAT_SEP), lambda keys: F.struct(*[
        F.array_position(keys, F.lit(k)).cast("int").alias(k) for k in names]))


def sample_calls(samples: str | Column, places: str | Column) -> Column:
    """For all ``samples`` of a record an array of ``genotype`` (X6) and of ``DP`` and
    ``GQ`` as they stand there; ``places`` are :func:`format_places` of GT, AD, DP and GQ.
    Each step is an array of its own, so a sample, its allele depths and their numbers
    are taken apart once, not in every place that reads them."""
    at = lambda v, key: F.when(
        col_of(places)[key] > 0, F.get(v, col_of(places)[key] - 1))
    split = F.transform(samples, lambda s: F.struct(
        (s == F.lit(VCF_MISSING)).alias("bare"), F.split(s, FORMAT_SEP).alias("v")))
    named = F.transform(split, lambda x: F.struct(
        x["bare"].alias("bare"), F.split(at(x["v"], "AD"), ",").alias("ad"),
        *[at(x["v"], key).alias(key) for key in ("GT", "DP", "GQ")]))
    counted = F.transform(named, lambda x: F.struct(
        (x["bare"] | F.coalesce(x["DP"] == F.lit(VCF_MISSING), F.lit(False))).alias("missing"),
        F.coalesce(F.size(x["ad"]) == 2, F.lit(False)).alias("two"),
        to_double(F.get(x["ad"], 0)).alias("ref"), to_double(F.get(x["ad"], 1)).alias("alt"),
        *[x[key].alias(key) for key in ("GT", "DP", "GQ")]))
    inputs = F.transform(counted, lambda x: F.struct(
        x["missing"].alias("missing"), x["two"].alias("two"),
        (x["ref"] + x["alt"]).alias("total"),
        F.try_divide(x["alt"], x["ref"] + x["alt"]).alias("share"), x["GT"].alias("gt"),
        x["DP"].alias("DP"), x["GQ"].alias("GQ")))
    return F.transform(inputs, lambda x: F.struct(
        call_genotype(x).alias("genotype"), x["DP"].alias("DP"), x["GQ"].alias("GQ")))


def gene_tag(info: str | Column, pick_index: int | None, symbol_index: int | None,
             consequence_index: int | None, csq_key: str = "CSQ") -> Column:
    """INFO with ``Gene.refGene=<symbol>;Func.refGene=<consequence>;``
    prepended from the last transcript with PICK = 1; unchanged when there is
    no such transcript or its symbol is empty."""
    info = col_of(info)
    if pick_index is None or symbol_index is None:
        return info
    t = picked_transcript(info_value(info, csq_key, missing_dot=False), pick_index,
                          PICK_VALUES, which="last", fallback_first=False)
    return tagged_info(info, t, symbol_index, consequence_index)


def tagged_info(info: Column, t: Column, symbol_index: int, consequence_index: int | None) -> Column:
    """:func:`gene_tag` of a transcript that is picked already."""
    gene = F.coalesce(F.get(t, symbol_index), F.lit(""))
    cons = (F.coalesce(F.get(t, consequence_index), F.lit(""))
            if consequence_index is not None else F.lit(""))
    tagged = F.concat(F.lit("Gene.refGene="), gene, F.lit(";Func.refGene="), cons, F.lit(";"), info)
    return F.when(gene != F.lit(""), tagged).otherwise(info)


def variant_id(chrom: str | Column, pos: str | Column, ref: str | Column,
               alt: str | Column) -> Column:
    """``CHROM-POS-REF-ALT``."""
    return F.concat_ws("-", col_of(chrom), col_of(pos).cast("string"), col_of(ref), col_of(alt))


def unescape(c: str | Column) -> Column:
    """VCF percent-style escapes ``\\x3b`` -> ``;`` and ``\\x3d`` -> ``=``."""
    c = col_of(c)
    return F.replace(F.replace(c, F.lit("\\x3b"), F.lit(";")), F.lit("\\x3d"), F.lit("="))


def transcript_id(c: str | Column) -> Column:
    """Ensembl transcript id without version (``ENST...``)."""
    v = F.regexp_extract(col_of(c), "ENST[0-9]+", 0)
    return F.when(v != F.lit(""), v)


def clean_annotation_name(name: str) -> str:
    """ANN sub-field names without spaces and quotes."""
    return name.replace(" ", "").replace("'", "")
