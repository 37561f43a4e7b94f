"""Incremental P0: VCF files landing in a folder, flattened as they arrive.

The reference runs its VCF-to-table step once per sample file.  With many
samples arriving over time the same step is a Structured Streaming query: the
file source picks up new ``.vcf`` files, each micro-batch goes through the
same QC, gene tag and flattening expressions as the batch path (long layout,
so files with different sample names stack), and the sink appends Parquet.
The file source hands a file over whole, so a micro-batch holds the header of
each of its records: sample names and the order of annotation sub-fields are
taken from there, file by file; a file of records without a header fails the
batch.  The stream keeps no state, so no watermark is
needed; progress lives in the checkpoint location, and each batch writes its
own folder, which a repeated batch overwrites.

The columns must be known beforehand: read the spec once with
:func:`varlake.sources.vcf.vcf_schema` from representative files.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from varlake.config import checkpoint_dir
from varlake.plans.vcf_table import vcf_to_table
from varlake.sources.vcf import VcfSpec, header_lines, parse_header, require_headers


def vcf_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: ``(file, line)`` of every new file in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select(F.col("_metadata.file_path").alias("file"),
                                      F.col("value").alias("line"))


def batch_to_table(lines: DataFrame, spec: VcfSpec, *, qc: bool = True,
                   mode: str = "drop") -> DataFrame:
    """P0 on the ``(file, line)`` rows of one micro-batch, long layout, with the
    headers among them."""
    heads = header_lines(lines)
    require_headers(heads)  # each file is whole, so it has its own
    own = parse_header([r["line"] for r in heads.where(
        F.col("line").startswith("##INFO=")).select("line").distinct().collect()])
    layouts = {**spec.csq_layouts, **own.csq_layouts}
    if odd := {n for names in layouts.values() for n in names} - set(spec.csq_fields):
        raise ValueError(f"annotation sub-fields {sorted(odd)} are not in the spec")
    per_file = replace(spec, heads=heads, uniform_samples=False, csq_layouts=layouts)
    table = vcf_to_table(lines, per_file, qc=qc, mode=mode, layout="long")
    return table


def start_ingest(
    spark: SparkSession,
    folder: str,
    output: str,
    spec: VcfSpec,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    qc: bool = True,
) -> StreamingQuery:
    """Run the incremental P0 into Parquet at ``output``.  The checkpoint
    defaults to a folder under the session's ``spark.checkpoint.dir``."""
    if checkpoint is None:
        base = checkpoint_dir(spark)
        if not base:
            raise ValueError("no checkpoint location: set spark.checkpoint.dir or pass checkpoint=")
        checkpoint = base.rstrip("/") + "/varlake-vcf-ingest"
    def write_batch(lines: DataFrame, batch_id: int) -> None:
        batch_to_table(lines, spec, qc=qc).write.mode("overwrite").parquet(
            f"{output.rstrip('/')}/batch={batch_id}")

    writer = (vcf_stream(spark, folder).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
