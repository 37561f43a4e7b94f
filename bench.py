"""Headline-query benchmark.

Runs the pipelines and the heaviest operators of the query catalog on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.  Every query first runs once on the smallest scale
factor, untimed (JIT, generated code), then three times; its figure is the
median, so the one-time write of derived VCF text doesn't count, of
building the plan (with its counts that decide broadcasts) and running it into
Spark's ``noop`` sink.  ``build`` has the share of the former, ``shuffle_mb``
what the tasks of a run wrote for shuffles, from Spark's event log.

``python bench.py --strategies`` measures the plans of the key annotation
instead: plain joins, key-reduced and per-key, and the OR join's two forms.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "filter_vep",
    "filter_dragon",
    "filter_annovar",
    "gene_group",
    "attach_gene_list",
    "vcf_to_table",
    "vcf_transcript_rows",
    "vcf_site_qc",
    "flag_rare",
    "dbsnp_smallest",
    "orphanet_or_join",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(build) -> tuple[float, float, float, float]:
    """(seconds to build, seconds in all, began, ended) of one run."""
    began = time.time()
    df = build()
    built = time.time()
    df.write.format("noop").mode("overwrite").save()
    ended = time.time()
    return built - began, ended - began, began, ended


def shuffled(folder: str, spans: dict[str, tuple[float, float]]) -> dict[str, float]:
    """MB that tasks begun within each span wrote for shuffles."""
    out = dict.fromkeys(spans, 0.0)
    for path in Path(folder).rglob("*"):
        for line in path.open(errors="replace") if path.is_file() else ():
            if '"SparkListenerTaskEnd"' not in line:
                continue
            try:
                e = json.loads(line)
            except ValueError:  # the log's last line may be cut
                continue
            at = e["Task Info"]["Launch Time"] / 1000
            written = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
            for name, (a, b) in spans.items():
                if a <= at <= b:
                    out[name] += written.get("Shuffle Bytes Written", 0) / 1e6
    return {k: round(v, 1) for k, v in out.items()}


def strategies(spark, sf_dir: str) -> dict:
    """Plans to compare: name -> builder."""
    from varlake.config import Limits
    from varlake.operators.aggregates import dbsnp_smallest, orphanet_by_gene
    from varlake.operators.filters import keep_consequences
    from varlake.operators.genes import attach_orphanet
    from varlake.operators.joins import Derived, annotate_by_key, project_annotation
    from varlake.sources.fixtures import fixture

    fx = lambda n: fixture(spark, sf_dir, n)

    def annotated(strategy):
        tables = [project_annotation(fx("fx_regeneron"), ["REGENERON_ALL_AF"]),
                  Derived(project_annotation(fx("fx_dbsnp"), ["name"]), dbsnp_smallest),
                  project_annotation(fx("fx_topmed"), {"af": "TOPMed_af"})]
        return annotate_by_key(keep_consequences(fx("fx_variants")), tables, strategy=strategy)

    def orphanet(small):
        return attach_orphanet(keep_consequences(fx("fx_variants")),
                               orphanet_by_gene(fx("fx_orphanet")), small=small,
                               limits=Limits())

    return {"annotate_plain": lambda: annotated("plain"),
            "annotate_reduce": lambda: annotated("reduce"),
            "annotate_keys": lambda: annotated("keys"),
            "or_join_broadcast": lambda: orphanet(True),
            "or_join_shuffled": lambda: orphanet(False)}


def main() -> None:
    from varlake.config import build_session
    from varlake.plans import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [x for x in sys.argv[1:] if not x.startswith("--")] or HEADLINE
    events = tempfile.mkdtemp(prefix="varlake-events-")
    spark = build_session(app_name="varlake-bench", event_log_dir=events)
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")

    if "--strategies" in sys.argv:
        todo = strategies(spark, sf_dir)
        first = strategies(spark, warm) if os.path.isdir(warm) else {}
    else:
        todo = {n: lambda q=catalog.REGISTRY[n][0]: q(spark, sf_dir) for n in names}
        first = {n: lambda q=catalog.REGISTRY[n][0]: q(spark, warm) for n in names} if (
            os.path.isdir(warm)) else {}

    times, builds, spans = {}, {}, {}
    for name, build in todo.items():
        if name in first:
            timed(first[name])
        runs = [timed(build) for _ in range(RUNS)]
        times[name] = round(median(r[1] for r in runs), 3)
        builds[name] = round(median(r[0] for r in runs), 3)
        spans[name] = runs[-1][2:]
    spark.stop()

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "build": builds,
        "shuffle_mb": shuffled(events, spans),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
