"""Benchmark: every registered query over one dataset, one JSON line out.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

1. the layer tables are built once in a fresh folder (topic -> raw -> typed),
   each step timed;
2. each query runs 1 cold + ``BENCH_RUNS`` (default 3) warm times; its time
   is the best warm run.  Plans execute completely into the ``noop`` sink
   (nothing is collected to the driver);
3. the streaming chain runs once more into a fresh folder to report input
   rows/s per layer from the query progress;
4. ratios of the alternative plans (three-way / single-pass parse, joined /
   single-aggregation metrics) on the same rows;
5. per query, rows its last warm run read and shuffled, and bytes shuffled
   and spilled, summed from
   the stage metrics of Spark's event log (written to a fresh scratch folder;
   ``BENCH_EVENT_LOG=0`` turns it off).  ``stream_*`` queries are left out:
   their micro-batches run on stream threads that do not carry the tag.

``value`` is the sum of the per-query times.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campaignlake.plans.catalog import QUERIES  # noqa: E402
from campaignlake.plans.lake import Lake  # noqa: E402
from campaignlake.session import build_session, scratch_path  # noqa: E402
from campaignlake.streaming import LayerPaths, run_layers  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


_METRICS = {
    "internal.metrics.input.recordsRead": "rows_read",
    "internal.metrics.shuffle.write.recordsWritten": "rows_shuffled",
    "internal.metrics.shuffle.write.bytesWritten": "bytes_shuffled",
    "internal.metrics.diskBytesSpilled": "bytes_spilled",
}


def shuffle_report(log_dir: str) -> dict[str, dict[str, int]]:
    """Stage metrics of the event log, summed per job description."""
    desc_of_stage: dict[int, str] = {}
    report: dict[str, dict[str, int]] = {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus")]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageSubmitted":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    if desc.startswith("bench:") and not desc.startswith("bench:stream_"):
                        desc_of_stage[ev["Stage Info"]["Stage ID"]] = desc[len("bench:"):]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    name = desc_of_stage.get(info["Stage ID"])
                    if name is None:
                        continue
                    row = report.setdefault(name, {"stages": 0, **{v: 0 for v in _METRICS.values()}})
                    row["stages"] += 1
                    for acc in info.get("Accumulables", []):
                        key = _METRICS.get(acc.get("Name"))
                        if key:
                            row[key] += int(acc.get("Value", 0))
    return report


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": "16g"}
    log_dir = None
    if os.environ.get("BENCH_EVENT_LOG", "1") != "0":
        log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                      "spark.eventLog.compress": "false"})
    spark = build_session(
        f"local[{cpus}]",
        app_name="campaignlake-bench",
        shuffle_partitions=int(cpus),
        extra_conf=extra,
    )
    spark.sparkContext.setLogLevel("ERROR")

    layers: dict[str, float] = {}
    fresh = Lake(spark, sf_dir, root=scratch_path(spark, "bench", unique=True))
    for step in ("topic", "raw", "typed"):
        t0 = time.perf_counter()
        getattr(fresh, step)()
        layers[f"build_{step}"] = round(time.perf_counter() - t0, 3)
    Lake(spark, sf_dir).build()

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for i in range(1 + warm):
            # tag the last run's jobs so the event log can be split per query
            spark.sparkContext.setJobDescription(f"bench:{name}" if i == warm else None)
            t0 = time.perf_counter()
            _run(fn(spark, sf_dir))
            dt = time.perf_counter() - t0
            if i > 0 or warm == 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    spark.sparkContext.setJobDescription(None)

    ratios = {}
    for label, slow, fast in (
        ("parse_three_way_over_single_pass", "typed_union", "typed_union_single_pass"),
        ("dedup_three_way_over_single_pass", "typed_dedup", "typed_dedup_single_pass"),
        ("metrics_joined_over_single_pass", "campaign_metrics_exact", "campaign_metrics_single_pass"),
    ):
        if times.get(slow) and times.get(fast):
            ratios[label] = round(times[slow] / times[fast], 3)

    stream_rates = {}
    if not only:
        lake = Lake(spark, sf_dir)
        paths = LayerPaths.under(scratch_path(spark, "bench", unique=True), source=lake.topic_path)
        t0 = time.perf_counter()
        run = run_layers(spark, paths, timeout_seconds=3600, salt_buckets=2)
        stream_rates["chain_seconds"] = round(time.perf_counter() - t0, 3)
        for layer, entries in run.progress.items():
            rows = sum(int(p.get("numInputRows", 0)) for p in entries)
            ms = sum(int((p.get("durationMs") or {}).get("triggerExecution", 0)) for p in entries)
            stream_rates[f"{layer}_rows"] = rows
            stream_rates[f"{layer}_rows_per_second"] = round(rows / (ms / 1000.0), 1) if ms else None

    sf = os.path.basename(sf_dir).replace("sf", "")
    version = spark.version
    spark.stop()
    shuffle = {}
    if log_dir:
        try:
            shuffle = shuffle_report(log_dir)
        except Exception as exc:  # the report is optional; never fail the bench
            shuffle = {"error": str(exc)[:200]}
    print(
        json.dumps(
            {
                "metric": "sum_best_warm_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "layers": layers,
                "ratios": ratios,
                "streaming": stream_rates,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(cpus),
                "spark": version,
                "last_run_bytes": shuffle,
            }
        )
    )


if __name__ == "__main__":
    main()
