"""Headline-query bench: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected to the driver). The session is warmed up on
one small query first so JVM start-up is not charged to the first query. The
bench's tables have one row group each, so rows are dealt to as many partitions
as there are cores (``spark.grist.spread``), within the time that is measured.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from grist.operators import classify  # noqa: E402
from grist.plans import curate  # noqa: E402
from grist.plans.queries import REGISTRY  # noqa: E402
from grist.session import ensure_checkpoint_dir, get_session, read_table  # noqa: E402

HEADLINE = [
    "train_heads",        # C1-C5: four heads fitted and saved, as the reference's are before its run
    "curate",             # X0 flagship funnel with these heads loaded, masking, rules
    "mask_pii",           # P7
    "gopher_filter",      # G6
    "html_to_text",       # P3
    "exact_line_dedup",   # A2
    "exact_doc_dedup",    # A3
    "minhash_dedup",      # A6 (10 hashes, 2 bands, 2-word shingles)
    "minhash_dedup_verified",  # A7
    "identify_language",  # C1 train + score
    "pack_sequences",     # T1-T3
]


def train_heads(spark, sf_dir: str, folder: str) -> None:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    heads = curate.train_heads(documents, labels)
    classify.save_models([heads.lang], f"{folder}/lang")
    classify.save_models([heads.nsfw, heads.toxic, heads.quality], f"{folder}/binary")


def funnel(spark, sf_dir: str, folder: str):
    heads = curate.Heads(**classify.load_models(spark, f"{folder}/lang"), **classify.load_models(spark, f"{folder}/binary"))
    return curate.funnel(read_table(spark, sf_dir, "documents"), heads)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus)
    spark.conf.set("spark.grist.spread", str(cpus))
    REGISTRY["mask_emails"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, folder = {}, f"{ensure_checkpoint_dir(spark)}/bench-heads"
    for name in HEADLINE:
        t0 = time.perf_counter()
        if name == "train_heads":
            train_heads(spark, sf_dir, folder)
        else:
            (funnel(spark, sf_dir, folder) if name == "curate" else REGISTRY[name](spark, sf_dir)).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
