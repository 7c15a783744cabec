"""Time the dataset builders on synthetic feeds: python tools/bench_builders.py [municipalities]

The feeds are written to Parquet first (as landed raw tables would be), then
``runner.build_all`` builds and writes every dataset.  Prints one JSON line
with the row counts and seconds per dataset.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from civic_spark.plans import runner
    from civic_spark.session import get_session
    from tools.synth_election import generate

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 2000
    spark = get_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", 16)
    base = tempfile.mkdtemp(prefix="civic-synth-")
    raw = {}
    for name, df in generate(spark, n).items():
        df.write.parquet(f"{base}/raw/{name}")
        raw[name] = spark.read.parquet(f"{base}/raw/{name}")
    t0 = time.perf_counter()
    timings: dict[str, float] = {}
    paths = runner.build_all(spark, raw, f"{base}/out", timings)
    total = time.perf_counter() - t0
    rows = {k: spark.read.parquet(v).count() for k, v in paths.items()}
    print(json.dumps({"municipalities": n, "raw_candidacies": raw["candidate"].count(),
                      "seconds": round(total, 2), "per_dataset": timings, "rows": rows}))


if __name__ == "__main__":
    main()
