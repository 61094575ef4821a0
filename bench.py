"""Bench: every registered query plus the stored-index programs, timed at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``.

Each query runs to completion into Spark's ``noop`` sink (all rows are
computed, nothing is collected). Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans import build as B  # noqa: E402
from quire.plans.catalog import QUERIES, QUERY_DOC_ID, QUERY_TERMS, documents  # noqa: E402
from quire.session import local_session  # noqa: E402
from quire.sinks.text import write_postings_text  # noqa: E402
from quire.operators.index import term_frequencies  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"), app="quire-bench")
    scratch = tempfile.mkdtemp(prefix="quire-bench-")

    # Warm the JVM (class loading, JIT, codegen caches) by running every
    # query once on the smallest scale factor; only the runs below are timed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for q in QUERIES.values():
            try:
                _noop(q(spark, warm_dir))
            except Exception:  # noqa: BLE001 - the timed run reports it
                pass
    else:
        _noop(QUERIES["doc_lengths"](spark, sf_dir))

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        # one failing item is reported, not allowed to lose the whole line
        t0 = time.perf_counter()
        try:
            fn()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    for name, q in QUERIES.items():
        timed(name, lambda q=q: _noop(q(spark, sf_dir)))

    index_dir = f"{scratch}/index"
    timed("build_and_write_index",
          lambda: B.write_index_tables(B.build_index(documents(spark, sf_dir)), index_dir))
    timed("query_stored_index",
          lambda: _noop(B.query_index(spark, B.open_index(spark, index_dir), QUERY_TERMS, QUERY_DOC_ID)))
    timed("write_postings_text",
          lambda: write_postings_text(term_frequencies(documents(spark, sf_dir)), f"{scratch}/postings_txt"))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for v in times.values() if v is not None), 3)
    line = {"metric": "total_query_time", "value": total, "unit": "sec",
            "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
