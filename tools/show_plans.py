"""Print the shuffle skeleton of the main plans: run each once and keep,
from the final adaptive plan, the scans, exchanges, reused exchanges and
broadcasts (with their keys).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.operators import index as idx  # noqa: E402
from quire.operators import layout, lookup, prefix  # noqa: E402
from quire.plans import catalog as C  # noqa: E402
from quire.session import local_session, pin  # noqa: E402

KEEP = ("Exchange", "Scan", "ReusedExchange", "BroadcastHashJoin", "SortMergeJoin", "Window",
        "HashAggregate", "ObjectHashAggregate", "Generate")


def skeleton(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"\[plan_id=\d+\]|#\d+L?|, \[id=#\d+\]", "", line)
            line = re.sub(r"Location: [^,]*,|Format: Parquet,|Batched: true,|PartitionFilters: \[\],", "", line)
            line = re.sub(r"(functions=\[[^\]]{0,60})[^\]]*\]", r"\1...]", line)
            out.append(line.rstrip()[:170])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    docs = C.documents(spark, sf)
    tf = idx.term_frequencies(docs)
    pinned = pin(tf)
    gaps = layout.posting_gaps(pinned)
    blocks = layout.posting_blocks(gaps)
    plans = {
        "term_frequencies": tf,
        "posting_gaps (after the postings are written)": gaps,
        "posting_blocks with payload": blocks,
        "lexicon (global prefix sum)": prefix.lexicon(layout.posting_blocks(gaps, with_payload=False)),
        "next_geq (as-of join, 2 passes)": lookup.next_geq(pinned, C.probes(spark, sf)),
    }
    for name, df in plans.items():
        print(f"### {name}\n\n```\n{skeleton(df)}\n```\n")


if __name__ == "__main__":
    main()
