"""Compare registered queries with their SQL.

``python tests/check_queries.py [sf_dir] [name...] [--large]``

``--large`` takes the paths large data takes: no broadcasts, and AQE told to split small partitions.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402
from carelake.session import local_session  # noqa: E402


LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def main() -> int:
    words = [w for w in sys.argv[1:] if w != "--large"]
    conf = LARGE if "--large" in sys.argv else {}
    sf_dir = words[0] if words else "/root/testdata/sf0.01"
    wanted = words[1:]
    spark, db = local_session(8, **conf), oracle.connect(sf_dir)
    checks, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in checks:
                verdict = oracle.compare(frame, db, checks[name])
            else:
                verdict = None if frame.count() else "no rows"
        except Exception as failure:
            verdict = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += verdict is not None
        label = "ok" if verdict is None else "BAD"
        if verdict is None and name not in checks:
            label = "rows"
        print(f"{label:4} {name:32} {time.time() - start:6.2f}s {verdict or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
