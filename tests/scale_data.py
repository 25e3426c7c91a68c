"""Replicate the events test table to a larger one, optionally with hot keys
(script: ``python tests/scale_data.py <sf_dir> <out_dir> <copies> [hot]``).

Copies get their own users; with ``hot``, a third of all events belongs to one
user in one account and a third of the anonymous ones to one device.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulseledger.session import local_session  # noqa: E402


def main(sf_dir: str, out_dir: str, copies: int, hot: bool) -> None:
    spark = local_session()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # 1,000,000 keeps user_id % 20 and % 7 as varied as in the original.
    user = "user_id + copy * 1000000"
    if hot:
        user = f"IF(pmod(xxhash64(event_id, copy), 3) = 0, 8, {user})"
    grown = events.crossJoin(spark.range(copies).withColumnRenamed("id", "copy")).selectExpr(
        f"event_id + copy * 100000000 AS event_id",
        "ts + make_interval(0, 0, 0, 0, 0, 0, pmod(xxhash64(event_id, copy), 3600)) AS ts",
        f"{user} AS user_id",
        "event_type",
        "value",
        "props",
    )
    grown.repartition(32).write.parquet(f"{out_dir}/events.parquet")
    for table in ("pages", "customer", "nation"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{out_dir}/{table}.parquet")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]), "hot" in sys.argv[4:])
