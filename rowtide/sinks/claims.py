"""L2: who may run a batch. A claim is a file that only one run can create.

``root/job_name=<job>/batch_id=<batch>/<attempt>`` is created exclusively before
anything is written for that attempt. A run that finds the file of a
live run (younger than the lease) is refused; one whose run crashed is
overtaken after the lease, as the next attempt, which is again one file that
only one run can create. Marks in the ledger then say how attempts ended.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from rowtide.sinks import fs


class BatchClaimed(RuntimeError):
    """Another run holds the batch."""


def claim(spark: SparkSession, folder: str, attempt: int, lease_seconds: float) -> int:
    """Claim ``attempt`` or, past expired claims, the next free one; returns it."""
    # an earlier attempt that has no finish mark may still run
    for name in fs.list_names(spark, folder):
        if int(name) >= attempt and fs.age_seconds(spark, f"{folder}/{name}") < lease_seconds:
            raise BatchClaimed(f"{folder}: attempt {name} is running")
    while True:
        path = f"{folder}/{attempt}"
        if fs.create_exclusive(spark, path, str(time.time())):
            return attempt
        if fs.age_seconds(spark, path) < lease_seconds:
            raise BatchClaimed(f"{folder}: attempt {attempt} is running")
        attempt += 1
