"""
headcount by delta sweep versus range join, and the data-quality run as one
compiled pass versus one job per check.  The range join and the per-check runs
exist only here, as the comparison points.

usage: python tools_measure.py [sf_dir]
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F  # noqa: E402

from workpulse.operators import dq, workforce  # noqa: E402
from workpulse.plans import bindings as B  # noqa: E402
from workpulse.plans import dq_suite, queries_dq  # noqa: E402
from workpulse.session import get_spark  # noqa: E402


def timed(fn, runs=3):
    fn()  # warm-up
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return round(sorted(out)[len(out) // 2], 3)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    emp = B.employee(spark, sf)
    sweep = workforce.daily_headcount(emp)
    bounds = emp.agg(F.min("hire_date").alias("s"), F.max("tenure_end_date").alias("e"))
    spine = bounds.select(F.explode(F.sequence("s", "e")).alias("calendar_date"))
    people = emp.select("hire_date", "term_date")
    range_join = (spine.join(people, (F.col("hire_date") <= F.col("calendar_date")) &
                             (F.col("term_date").isNull() | (F.col("calendar_date") <= F.col("term_date"))))
                  .groupBy("calendar_date").agg(F.count(F.lit(1)).alias("active_headcount")))
    same = sorted(map(tuple, sweep.collect())) == sorted(map(tuple, range_join.collect()))
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    res = {"sf": sf, "headcount_equal": same,
           "headcount_sweep_s": timed(lambda: noop(sweep)),
           "headcount_range_join_s": timed(lambda: noop(range_join))}

    frames = queries_dq.dq_frames(spark, sf)   # silver checkpointed once, as in the query
    checks = dq_suite.standard_checks(frames, B.AS_OF, queries_dq.PUNCH_AS_OF)
    res["dq_checks"] = len(checks)
    res["dq_one_pass_s"] = timed(lambda: noop(dq.dq_report(spark, frames, checks)), runs=2)
    res["dq_per_check_s"] = timed(
        lambda: [dq.dq_report(spark, frames, [c]).collect() for c in checks], runs=1)
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
