"""Evidence for the hot-group split: one part is made to hold half of all line
items (rows re-keyed from lineitem itself), then RANK/LAG within each part
runs once with the plain window and once with the split; likewise one user
is made to own half of all events for sessionisation.  The
Spark event log (written to a scratch folder) gives the largest number of
shuffle records any single task read, and the rows in which split and plain
results differ are counted (they must be none).

usage: python scripts/skew_demo.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.operators.ordered import rank_and_lag, sessionize  # noqa: E402
from quarry.session import build_session  # noqa: E402
from quarry.sources import tables as T  # noqa: E402


def max_task_records(log_dir: str, job_group: str) -> tuple[int, int]:
    """(largest shuffle-read record count of one task, tasks) over the jobs
    tagged with ``job_group``."""
    stages, best, tasks = set(), 0, 0
    for path in sorted(glob.glob(os.path.join(log_dir, "*", "events_*"))):
        with open(path, "rb") as fh:
            raw = fh.read()
        text = zstandard.ZstdDecompressor().stream_reader(raw).read().decode() if path.endswith(".zstd") else raw.decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                if (e.get("Properties") or {}).get("spark.jobGroup.id") == job_group:
                    stages.update(e.get("Stage IDs", []))
            elif e.get("Event") == "SparkListenerTaskEnd" and e.get("Stage ID") in stages:
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                tasks += 1
                best = max(best, recs)
    return best, tasks


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="quarry-skew-")
    spark = build_session(
        shuffle_partitions=64,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
               "spark.sql.adaptive.coalescePartitions.enabled": "false"},
    )
    facts = T.event_facts(spark, sf_dir)
    # every line item of an even order is re-keyed to part 0: a third or more
    # of all rows in one group
    hot = facts.withColumn("l_partkey", F.when(F.col("l_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("l_partkey")))
    total = hot.count()
    in_hot = hot.where("l_partkey = 0").count()
    args = dict(tie_cols=["l_orderkey", "l_linenumber", "deaths", "recovered"], rank_alias="r", lag_alias="p")
    limit = max(1, total // 64)
    runs = {
        "plain": rank_and_lag(hot, ["l_partkey"], "cases", max_group_rows=total + 1, **args),
        "split": rank_and_lag(hot, ["l_partkey"], "cases", max_group_rows=limit, **args),
    }
    out = {"rows": total, "rows_in_hot_part": in_hot, "max_group_rows": limit}
    # sessionisation with one user holding every even event
    ev = T.read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    ev_hot = ev.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(F.col("user_id")))
    ev_total = ev_hot.count()
    ev_limit = max(1, ev_total // 64)
    runs["sessions_plain"] = sessionize(ev_hot, ["user_id"], "ts", 30, ["event_id"], max_group_rows=ev_total + 1)
    runs["sessions_split"] = sessionize(ev_hot, ["user_id"], "ts", 30, ["event_id"], max_group_rows=ev_limit)
    out.update({"events": ev_total, "events_of_hot_user": ev_hot.where("user_id = 0").count()})
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("compare", "compare")
    out["rank_rows_that_differ"] = runs["split"].exceptAll(runs["plain"]).count()
    out["session_rows_that_differ"] = runs["sessions_split"].exceptAll(runs["sessions_plain"]).count()
    spark.stop()
    for name in runs:
        best, tasks = max_task_records(scratch, name)
        out[f"{name}_max_task_shuffle_records"] = best
        out[f"{name}_shuffle_tasks"] = tasks
    print(json.dumps(out))


if __name__ == "__main__":
    main()
