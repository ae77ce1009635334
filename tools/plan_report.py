"""Write PLANS.md: the final (post-AQE) physical plan facts of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is executed once (collect at a small scale factor) so the adaptive plan is final;
then the report lists hash exchanges, join strategies, Python operators and, per parquet
scan, the pushed filters and the read schema. Scans of the fact tables are counted over all
executions of a query, those run while it is built included, from Spark's event log.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from almanac.queries import REGISTRY  # noqa: E402
from almanac.session import get_session  # noqa: E402

SKIP = {"rf_forecast", "gbt_forecast", "boost_forecast", "score_all_models", "best_model_all"}  # MLlib job chains


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def scans(text: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan parquet [^\n]*", text):
        line = m.group(0)
        table = re.search(r"Location: InMemoryFileIndex[^\[]*\[file:[^\]]*/([a-z_]+)\.parquet", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        out.append(f"`{table.group(1) if table else '?'}` pushed={pushed.group(1) if pushed else '[]'} "
                   f"read={schema.group(1) if schema else '?'}")
    return out


FACTS = ("lineitem", "orders", "events")


class ScanCounter:
    """Scans of fact tables in the final plans of all executions since the last call."""

    def __init__(self, folder: str):
        self.folder, self.read = folder, 0

    def __call__(self, spark) -> dict[str, int]:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        time.sleep(0.2)
        (name,) = [f for f in os.listdir(self.folder) if not f.startswith(".")]
        with open(os.path.join(self.folder, name)) as f:
            lines = f.readlines()
        plans = {}
        for line in lines[self.read:]:
            event = json.loads(line)
            if "sparkPlanInfo" in event:
                plans[event["executionId"]] = event["sparkPlanInfo"]
        self.read = len(lines)
        found = dict.fromkeys(FACTS, 0)
        todo = list(plans.values())
        while todo:
            node = todo.pop()
            todo += node["children"]
            if node["nodeName"].startswith("Scan parquet"):
                for t in FACTS:
                    found[t] += f"{t}.parquet" in node.get("metadata", {}).get("Location", "")
        return {t: n for t, n in found.items() if n}


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="almanac-events-")
    SparkSession.builder.config(map={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
                                     "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                     "spark.ui.enabled": "false", "spark.master": "local[8]"}).getOrCreate()
    spark = get_session("local[8]", 8)
    scanned = ScanCounter(folder)
    print("# PLANS\n")
    print(f"Final adaptive plans of the registered queries at `{sf_dir}` "
          "(generated by `tools/plan_report.py`). Tree-learner queries are MLlib job chains "
          "and are left out.\n")
    print("| query | fact scans | hash exchanges | joins | python | parquet scans (pushed filters, read schema) |")
    print("|---|---|---|---|---|---|")
    for name, q in REGISTRY.items():
        if name in SKIP:
            continue
        df = q.build(spark, sf_dir)
        df.collect()
        text = final_plan(df)
        exch = len(re.findall(r"Exchange hashpartitioning", text))
        joins = []
        for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                  "BroadcastNestedLoopJoin", "CartesianProduct"):
            n = text.count(j)
            if n:
                joins.append(f"{j}×{n}")
        py = [p for p in ("FlatMapGroupsInPandas", "ArrowEvalPython", "BatchEvalPython") if p in text]
        facts = ", ".join(f"{t}×{n}" for t, n in scanned(spark).items()) or "–"
        print(f"| {name} | {facts} | {exch} | {', '.join(joins) or '–'} | {', '.join(py) or '–'} | "
              f"{'<br>'.join(scans(text)) or 'checkpointed frame'} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
