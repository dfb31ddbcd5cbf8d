"""Physical-plan census of every registered query -> PLANS.md.

    python scripts/plan_report.py [sf_dir [query ...]]

Each query is executed (no-op sink) and its final adaptive plan is scanned for
shuffles, broadcasts, join strategies, windows and aggregates.  Two settings:
``default`` (Spark/AQE decide broadcasts by measured size) and ``no-broadcast``
(broadcast thresholds off, i.e. every dimension too large to broadcast, as at
cluster scale; explicit bounded broadcasts remain).  What a query writes before
returning (streams, exports, materialised graph edges) is counted with it.
"""

from __future__ import annotations

import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning",
    "range": r"Exchange rangepartitioning",
    "single": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "SHJ": r"ShuffledHashJoin",
    "window": r"\bWindow \[",
    "topk": r"TakeOrderedAndProject",
    "hashagg": r"\bHashAggregate\(",
    "objagg": r"ObjectHashAggregate\(",
    "sortagg": r"SortAggregate\(",
    "scan": r"FileScan parquet",
    "python": r"ArrowEvalPython|BatchEvalPython",
    "BNLJ/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
}


EXCHANGES = {"shuffle", "range", "single", "bcast"}


def _exchange_subtrees(plan: str, pattern: str) -> set[str]:
    """Canonical text (expression ids and plan ids removed) of the subtree
    below every exchange line matching ``pattern``."""
    lines = plan.splitlines()
    out = set()
    for i, line in enumerate(lines):
        if not re.search(pattern, line):
            continue
        depth = len(line) - len(line.lstrip(" :|+-"))
        sub = [line]
        for nxt in lines[i + 1:]:
            if len(nxt) - len(nxt.lstrip(" :|+-")) <= depth:
                break
            sub.append(nxt)
        text = "\n".join(x.strip(" :|+-") for x in sub)
        out.add(re.sub(r"#\d+L?|plan_id=\d+|id=#\d+|subquery#\d+", "", text))
    return out


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def without_initial_plans(plan: str) -> str:
    """The plan text without the "Initial Plan" of any adaptive plan in it, subqueries included."""
    out, skip = [], None
    for line in plan.splitlines():
        if skip is not None and _depth(line) >= skip:
            continue
        skip = _depth(line) if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def final_plan(df) -> str:
    df.collect()  # the frame's own execution, so its plan is the final adaptive one
    return df._jdf.queryExecution().executedPlan().toString()


class EagerWrites:
    """Notes the plan of every frame that a query writes while it is built."""

    def __init__(self):
        self.plans: list[str] = []

    def __enter__(self):
        from pyspark.sql import DataFrameWriter
        self.kept = {n: getattr(DataFrameWriter, n) for n in ("parquet", "json", "text", "csv")}
        for n, write in self.kept.items():
            def noted(writer, *args, _write=write, **options):
                self.plans.append(final_plan(writer._df))
                return _write(writer, *args, **options)
            setattr(DataFrameWriter, n, noted)
        return self

    def __exit__(self, *error):
        from pyspark.sql import DataFrameWriter
        for n, write in self.kept.items():
            setattr(DataFrameWriter, n, write)


def census(plan: str) -> dict[str, int]:
    """Operator counts of a final adaptive plan.  Exchanges are counted once
    per distinct subtree (a subquery used in several places, or pushed into a
    scan, is printed at each place but runs once); reused exchanges are
    counted apart."""
    plan = without_initial_plans(plan)
    reused = len(re.findall(r"ReusedExchange", plan))
    plan = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    out = {}
    for k, p in PATTERNS.items():
        out[k] = len(_exchange_subtrees(plan, p)) if k in EXCHANGES else len(re.findall(p, plan))
    out["reused"] = reused
    return out


def main() -> None:
    from skirmish.plans.queries import REGISTRY
    from skirmish.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# PLANS", "", f"Physical-plan census of the registered queries at `{sf_dir}` "
           "(generated by `scripts/plan_report.py`).", "",
           "Columns count operators in the final adaptive plans of the result and of everything the query writes",
           "on the way (intermediates, files, micro-batches): hash shuffles, broadcasts (both per distinct",
           "subtree, i.e. as executed after exchange reuse), join kinds, windows,",
           "top-k, hash / object-hash / sort aggregates, Parquet scans, Python evaluation, nested-loop or",
           "Cartesian joins, and exchanges reused from elsewhere in the plan.  `no-broadcast` switches size-based broadcasting off to show the plan shape at a",
           "scale where dimensions no longer fit in memory.", ""]
    for label, conf in (("default", {}), ("no-broadcast", {"spark.sql.autoBroadcastJoinThreshold": "-1",
                                                           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})):
        for k, v in conf.items():
            spark.conf.set(k, v)
        cols = [*PATTERNS, "reused"]
        out += [f"## {label}", "", "| query | " + " | ".join(cols) + " |", "|---|" + "---:|" * len(cols)]
        for name in names:
            fn = REGISTRY[name]
            with EagerWrites() as eager:
                df = fn(spark, sf_dir)
            c = collections.Counter()
            for plan in [*eager.plans, final_plan(df)]:
                c.update(census(plan))
            out.append(f"| `{name}` | " + " | ".join(str(c[k]) for k in cols) + " |")
        out.append("")
        for k in conf:
            spark.conf.unset(k)
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
