"""Print condensed physical plans of the headline queries (stored, uncached graph).

usage: python tools/explain_plans.py [sf_dir] > PLANS.md
Shows, per query: exchanges (shuffles), join strategies, and each scan's pushed
filters and read schema, so pruning and pushdown can be checked at a glance.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orbweave.plans.catalog import all_queries  # noqa: E402
from orbweave.session import build_session  # noqa: E402

KEYS = ["search_contains", "entities_controlled", "neighborhood_edges", "co_officers",
        "co_officers_sql", "khop_edges", "shortest_path_edges", "pagerank_directed",
        "stats_totals", "etl_officers", "merge_edges", "khop_nodes", "token_search_words",
        "neighborhood_batch", "match_chain_unique", "quality_report", "sample_context"]


KEEP = re.compile(r"^(Exchange|ShuffleQueryStage|BroadcastQueryStage|AQEShuffleRead|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                  r"HashAggregate|TakeOrderedAndProject|FileScan|Scan|InMemoryTableScan|Window|"
                  r"Generate|Union|BroadcastNestedLoopJoin|CartesianProduct)")


def condensed(plan, depth: int = 0, out=None) -> list[str]:
    """Key operators of the executed plan, walking ``children`` only.

    Cached frames show as one ``InMemoryTableScan`` line: their own plans ran
    once when they were materialised (BFS levels, loop inputs).
    """
    out = [] if out is None else out
    text = plan.simpleString(25)
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"Location: [^,]+, ", "", text)
    if plan.nodeName().startswith("WholeStageCodegen") or plan.nodeName() == "InputAdapter":
        pass
    elif KEEP.match(text.strip(" *")):
        out.append("  " * depth + text.strip(" *")[:420])
        depth += 1
    if "QueryStage" in plan.nodeName():
        # adaptive query stages are leaves that wrap the stage's plan
        return condensed(plan.plan(), depth, out)
    kids = plan.children()
    for i in range(kids.size()):
        condensed(kids.apply(i), depth, out)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    qs = all_queries()
    print(f"# Physical plans (condensed), {sf_dir}, graph read from its stored layout\n")
    for k in KEYS:
        df = qs[k](spark, sf_dir)
        df.collect()  # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        lines = condensed(plan)
        n_ex = sum(1 for x in lines if x.strip().startswith("Exchange"))
        print(f"## {k}\n\nshuffle exchanges: {n_ex}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
