"""Print the physical plan (formatted) of registered queries, or a summary
of shuffles / broadcasts / scans per query.

usage: python tools/plans.py [--summary] [sf_dir] [name ...]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    summary = "--summary" in args
    args = [a for a in args if a != "--summary"]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = get_session(master="local[8]", shuffle_partitions=16)
    for n in names:
        df = QUERIES[n](spark, sf)
        if summary:
            p = df._jdf.queryExecution().executedPlan().toString()
            ex = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", p))
            bc = len(re.findall(r"BroadcastExchange", p))
            single = len(re.findall(r"Exchange SinglePartition", p))
            sorts = len(re.findall(r"\bSort \[", p))
            win = len(re.findall(r"\bWindow \[", p))
            py = len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", p))
            print(f"{n:22s} shuffles={ex:2d} single={single} broadcasts={bc} sorts={sorts} windows={win} python={py}")
        else:
            print("=" * 30, n)
            df.explain(mode="formatted")


if __name__ == "__main__":
    main()
