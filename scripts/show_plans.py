"""Print the physical plan (tree + scan details) of every registered query.

Usage: python scripts/show_plans.py [sf_dir] [key ...] > plans.txt
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrace.plans.queries import QUERIES  # noqa: E402
from terrace.session import get_spark  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or sorted(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    for k in keys:
        df = QUERIES[k](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(mode)
        blocks = text.split("\n\n")
        tree = blocks[0]
        scans = [b for b in blocks[1:] if re.match(r"\(\d+\) Scan ", b)]
        scans = [re.sub(r"Location: .*\n", "", b) for b in scans]
        print(f"===== {k}\n{tree}\n")
        for b in scans:
            print(b + "\n")


if __name__ == "__main__":
    main()
