"""Print the formatted physical plan of registered driver queries.

usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daymart.plans import tpch  # noqa: E402
from daymart.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name in args or sorted(tpch.QUERIES):
        print(f"===== {name}")
        tpch.QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
