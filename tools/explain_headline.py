"""Print the physical plan of every headline query (AQE initial plan) at a
scale factor, lines cut to 170 characters: python tools/explain_headline.py [SF_DIR]"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ashgrid.catalog import HEADLINE, QUERIES
    from ashgrid.session import local_session

    spark = local_session()
    for name in HEADLINE:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n\n```")
        for line in plan.splitlines():
            print(line[:170])
        print("```\n")


if __name__ == "__main__":
    main()
