"""The processing job for ``spark-submit``: ``refresh_job.py ROOT TARGET [--state FOLDER] [--endpoints a,b] [--parallel n]``.

Prints the run report and exits with 1 if any endpoint failed.  With ``--state`` a run takes up only what landed since
the last run with that folder; without it every collection is replaced from all landed files.
"""

from __future__ import annotations

import argparse
import sys

from snapstats.fixed_values import ENDPOINT_MODES
from snapstats.plans.continued import continue_collections
from snapstats.plans.refresh import exit_code, refresh_collections, report_tallies
from snapstats.session import build_session


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root", help="folder that holds raw/<endpoint>/")
    parser.add_argument("target", help="folder of the result collections")
    parser.add_argument("--endpoints", help="comma-separated names; all by default")
    parser.add_argument("--parallel", type=int, default=4, help="endpoints processed side by side")
    parser.add_argument("--stamps", choices=("utc", "text", "lenient"), default="utc")
    parser.add_argument("--state", help="folder of what earlier runs took; must not be shared by runs at one time")
    options = parser.parse_args(arguments)
    names = options.endpoints.split(",") if options.endpoints else list(ENDPOINT_MODES)
    endpoints = {name: ENDPOINT_MODES.get(name, "generic") for name in names}
    spark = build_session("snapstats-refresh")
    how = {"endpoints": endpoints, "parallel": options.parallel, "stamps": options.stamps}
    if options.state:
        report = continue_collections(spark, options.root, options.target, options.state, **how).cache()
    else:
        report = refresh_collections(spark, options.root, options.target, **how).cache()
    report.show(len(endpoints), truncate=False)
    report_tallies(report).show()
    return exit_code(report)


if __name__ == "__main__":
    sys.exit(main())
