"""Command line: ``spark-submit tollgate/cli.py <layer> --base B --quality Q [--odate D]``.

Exit code 0 on success (also when rows are rejected: rejects are data, not
errors), 1 when the run failed (the failure is in ``<quality>/job_failures``),
2 when some source could not be checked.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tollgate.sources.lake import DEFAULT_PREFIX  # noqa: E402
from tollgate.functions.rules import rules_from_dicts  # noqa: E402
from tollgate.plans.run import run_quality  # noqa: E402


class _Parser(argparse.ArgumentParser):
    """A usage error is a failed run (1); 2 says that a source was not checked."""

    def error(self, message: str):
        self.print_usage(sys.stderr)
        self.exit(1, f"{self.prog}: error: {message}\n")


def main(argv: list[str] | None = None) -> int:
    p = _Parser(prog="tollgate", description=__doc__.splitlines()[0])
    p.add_argument("layer", help="bronze or silver")
    p.add_argument("--base", required=True, help="lake root holding <layer>/<prefix>/<source>/...")
    p.add_argument("--quality", required=True, help="root of the quality outputs")
    p.add_argument("--odate", default=None, help="load date YYYYMMDD (default: today, UTC)")
    p.add_argument("--prefix", default=DEFAULT_PREFIX, help="domain path between layer and sources")
    p.add_argument("--write-valid", action="store_true", help="also write accepted rows")
    p.add_argument("--rebalance-rejects", action="store_true", help="compact sparse rejects")
    p.add_argument("--preview", type=int, default=0, help="print N quarantined rows per source")
    p.add_argument("--preview-full", action="store_true", help="print their values in full width")
    p.add_argument("--no-count", action="store_true",
                   help="bronze: gate on emptiness only, skip the row-count pass")
    p.add_argument("--rules", default=None,
                   help="JSON file {source: [{column, kind, pattern, ...}]} overriding the built-in rules")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    rules = None
    if a.rules:
        with open(a.rules, encoding="utf-8") as fh:
            rules = {src: rules_from_dicts(items) for src, items in json.load(fh).items()}
    spark = SparkSession.builder.appName(f"tollgate-{a.layer}").getOrCreate()
    try:
        res = run_quality(spark, a.base, a.layer, a.odate, a.quality, prefix=a.prefix,
                          write_valid=a.write_valid, rebalance_rejects=a.rebalance_rejects,
                          preview=a.preview, preview_truncate=not a.preview_full, raise_on_failure=False, rules=rules,
                          count_rows=not a.no_count)
    except ValueError as exc:  # bad arguments
        logging.error("%s", exc)
        return 1
    for row in res.summary_rows:
        logging.info("summary %s", row)
    return {"success": 0, "partial": 2}.get(res.status, 1)


if __name__ == "__main__":
    sys.exit(main())
