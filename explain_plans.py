"""Print the formatted physical plans of the headline operators (PLANS.md).

    python explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys

from tollgate.functions import SILVER_RULES
from tollgate.operators import observe_rejects, rejects, volumetry_report
from tollgate.plans import catalog as C
from tollgate.plans.run import run_quality
from tollgate.session import fresh_run_dir, local_session
from tollgate.sources.lake import land_by_app, load_sources, source_path, write_leaves
from tollgate.sources.reviews import bronze_source, silver_source


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().strip()


def main(sf: str) -> None:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    root = fresh_run_dir(spark, "plans")
    write_leaves({source_path(root, "silver", s, "20240101"): silver_source(spark, sf, s) for s in C.REVIEWS})
    for s in C.REVIEWS:
        land_by_app(bronze_source(spark, sf, s), root, "bronze", s, "20240101")
    silver = {s: ld.df for s, ld in load_sources(spark, root, "silver", "20240101").items()}
    bronze = {s: ld.df for s, ld in load_sources(spark, root, "bronze", "20240101").items()}

    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    seen = Observation("seen")
    scanned = silver["mongodb"].observe(seen, F.count(F.lit(1)).alias("n_rows"))
    quarantine, _ = observe_rejects(rejects(scanned, SILVER_RULES["mongodb"]), SILVER_RULES["mongodb"])

    sections = [
        ("Silver pattern pass (mongodb): the quarantine write's input",
         "One data pass: vectorized scan -> CollectMetrics (row total) -> Filter (OR of the ten "
         "violations) and annotation fused in one whole-stage-codegen span -> CollectMetrics "
         "(rejects, per-rule counts) -> write. No Exchange, no Sort.", quarantine),
        ("Single-rule key (rule_regex): column pruning",
         "Only the key and the rule column are read (ReadSchema).", C.q_rule_regex(spark, sf)),
        ("Bronze volumetry: one job counting every source",
         "Column-free scans (ReadSchema: struct<>) with a map-side partial count; each source's "
         "exchange carries one row per task.", volumetry_report(spark, bronze)),
        ("Bronze glob read with the app folder recovered (glob_scan)",
         "The `_metadata.file_path` constant column names each row's app folder; no extra scan.",
         C.q_glob_scan(spark, sf)),
    ]
    print("# Physical plans of the headline operators\n")
    print(f"Generated by `python explain_plans.py {sf}` (PySpark {spark.version}, AQE on).\n")
    for title, note, df in sections:
        print(f"## {title}\n\n{note}\n\n```\n{_plan(df)}\n```\n")

    res = run_quality(spark, root, "silver", "20240101", f"{root}/quality")
    tracker = spark.sparkContext.statusTracker()
    print("## Jobs of one silver run (three sources)\n")
    print("From the status tracker, by the run's job group, the jobs that open the sources "
          "included: footer inference, `isEmpty` gates (one split each), per source the file "
          "verdicts (listing, footers, one row per folder written and read back), the schema "
          "report, the three pattern passes (the only jobs that read data columns) and the append "
          "of the run metrics. Task counts are per split (one here: the inputs are single files).\n")
    print("| job | stages | tasks |\n| --- | --- | --- |")
    for j in sorted(tracker.getJobIdsForGroup(res.job_group)):
        info = tracker.getJobInfo(j)
        stages = [tracker.getStageInfo(st) for st in info.stageIds]
        names = "; ".join(st.name.split(" at ")[0] for st in stages if st)
        tasks = sum(st.numTasks for st in stages if st)
        print(f"| {j} | {names} | {tasks} |")
    print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
