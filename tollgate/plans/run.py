"""One quality run over a dated load: volumetry -> schema -> (silver) pattern.

Every footer of a load is read once, first: that gives the row totals, whether a
source holds rows, the verdict of every file, and the files that cannot be read.
Silver: then, per source, a single Spark job reads the data once: scan -> filter
on the OR of the rule violations -> annotate -> write beside the quarantine leaf,
with an Observation on that same job supplying the reject count and the per-rule
failure counts; a finished write is swapped in. Files that hold a column in
another type are read apart and checked by the same rules.
An error of one source, in any stage, is that source's: the others go on.
Nothing is cached and nothing but metric rows reaches the driver.
"""

from __future__ import annotations

import datetime as _dt
import logging
import re
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.review_rules import rules_for
from ..functions.rules import VALIDATION, Rule, quote
from ..operators.metrics import (
    JOB_FAILURE_SCHEMA, RUN_METRICS_SCHEMA, append_rows, now_iso, observe_rejects,
    record_failure, record_unreadable,
)
from ..operators.patterns import annotate, check_columns, preview_rejects, rejects
from ..operators.schemas import (
    EXPECTED_SCHEMAS, LAYERS, MATCH, NO_MATCH, LoadFiles, by_folder, expected_schema, schema_diff_rows, schema_report,
    schema_variants, survey_files, type_clashes,
)
from ..operators.volumetry import EMPTY, MISSING, OK, UNREADABLE, VolumetryError, volumetry_gate, volumetry_report
from ..session import glob_escaped, remove_path
from ..sources.local import local_frame
from ..sources.lake import (
    DEFAULT_PREFIX, SOURCES, commit_leaves, load_sources, pattern_out_path, read_parquet, recover_leaves,
    schema_files_path, schema_folders_path, schema_out_path, stage_split, staging_root, write_leaf,
)

log = logging.getLogger("tollgate.run")

SUMMARY_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("elapsed_sec", T.DoubleType()),
])


def validate_layer(layer: str) -> str:
    norm = (layer or "").strip().lower()
    if norm not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return norm


def today_odate() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d")


def validate_odate(odate: str | None) -> str:
    if odate is None:
        return today_odate()  # taken once per run
    try:
        if not re.fullmatch(r"[0-9]{8}", str(odate)):
            raise ValueError
        _dt.datetime.strptime(str(odate), "%Y%m%d")
    except ValueError:
        raise ValueError(f"odate must be a calendar date YYYYMMDD, got {odate!r}") from None
    return str(odate)


def _absent(state: str) -> str:
    """Volumetry status of a source that yielded no DataFrame."""
    return {"empty_dir": EMPTY, "unreadable": UNREADABLE}.get(state, MISSING)


def _as_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns that are declared as strings as what their values print as."""
    wanted = {f.name for f in declared.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*(F.col(quote(f.name)).cast("string").alias(f.name) if f.name in wanted and not isinstance(
        f.dataType, T.StringType) else F.col(quote(f.name)) for f in df.schema.fields))


def _united(parts: list[DataFrame], declared: T.StructType | None) -> DataFrame:
    """Checked variants as one frame. Where they disagree on a type it is the
    declared one (else string); values it cannot hold are null there."""
    if len(parts) == 1:
        return parts[0]
    own = {f.name: f.dataType for f in (declared.fields if declared is not None else [])}
    kinds: dict[str, set[str]] = {}
    for f in (f for df in parts for f in df.schema.fields):
        kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    clash = {c: own.get(c, T.StringType()) for c, k in kinds.items() if len(k) > 1}
    cast = [df.select(*(F.col(quote(c)).try_cast(clash[c]).alias(c) if c in clash else F.col(quote(c)) for c in df.columns))
            for df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def job_failures_path(quality: str) -> str:
    return f"{quality.rstrip('/')}/job_failures"


def run_metrics_path(quality: str) -> str:
    return f"{quality.rstrip('/')}/run_metrics"


@dataclass
class RunResult:
    run_id: str
    layer: str
    odate: str
    status: str  # "success" | "partial" | "failed"
    summary_rows: list[tuple] = field(default_factory=list)
    rule_failures: dict[str, dict[str, int]] = field(default_factory=dict)
    failures: list[dict] = field(default_factory=list)
    error: BaseException | None = None

    @property
    def job_group(self) -> str:
        """Spark job group of every job of this run (status tracker / event log)."""
        return f"tollgate-{self.run_id}"

    def summary(self, spark: SparkSession) -> DataFrame:
        return local_frame(spark, self.summary_rows, SUMMARY_SCHEMA)


_LOCAL_PROPS = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel",
                "spark.scheduler.pool")


def run_quality(spark: SparkSession, base: str, layer: str, odate: str | None, quality: str, *,
                sources: Sequence[str] = SOURCES, write_valid: bool = False,
                raise_on_failure: bool = True, rules: dict[str, list[Rule]] | None = None,
                expected: dict[str, T.StructType] | None = None,
                parallel_sources: int = 4, preview: int = 0, preview_truncate: bool = True,
                rebalance_rejects: bool = False, prefix: str = DEFAULT_PREFIX,
                count_rows: bool = True) -> RunResult:
    """Run the checks of ``layer`` on the ``odate`` load under ``base``.

    Bronze runs volumetry + schema; silver adds the pattern rules. Outputs go
    under ``quality``. Rejected and valid rows are written beside their leaves
    and swapped in when whole: a re-run of the same date replaces them, one whose
    write fails leaves those of the earlier run, and one that cannot check the
    load (a rule's column is missing) removes them. Runs of the same layer and
    date must not overlap. A failed run appends a row to ``<quality>/job_failures``
    and re-raises (unless ``raise_on_failure`` is false). A source that cannot be
    checked, whatever the stage - no schema is registered, footers cannot be
    listed, its rule columns are missing - is recorded there too, like each file
    that cannot be read, and the run is ``partial``; the other sources, and the
    files that can be read, are checked.

    The schema verdict looks at every file's footer, on the executors; each is a
    row of ``<quality>/schema_files/odate=D``, the verdict of each folder one of
    ``<quality>/schema_folders/odate=D``. Files that disagree on the type of a
    column do not match; in silver each variant is read with its own schema and
    checked, columns declared as strings as the strings their values print as.

    ``rules`` and ``expected`` override or extend the built-in rule sets and
    expected schemas per source (so other sources can be gated too); a
    source with no rules skips the pattern check.
    ``preview`` > 0 prints that many quarantined rows per source (off by
    default: rejected rows hold personal data); ``preview_truncate=False`` prints
    whole values. ``write_valid`` also writes the accepted rows, from the same
    pass. ``rebalance_rejects`` adds
    an AQE rebalance before the quarantine write: only rejected rows are
    shuffled, into advisory-size files; worth it when rejects are sparse
    (otherwise every scan task writes its own small file). Row totals come from
    the footers, reject counts from the write's result stage, where retried tasks
    count once: lost executors change neither.
    ``count_rows=False``: the volumetry rows of a bronze run carry no row total.
    """
    try:
        sc = spark.sparkContext
        saved = {k: sc.getLocalProperty(k) for k in _LOCAL_PROPS}
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        sc, saved = None, {}
    try:
        return _run(spark, base, layer, odate, quality, sources=sources, write_valid=write_valid,
                    raise_on_failure=raise_on_failure, rules=rules, expected=expected,
                    parallel_sources=parallel_sources, preview=preview, preview_truncate=preview_truncate,
                    rebalance_rejects=rebalance_rejects, prefix=prefix, count_rows=count_rows)
    finally:
        # restore the caller's job group, description and pool: local
        # properties are per thread and would otherwise tag later jobs
        for k, v in saved.items():
            sc.setLocalProperty(k, v)


def _run(spark: SparkSession, base: str, layer: str, odate: str | None, quality: str, *,
         sources: Sequence[str], write_valid: bool, raise_on_failure: bool,
         rules: dict[str, list[Rule]] | None, expected: dict[str, T.StructType] | None,
         parallel_sources: int, preview: int, preview_truncate: bool, rebalance_rejects: bool, prefix: str,
         count_rows: bool) -> RunResult:
    """Body of ``run_quality``."""
    try:
        layer, odate = validate_layer(layer), validate_odate(odate)
    except ValueError as exc:
        try:
            record_failure(spark, job_failures_path(quality), run_id=uuid.uuid4().hex, odate=str(odate),
                           layer=str(layer), stage="arguments", source=None, error=exc)
        except Exception as rec_exc:  # noqa: BLE001 - never mask the original error
            log.error("could not record the failure: %s", rec_exc)
        raise
    res = RunResult(uuid.uuid4().hex, layer, odate, "success")
    checks: list[tuple] = []  # source, check, status, n_rows, n_bad, elapsed
    per_rule_rows: list[tuple] = []
    vol: dict[str, list] = {}  # source -> [status, n_rows, elapsed]; first in the summary

    def tag(what: str, pool: str | None = None) -> None:
        # job group, description and scheduler pool per thread: local
        # properties do not cross into plain Python threads. Pools matter
        # under spark.scheduler.mode=FAIR (sources then share the slots);
        # under FIFO they are ignored.
        try:
            sc = spark.sparkContext
            sc.setJobGroup(res.job_group, f"tollgate {layer} {odate}: {what}")
            sc.setLocalProperty("spark.scheduler.pool", pool)
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            pass

    def fail(stage, source, err):
        res.failures.append(record_failure(spark, job_failures_path(quality), run_id=res.run_id,
                                           odate=odate, layer=layer, stage=stage, source=source,
                                           error=err))

    def fail_source(stage, source, err):
        """A source that could not be checked: on record, and the run goes on."""
        res.status = "partial"
        fail(stage, source, err)

    def finish() -> None:
        """Summary and metrics: one row per source and check, then one per rule
        (whose time is part of its source's pattern row, so it has none)."""
        res.summary_rows = [(s, "volumetry", v[0], v[1], None, round(v[2], 3)) for s, v in vol.items()] + [
            (*c[:-1], round(c[-1], 3)) for c in checks]
        tag("metrics")
        rows = [(res.run_id, odate, layer, *r, now_iso()) for r in [*res.summary_rows, *per_rule_rows]]
        append_rows(spark, rows, RUN_METRICS_SCHEMA, run_metrics_path(quality))

    def timed(what: str, fn, names: Sequence[str]) -> dict[str, tuple]:
        """(result, seconds) of ``fn`` for each source, side by side."""
        def one(s):
            tag(f"{what} {s}", pool=f"tollgate-{s}")
            t0 = time.perf_counter()
            out = fn(s)
            return out, time.perf_counter() - t0
        with ThreadPoolExecutor(max_workers=max(1, min(len(names) or 1, parallel_sources))) as pool:
            return dict(zip(names, pool.map(one, names)))

    stage = "volumetry"
    try:
        # -- volumetry ------------------------------------------------------------
        # silver: an isEmpty() gate per source (usually one task); the row total
        #         is observed on the pattern pass, so the data is read once.
        # bronze: one count job per source (its only touch of the data).
        tag("volumetry")
        loaded = load_sources(spark, base, layer, odate, sources, prefix=prefix,
                              before=lambda s: tag(f"load {s}"))
        frames = {s: ld.df for s, ld in loaded.items()}
        for s in loaded:
            remove_path(spark, f"{schema_files_path(quality, odate)}/source={s}")
        surveys: dict[str, LoadFiles | Exception] = {}

        def declared(s):
            return (expected or {}).get(s) or EXPECTED_SCHEMAS.get((s, layer))

        def measure(s):
            state = loaded[s].state
            if state in ("missing", "empty_dir"):
                return _absent(state), 0 if _absent(state) == EMPTY else None
            try:
                surveys[s] = found = survey_files(spark, s, loaded[s].path, declared(s),
                                                  f"{schema_files_path(quality, odate)}/source={s}")
                if frames[s] is None and found.n_rows:  # the file that was to give the schema is broken, others are not
                    frames[s] = _readable(s)
                    loaded[s].state = "present"
            except Exception as exc:  # noqa: BLE001 - the schema stage records it
                log.error("footers of %s cannot be read: %s", s, exc)
                surveys[s] = found = exc
            try:
                if frames[s] is None:
                    return _absent(loaded[s].state), None
                if isinstance(found, LoadFiles) and not found.n_below:
                    n = found.n_rows
                    return OK if n else UNREADABLE if found.n_unreadable else EMPTY, n if layer == "bronze" and count_rows or not n else None
                if layer == "silver" or not count_rows:
                    return volumetry_gate(spark, {s: frames[s]})[s], None
                row = volumetry_report(spark, {s: frames[s]}).first()
                return row["status"], row["n_rows"]
            except VolumetryError as exc:
                return exc.failures[s], 0 if exc.failures[s] == EMPTY else None
            except Exception as exc:  # noqa: BLE001 - a source whose rows cannot be counted
                loaded[s].error = str(exc) or repr(exc)
                loaded[s].state = "unreadable"
                return UNREADABLE, None

        def variants_of(s) -> list[DataFrame]:
            """The source's readable files, one frame for each schema."""
            return [spark.read.schema(kind).option("basePath", loaded[s].path).parquet(*map(glob_escaped, paths))
                    for kind, paths in schema_variants(spark, surveys[s], declared(s))]

        def _readable(s) -> DataFrame | None:
            """A frame with the schema of the readable files, to be reported on."""
            found = variants_of(s) if declared(s) is not None else []
            return found[0] if found else None

        for s, ((status, n), took) in timed("volumetry", measure, sources).items():
            vol[s] = [status, n, took]
        for s, ld in loaded.items():
            if ld.state == "unreadable":
                fail("load", s, ld.error)
        bad = {s: v[0] for s, v in vol.items() if v[0] != OK}
        if bad:
            raise VolumetryError(bad)

        # -- schema: strict verdict over every file, all sources ---------------------
        stage = "schema"
        folders_at = schema_folders_path(quality, odate)
        remove_path(spark, folders_at)
        clashing: set[str] = set()

        def check_schema(s):
            """(error, differences, variants of files, clashes of types)."""
            try:
                wanted = declared(s) or expected_schema(s, layer)
                if isinstance(surveys[s], Exception):
                    raise surveys[s]
                verdicts = f"{folders_at}/source={s}"
                by_folder(surveys[s].report(spark)).withColumn("layer", F.lit(layer)).write.parquet(verdicts)
                variants = [[]]
                if surveys[s].n_differing > surveys[s].n_unreadable:
                    found = read_parquet(spark, glob_escaped(verdicts)).select(F.explode("variants").alias("v")).distinct()
                    variants = [r.v for r in found.collect()]
                own = [r[2:] for r in schema_diff_rows(s, layer, frames[s].schema, wanted) if r[-1] != MATCH]
                known = {(r[0], r[-1]) for r in own}
                others = sorted({(d.column_name, None, None, d.expected_type, d.actual_type, d.status)
                                 for v in variants for d in v if (d.column_name, d.status) not in known},
                                key=lambda r: (r[0], r[-1], str(r[4])))
                return None, own + others, type_clashes(variants, wanted)
            except Exception as exc:  # noqa: BLE001 - recorded; the other sources go on
                log.error("schema check of %s failed: %s", s, exc)
                return exc, None, None

        judged = timed("schema", check_schema, sources)
        tag("schema")
        drift: dict[str, list[tuple]] = {}
        for s, ((exc, differences, clashes), took) in judged.items():
            if exc is not None:
                fail_source("schema", s, exc)
                checks.append((s, "schema", "error", None, None, took))
                continue
            drift[s] = differences
            matched = not differences and not surveys[s].n_unreadable and frames[s].schema == declared(s)
            checks.append((s, "schema", MATCH if matched else NO_MATCH, None, len(differences), took))
            if clashes:
                clashing.add(s)
                if layer != "silver":  # such files cannot be read as one table
                    fail_source("schema", s, "files disagree on the type of a column: " + "; ".join(
                        f"{c}: {' and '.join(t)}" for c, t in clashes.items()))
        broken = {s: surveys[s].n_unreadable for s in drift if surveys[s].n_unreadable}
        if broken:
            record_unreadable(spark, [surveys[s].path for s in broken], job_failures_path(quality), run_id=res.run_id,
                              odate=odate, layer=layer)
            res.status = "partial"
            res.failures += [{"run_id": res.run_id, "odate": odate, "layer": layer, "stage": "schema", "source": s,
                              "error": f"{n} files cannot be read"} for s, n in broken.items()]
        report = schema_report(spark, {s: frames[s] for s in drift}, {s: declared(s) for s in drift}, layer, drift)
        write_leaf(report.filter(f"validation_status = '{NO_MATCH}'").coalesce(1), schema_out_path(quality, odate))

        # -- pattern (silver): one pass per source ---------------------------------
        if layer == "silver":
            stage = "pattern"

            def _rules_of(s):
                if rules and s in rules:
                    return list(rules[s])
                try:
                    return rules_for(s, layer)
                except ValueError:
                    return []

            def checked(s, src_rules) -> list[DataFrame]:
                """The source as frames that one read each gives, fit for its rules."""
                survey = surveys.get(s)
                apart = s in clashing or isinstance(survey, LoadFiles) and survey.n_unreadable and declared(s) is not None
                found = [_as_declared(df, declared(s)) for df in variants_of(s)] if apart else [frames[s]]
                for df in found:
                    check_columns(df, src_rules)
                return found

            def check_source(s):
                """(error, n_rows, n_bad, per rule); n_rows is None when not known."""
                leaves = {k: pattern_out_path(quality, s, odate, k) for k in ("pattern", "valid")}
                root = staging_root(quality, layer, odate, s)
                staging = f"{root}/{res.run_id}"
                try:
                    recover_leaves(spark, root)
                    src_rules = _rules_of(s)
                    try:
                        parts = checked(s, src_rules) if src_rules else []
                    except ValueError:  # this load cannot be checked: what an earlier one left is not its own
                        for leaf in leaves.values():
                            remove_path(spark, leaf)
                        raise
                    if not src_rules:
                        for leaf in leaves.values():
                            remove_path(spark, leaf)
                        return None, None, None, None
                    survey = surveys.get(s)
                    total = survey.n_rows if isinstance(survey, LoadFiles) and not survey.n_below else None
                    seen = None
                    if total is None and not rebalance_rejects:  # counted on the way, in the result stage
                        seen = Observation()
                        parts = [df.observe(seen, F.count(F.lit(1)).alias("n_rows")) for df in parts]
                    elif total is None:  # the way leads over an exchange
                        total = sum(df.count() for df in parts)
                    if write_valid:
                        both, obs = observe_rejects(_united([annotate(df, src_rules) for df in parts], declared(s)), src_rules)
                        staged = stage_split(both, VALIDATION, (NO_MATCH, MATCH), staging)
                        moves = {leaves["pattern"]: staged[NO_MATCH], leaves["valid"]: staged[MATCH]}
                    else:
                        rej = _united([rejects(df, src_rules) for df in parts], declared(s))
                        if rebalance_rejects:
                            rej = rej.hint("rebalance")
                        # observed in the write's result stage (after any exchange):
                        # accumulator updates of result tasks count once, retries or not
                        rej, obs = observe_rejects(rej, src_rules)
                        write_leaf(rej, f"{staging}/pattern")
                        moves = {leaves["pattern"]: f"{staging}/pattern", leaves["valid"]: None}
                    commit_leaves(spark, staging, moves)
                    got = obs.get
                    per_rule = {r.name: int(got.get(f"failed_{r.name}", 0)) for r in src_rules}
                    if preview and any(per_rule.values()):
                        preview_rejects(read_parquet(spark, leaves["pattern"]), preview, preview_truncate)
                    n_rows = int(seen.get["n_rows"]) if seen else total
                    return None, n_rows, int(got.get("n_bad", 0)), per_rule
                except Exception as exc:  # noqa: BLE001 - recorded; the other sources go on
                    log.error("pattern check of %s failed: %s", s, exc)
                    return exc, None, None, None

            def rows_of(s):
                """The row total of a source whose check failed, if it can be had."""
                survey = surveys.get(s)
                if isinstance(survey, LoadFiles) and survey.exact:
                    return survey.n_rows
                try:
                    return frames[s].count()
                except Exception as exc:  # noqa: BLE001 - the failure itself is on record
                    log.error("rows of %s cannot be counted: %s", s, exc)
                    return None

            # Independent jobs, one per source, submitted together so small
            # sources do not queue behind large ones.
            for s, ((exc, n_rows, n_bad, per_rule), took) in timed("pattern", check_source, sources).items():
                if exc is not None:
                    vol[s][1] = rows_of(s)
                    fail_source("pattern", s, exc)
                    checks.append((s, "pattern", "error", vol[s][1], None, took))
                elif per_rule is None:  # no rules for this source
                    vol[s][1] = surveys[s].n_rows if isinstance(surveys.get(s), LoadFiles) and surveys[s].exact else None
                    checks.append((s, "pattern", "skipped", None, None, took))
                else:
                    vol[s][1] = n_rows
                    res.rule_failures[s] = per_rule
                    checks.append((s, "pattern", NO_MATCH if n_bad else MATCH, n_rows, n_bad, took))
                    per_rule_rows.extend((s, f"pattern.{name}", NO_MATCH if n else MATCH, n_rows, n, None)
                                         for name, n in per_rule.items())
        stage = "metrics"
        finish()
    except Exception as exc:  # noqa: BLE001 - every failure is recorded, then re-raised
        res.status, res.error = "failed", exc
        log.error("quality run failed at %s: %s", stage, exc)
        try:
            fail(stage, None, exc)
            if stage != "metrics":
                finish()
        except Exception as rec_exc:  # noqa: BLE001 - never mask the original error
            log.error("could not record the failure: %s", rec_exc)
        if raise_on_failure:
            raise
    return res


__all__ = ["JOB_FAILURE_SCHEMA", "RunResult", "SUMMARY_SCHEMA", "job_failures_path",
           "run_metrics_path", "run_quality", "today_odate", "validate_layer", "validate_odate"]
