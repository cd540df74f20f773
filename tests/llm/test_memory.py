"""What keeps an executor's memory down: few tasks for the passes over a bounded
sample, small Arrow batches, caches that go with their operator."""

import pyarrow as pa
import pytest

import corpus_pipeline
from tollgate.llm import boosting, common
from tollgate.session import ARROW_BATCHES, bound_batches


def test_training_passes_run_in_few_tasks(spark):
    rows = [([float(i % 7), float(i % 3)], int(i % 7 > 3), i) for i in range(300)]
    sample = spark.createDataFrame(rows, "features array<double>, label int, key long").repartition(40).persist()
    sample.count()
    sc = spark.sparkContext
    sc.setJobGroup("few-tasks", "trees")
    try:
        model = boosting.fit(sample, rounds=3, depth=2)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sample.unpersist()
    assert len(model.trees) == 3
    tracker = sc.statusTracker()
    sizes = [info.numTasks for job in tracker.getJobIdsForGroup("few-tasks") for stage in tracker.getJobInfo(job).stageIds
             if (info := tracker.getStageInfo(stage))]
    # the scan's partitions are counted, split and cached, but no round of training runs over them (12 such stages)
    assert len(sizes) >= 12 and sum(n >= 40 for n in sizes) < 8


def _batch_rows(session):
    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    return [r.n for r in session.range(0, 5_000, 1, 1).mapInArrow(count, "n long").collect()]


def test_batches_for_python_are_small_unless_the_caller_set_them(spark):
    ours, theirs = spark.newSession(), spark.newSession()
    theirs.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2500")
    bound_batches(ours)
    bound_batches(theirs)
    assert _batch_rows(ours) == [1_000] * 5
    assert _batch_rows(theirs) == [2_500] * 2


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_bounds_its_batches(spark, tmp_path, stage):
    session = spark.newSession()
    session.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    session.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = session.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert stage(session, docs, str(tmp_path)).count() >= 1
    assert {k: session.conf.get(k).rstrip("b") for k in ARROW_BATCHES} == ARROW_BATCHES


def test_a_workers_cache_goes_when_forgotten():
    assert common.worker_cache("someone", lambda: [1]) == [1]
    common.forget_cache()
    assert common._worker["value"] is None
