"""What workers remember between tasks."""

from __future__ import annotations

import pyarrow as pa

from seisgauge.llm.memory import forgetting, remembering


def test_a_worker_forgets_when_a_task_ends(spark):
    @forgetting
    def run(batches):
        from seisgauge.llm import word_hashes

        for batch in batches:
            before = len(word_hashes._known)
            word_hashes.word_hashes([f"word{k}" for k in range(100)])
            yield pa.RecordBatch.from_arrays([pa.array([before])], names=["before"])

    # More tasks than workers, so that most find a worker that had one before.
    found = spark.range(0, 64, 1, 64).mapInArrow(run, "before long").collect()
    assert {row["before"] for row in found} == {0}


def test_tasks_of_a_step_that_encodes_pass_words_on(spark):
    @remembering
    def run(batches):
        from seisgauge.llm import word_hashes

        for batch in batches:
            before = len(word_hashes._known)
            word_hashes.word_hashes([f"word{k}" for k in range(100)])
            yield pa.RecordBatch.from_arrays([pa.array([before])], names=["before"])

    found = spark.range(0, 64, 1, 64).mapInArrow(run, "before long").collect()
    assert {row["before"] for row in found} > {0}
