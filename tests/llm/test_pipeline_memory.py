"""What stages that share Python workers leave to each other."""

import os

import corpus_pipeline
from starloom.llm import common, packing
from starloom.llm.common import train_in_task, worker_state

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_training_drops_what_the_worker_remembers(spark):
    """The task that trains runs in a worker of earlier stages, whose memo goes before."""
    sample = spark.createDataFrame([(1, 1, "a"), (2, 0, "b")], "doc_id long, y int, text string")

    def remember(batches):
        worker_state("memo of an earlier stage", lambda: bytearray(1000))
        yield from batches

    def held(rows):
        return os.getpid(), list(common._WORKER), rows

    spark.range(8).repartition(8).mapInArrow(remember, "id long").collect()
    pid, left, rows = train_in_task(sample, held)
    assert left == [] and rows == [("a", 1), ("b", 0)] and pid != os.getpid()


def test_stages_send_small_batches(spark, documents):
    """Each stage bounds its batches; a session's own number stays."""
    before = spark.conf.get(ROWS, None)
    try:
        spark.conf.unset(ROWS)
        corpus_pipeline.packing_stage(spark, documents, "")
        assert spark.conf.get(ROWS) == str(common.BATCH_ROWS)
        spark.conf.set(ROWS, "77")
        corpus_pipeline.packing_stage(spark, documents, "")
        assert spark.conf.get(ROWS) == "77"
    finally:
        spark.conf.unset(ROWS) if before is None else spark.conf.set(ROWS, before)


def test_pieces_do_not_follow_the_memo(spark, documents):
    """A memo that starts again and again packs the same ids."""
    import public_tokenizers

    file = public_tokenizers.path("byte_bpe_50k.json")
    few = documents.limit(60).coalesce(1)
    packed = [sorted(map(tuple, packing.op8_packing(spark, few, file, public_tokenizers.PATTERN, n).collect()), key=repr) for n in (1000, packing.MEMO_BYTES)]
    assert packed[0] == packed[1] and packed[0]
