import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from wayfare.llm import decontaminate


def test_stages_take_texts_in_batches_of_a_few_megabytes(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text"))
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], ["bytes", "rows"])

    try:
        corpus_pipeline.decontamination(spark, docs, str(tmp_path))
        seen = docs.mapInArrow(sizes, "bytes long, rows long").collect()
    finally:
        spark.conf.set(key, before)
    assert sum(r.rows for r in seen) == 2000
    assert max(r.bytes for r in seen) < 2 * corpus_pipeline.BATCH_BYTES


def test_one_automaton_holds_no_batches():
    taken = []

    def batches():
        for i in range(3):
            taken.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(["a b"])], ["text"])

    assert next(decontaminate._held(batches(), 0)) and taken == [0]
