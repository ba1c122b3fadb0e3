import os
import random
import subprocess
import sys

import __spark_entry__
import corpus_pipeline
from tests_llm_words import words


def test_stages_take_effect(spark, tmp_path):
    r = random.Random(33)
    vocabulary = [words(r, 1) for _ in range(400)]
    text = lambda n: " ".join(r.choices(vocabulary, k=n))
    base, passage = text(200), words(r, 30)
    near = base.split()
    near[100] = "changed"
    rows = [(i, text(150)) for i in range(150)]
    rows += [(200, base), (201, base), (202, " ".join(near)), (210, "too short"), (211, "again and again " * 60),
             (220, f"{text(80)} {passage} {text(20)}"), (230, f"{text(100)} write to someone@example.org now")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    step = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        step = stage(spark, step, str(tmp_path))
        step.write.parquet(f"{tmp_path}/{name}")
        step = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {x.doc_id for x in step.collect()}
        assert number == 4 or step.columns == docs.columns
    everything = {i for i, _ in rows}
    assert everything - kept["quality_rules"] == {210, 211}
    assert kept["quality_rules"] - kept["ngram_jaccard"] == {201, 202}
    assert kept["ngram_jaccard"] - kept["decontamination"] == {220}
    assert kept["personal_data"] == kept["decontamination"] == kept["best_fit_packing"]
    clean = {x.doc_id: x for x in spark.read.parquet(f"{tmp_path}/personal_data").collect()}
    assert "<EMAIL>" in clean[230].text and clean[230].n_chars == len(clean[230].text)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {x.doc_id for x in whole.collect()} == kept["best_fit_packing"]


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_worker_hands_its_freed_memory_back():
    """In a process of its own, as the allocator's state counts: freed pieces below pieces that stay."""
    code = """
import numpy as np
from lossgrain.llm.common import hand_back
def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096
pieces = [np.ones(8000) for _ in range(4000)]
kept, full = pieces[-1], resident()
del pieces
freed = resident()
hand_back()
print(full - freed, full - resident())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    before, after = map(int, out.stdout.split())
    assert after > 200_000_000 > before


def test_long_texts_go_to_workers_in_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    @corpus_pipeline.in_small_batches
    def stage(spark, docs, sf_dir):
        return docs.mapInArrow(sizes, "n bigint")

    docs = spark.range(8000, numPartitions=1).selectExpr("repeat('x', 4000) as text")
    found = [x.n for x in stage(spark, docs, "").collect()]
    assert sum(found) > 32_000_000 and max(found) < 6_000_000
    assert all(hasattr(f, "__wrapped__") for _, f in corpus_pipeline.STAGES)
