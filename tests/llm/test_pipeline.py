"""The pipeline as a whole on a small table with hard rows."""

import corpus_pipeline
from pyspark.sql import functions as F

from slatecraft.llm import queries


def stored(spark, data, folder, documents, **others):
    tables = {"documents": documents, "labels": None, "benchmark": None} | others
    for name, frame in tables.items():
        (spark.read.parquet(f"{data}/{name}.parquet") if frame is None else frame).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_hard_rows_go_through_all_stages(spark, data, tmp_path):
    given = spark.read.parquet(f"{data}/documents.parquet")
    columns = given.schema
    item = spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").first()["text"]
    labels = spark.read.parquet(f"{data}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    clean = [r["text"] for r in given.join(labels, "doc_id").where("length(text) > 400").orderBy("doc_id").limit(3).collect()]
    long_ = (clean[1].replace(".", " ") + ". ") * 300
    hard = [
        (90_001, None, "en", "s", 0), (90_002, "", None, None, None), (90_003, clean[0] + " " + item, "en", "s", 1),
        (90_004, long_, "en", "s", len(long_)), (90_005, clean[2], "en", "s", 1), (90_006, clean[2], "en", "s", 1), (90_006, clean[2], "en", "s", 1),
    ]
    folder = stored(spark, data, tmp_path / "tables", given.unionByName(spark.createDataFrame(hard, columns)))
    found = corpus_pipeline.run(spark, folder)
    rows = found.select("doc_id", "piece", "start", "length", "sequence_id", "offset").collect()
    ids = {r["doc_id"] for r in rows}
    assert ids <= {r["doc_id"] for r in given.select("doc_id").collect()} | {h[0] for h in hard}
    # of equal texts one stays, the one that holds an item goes
    assert not ids & {90_005, 90_006, 90_003} and 90_004 in ids
    copies = given.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).where(F.size("ids") > 1).collect()
    assert copies and all(len(ids & set(c["ids"])) <= 1 for c in copies)
    by_sequence, by_document = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_document.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for parts in by_document.values():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(parts)):
            assert (piece, start) == (k, at)
            at += length
    assert len(by_document[90_004]) > 100


def test_stages_keep_the_columns_of_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, data).columns == docs.columns, name
    assert queries.QUERIES["pipeline"] is not None and [n for n, _ in corpus_pipeline.STAGES][-1] == "best-fit packing"


def test_empty_documents(spark, data, tmp_path):
    none = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, stored(spark, data, tmp_path / "tables", none)).count() == 0
