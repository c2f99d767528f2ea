"""The pipeline against its stages computed one by one in plain Python."""

import hashlib

import corpus_pipeline
from baobab.llm import decontaminate, mixing, quality_rules, sharding, simhash
from baobab.llm.queries import SHARDS

SF = "/root/testdata/sf0.001"


def test_rows_follow_from_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = {r.doc_id for r in quality_rules.digest(docs).where("kept").collect()}
    kept = docs.where(docs.doc_id.isin(sorted(ids)))
    ids = {r.component_id for r in simhash.digest(kept).collect()}
    kept = docs.where(docs.doc_id.isin(sorted(ids)))
    ids = {r.doc_id for r in decontaminate.digest(kept, bench).where("not contaminated").collect()}
    kept = docs.where(docs.doc_id.isin(sorted(ids)))
    table, want = sharding.fill_table(SHARDS), []
    texts = {r.doc_id: r for r in kept.collect()}
    for r in mixing.mix_table(kept).collect():
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        want += [(*texts[r.doc_id], table[slot])] * (r.taken // r.size)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "shard"] and [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_registered_queries(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n[:n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names
