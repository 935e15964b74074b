from pyspark.sql import functions as F

import corpus_pipeline
from regiostat.llm.common import staged, table
from regiostat.llm.decontaminate import leaks
from regiostat.llm.mixing import mixture
from regiostat.llm.near_dups import near_duplicates
from regiostat.llm.quality import quality_scores

SMALL = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_every_stage_does_what_its_operator_decides(spark):
    """Each stage against a plain filter of its input by the operator's own result."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    labels, benchmark = table(spark, SMALL, "labels"), table(spark, SMALL, "benchmark")

    good = staged(corpus_pipeline.quality(spark, docs, SMALL), "test")
    assert good.columns == columns
    assert ids(good) == ids(quality_scores(docs, labels).filter("predicted = 1"))

    single = staged(corpus_pipeline.near_dups(spark, good, SMALL), "test")
    assert single.columns == columns
    assert ids(single) == ids(near_duplicates(good).filter("kept"))

    clean = staged(corpus_pipeline.decontamination(spark, single, SMALL), "test")
    assert clean.columns == columns
    hit = {r["doc_id"] for r in leaks(single, benchmark).collect()}
    assert ids(clean) == [k for k in ids(single) if k not in hit]

    mix = staged(corpus_pipeline.mixing(spark, clean, SMALL), "test")
    assert mix.columns == columns
    drawn = {r["doc_id"]: r["copies"] for r in mixture(clean).collect()}
    assert ids(mix) == sorted(k for k, n in drawn.items() for _ in range(n))

    shards = corpus_pipeline.sharding(spark, mix, SMALL)
    rows = shards.collect()
    assert sorted(r["doc_id"] for r in rows) == ids(mix)
    assert {r["shard"] for r in rows} == set(range(16))


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dups", "decontamination", "mixing", "sharding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


NAMES = [
    "size", "h", "copy", "old_shard", "shard_", "mix_copies", "tie", "copies", "node", "gone_id", "component_id", "kept",
    "score", "label", "row", "part", "piece",
]


def through(spark, docs):
    """Tables after each stage."""
    found = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), f"test-{name}")
        found.append(docs)
    return found


def test_awkward_rows_and_clashing_names_pass_all_stages(spark, awkward):
    docs = awkward.select("doc_id", "text", "lang", "source").toDF("doc_id", "text", "lang", "source")
    more = spark.read.parquet(f"{SMALL}/documents.parquet").select(docs.columns)
    docs = docs.union(more)
    for name in NAMES:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    *stages, last = through(spark, docs)
    before = docs
    for after in stages:
        assert after.columns == docs.columns
        kept = set(map(str, after.collect()))
        assert kept <= set(map(str, before.collect()))
        before = after
    assert last.count() == before.count()
    slots = last.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.count_distinct("slot").alias("d"))
    assert slots.filter("n <> d OR m <> n - 1").isEmpty()


def test_an_empty_table_passes_all_stages(spark, none):
    for after in through(spark, none):
        assert after.count() == 0
