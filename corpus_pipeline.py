"""From documents to packed token ids: every stage works on what the one before kept."""

from tallychain.llm.decontaminate import drop_contaminated
from tallychain.llm.mixing import mix, repeated
from tallychain.llm.packing import pack
from tallychain.llm.quality import keep_quality
from tallychain.llm.simhash import keep_one
from tallychain.session import written

#: The stages learn, seat and sample; no SQL expresses them.  ``tests/llm`` has them against brute force.
ORACLE_SQL = None


def quality_classifier(spark, docs, sf_dir):
    """Documents of good quality; the classifier learns from the labels of documents that it is given."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies: the one with the smallest doc_id."""
    return keep_one(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents without a window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark, docs, sf_dir):
    """Documents as often as the mix of their source takes them."""
    return repeated(mix(docs), docs.columns)


def token_packing(spark, docs, sf_dir):
    """Rows of packed token ids."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_packing),
]


def run(spark, sf_dir):
    """The stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), "stage")
    return docs
