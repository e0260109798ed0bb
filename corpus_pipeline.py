"""Corpus pipeline: raw documents to token-id shards in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
back as the next stage's docs. All but the last return the columns of documents.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of each group of rows linked by 5-word shingles at a similarity of 0.8 or
   more, one with the smallest id stays; repeated rows and copies without an id go as well.
3. decontaminate: words inside benchmark windows are cut; a document of which nothing else is
   left goes.
4. mix: documents are sampled by the probabilities that bring tokens to the target marginals.
5. token_files: the rest is encoded into shards; the result is what is read back from them.

Rows without a doc_id pass all stages like others. Texts without words link with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import fm_index, jaccard, mixing, quality, token_files
from loanloom.llm.storage import Scratch, table
from loanloom.session import tune

SHINGLE_WORDS, SIMILARITY = 5, (80, 100)
KEEP_TOKENS = 0.5
END_ID = 0


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judge(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), Scratch(spark, "quality"))
    return judged.where("__verdict.keep").select(docs.columns)


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "duplicates")
    # rows are linked, not ids: several may share an id or have none; stored, as a later scan could number them anew
    rows = scratch.store(docs.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("row")))
    ids = rows.select("key", F.col("row.doc_id").alias("doc_id"))
    linked = jaccard.link_documents(rows.select(F.col("key").alias("doc_id"), "row.text"), scratch, SHINGLE_WORDS, *SIMILARITY)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    stay = linked.select(F.col("doc_id").alias("key"), "component_id").join(ids, "key").groupBy("component_id").agg(
        F.min_by("key", first).alias("key"))
    return rows.join(stay, "key", "left_semi").select("row.*")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = fm_index.remove_contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), drop_emptied=True)
    return cleaned.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, Scratch(spark, "mix"), keep=KEEP_TOKENS).where("__mix.keep").select(docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = token_files.write_shards(docs, Scratch(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    found = token_files.read_documents(shards)
    return token_files.with_starts(found, shards).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_a_group),
    ("decontaminate", cut_benchmark),
    ("mix", mix_sources),
    ("token_files", write_token_files),
]

#: Stages 1 and 5 have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    tune(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
