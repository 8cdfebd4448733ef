"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents``:

1. quality classifier: documents whose score is below the threshold go;
2. SimHash near-dedup: one document of each class stays; documents are linked
   if the fingerprints of their four-word shingles differ in four bits at most;
3. benchmark decontamination: documents that hold a test item go;
4. mixing: documents are repeated by their rates, so that the domains' tokens
   come to the target weights; no document goes;
5. token files: the documents' ids in compressed blocks, read back.

Empty tables pass through every stage; null texts count as empty, so those
without a word are one class of the second stage. Rows are told apart by their
place in the stage's written input, so repeated rows and ids, or none, do no
harm; of a class the row read first stays. Columns of any other name, those
that a stage uses for itself too, are handed on as they are. Texts are taken
whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, mixing, quality_knn, simhash, token_files
from tidewatch.llm.common import cut, doc_bucket, read_table

QUALITY_THRESHOLD = 0.3
SHINGLE_WORDS, MAX_BITS = 4, 4
ITEM_SHARE = 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = quality_knn.train(docs, labels, doc_bucket(5) != 0)
    return quality_knn.keep_good(docs, model, QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, SHINGLE_WORDS, MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), ITEM_SHARE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    classifier = mixing.train(mixing.labelled_by_language(docs, labels), list(mixing.TARGETS))
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    mixed = mixing.mix(rows, classifier, mixing.TARGETS, carry=["row"])
    times = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("_mix_copies")))
    return mixed.select("row", F.explode(times)).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.op4_token_files(docs)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mix),
          ("token-ID / binary output", tokens)]

#: Learned models, an iterative fit and a tokenizer are not SQL; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
