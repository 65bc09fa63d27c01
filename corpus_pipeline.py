"""From raw documents to token ids: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. ``language``: documents whose language can't be told (null, no letter, or a score below
   ``LEAST_SCORE``) go.
2. ``near_duplicates``: of each group linked by 5-word shingles at 0.8 or more, the document
   with the smallest id stays; of rows with one id, one.
   Documents without an id or without a word are in no group and stay.
3. ``benchmark``: documents that hold a test item, exact or within its edit budget, go.
4. ``secrets``: all stay; spans of secrets are replaced by a mark, ``n_chars`` follows.
5. ``tokens``: all stay, with their byte-level BPE ids in ``ids``.

Null and empty texts go in the first stage; an empty table stays empty throughout; further
columns are kept in every stage.
"""

import public_tokenizers as tokenizers
from pyspark.sql import functions as F

from fraudlake.llm import bpe, decontaminate, jaccard_join, secrets
from fraudlake.llm import language as languages
from fraudlake.session import shared_dir

LEAST_SCORE = 0.3
WORDS, PERCENT = 5, 80  # of near duplicates
ORACLE_SQL = None  # support vector machines and byte-pair merges have no SQL form; see tests/llm


def language(spark, docs, sf_dir):
    model = languages.fit(docs.where(~languages.held_out()).select("doc_id", "text", "lang"))
    named = languages.predict(docs, model, names=("__lang", "__score"))
    known = (F.col("__lang") != languages.UNKNOWN) & (F.col("__score") >= LEAST_SCORE)
    return named.where(known).drop("__lang", "__score")


def near_duplicates(spark, docs, sf_dir):
    groups = jaccard_join.join(docs.select("doc_id", "text"), words=WORDS, percent=PERCENT)
    others = groups.where("component_id != doc_id").select("doc_id").distinct()
    left = docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    named = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(left.where("doc_id is null"))


def benchmark(spark, docs, sf_dir):
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark, docs, sf_dir):
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return secrets.redact(docs).withColumn("n_chars", length).select(*docs.columns)


def tokens(spark, docs, sf_dir):
    return bpe.encode(docs, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("secrets", secret_spans), ("tokens", tokens)]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
