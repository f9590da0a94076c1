"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

1. language_id: documents without a recognisable language go (no letter, or no
   language that holds ``MIN_LANGUAGE`` of the words).
2. ngram_jaccard: of each group of near copies (five-word shingles, similarity
   0.8 or more) the row with the smallest doc_id stays.
3. decontaminate: documents that hold a window of a benchmark item go.
4. mixing: rows are repeated or thinned by rates that bring the domains'
   expected tokens to the target weights.
5. token_ids: texts are written as token ids and read back by key.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangscope.llm import decontaminate, language_id, mixing, ngram_join, token_store
from hangscope.llm.common import own_names, table, written
from hangscope.llm.queries import END_ID, tokenizer_path

MIN_LANGUAGE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    # columns that are named like a result stand aside meanwhile
    aside = dict(zip([c for c in docs.columns if c.lower() in ("lang_pred", "score")], own_names(docs, 2)))
    labelled = language_id.identify(docs.withColumnsRenamed(aside), model, keep_text=True)
    known = labelled.filter((F.col("lang_pred") != language_id.UND) & (F.col("score") >= MIN_LANGUAGE))
    return known.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_rates(docs, mixing.mix(docs, table(spark, sf_dir, "labels")))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store.store_digests(docs, tokenizer_path("byte_bpe_50k.json"), END_ID)


STAGES = [("language_id", language_stage), ("ngram_jaccard", jaccard_stage), ("decontaminate", decontaminate_stage),
          ("mixing", mixing_stage), ("token_ids", token_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
