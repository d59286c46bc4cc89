"""From raw documents to token ids: the stages of a training corpus, each over all that the one before has kept.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame; run() writes each result as Parquet into the
shared folder and reads it again for the next. All but the last return the columns of `documents`.

1. toxicity: documents that score 0.3 or more go. The model learns from `labels` whose id is in no held-out fold.
2. near duplicates: of each class of texts that share 0.8 of their five-word shingles or more, the first by doc_id stays.
   Rows without doc_id come last, and are deduplicated likewise.
3. decontamination: documents in which a benchmark window occurs go.
4. mixing: each document as often as its source's budget takes it; the one at the cut is cut there.
5. token ids: Huffman-coded files of the mix, read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.llm import binary, decontam, mixing, simhash, toxicity
from lakeferry.llm.common import remove, table, work_dir
from lakeferry.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


#: Pieces the tokenizer remembers: fewer than by default, beside what the other stages leave in the workers.
CACHE = 100_000


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "binary")
    binary.write(docs, folder, tokenizer(), cache=CACHE)
    return binary.read(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The hashes, the learned model and the tokenizer are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(folder)
        docs = spark.read.parquet(folder)
        if last:
            remove(spark, last)
        last = folder
    out = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, last)
    return out
