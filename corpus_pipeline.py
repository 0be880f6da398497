"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything that the one before kept. All but the last return the columns
of docs, extra ones too. An empty table goes through every stage and gives no rows; the other cases are stated by stage.
A stage begins by giving back the heap that the one before has left.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import decontaminate, jaccard_join, language_id, packing, pii
from paperloom.llm.common import table
from paperloom.operators.store import discard, materialize, release_heaps, scratch

#: A text whose words speak for its language by less than this is rejected; even odds among four languages give 0.25, a text of one language 0.8 to 1.
LEAST_SCORE = 0.4


def stage(f):
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_heaps(spark)
        return f(spark, docs, sf_dir)

    return run_stage


@stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts, texts without a letter, undecided texts. A null lang becomes the predicted
    one. Repeated rows fare alike; of languages that tie the first counts; very long texts are scored whole; without any label
    every document is dropped."""
    model = language_id.fit(docs.filter(~language_id.held_out("doc_id")))
    return language_id.keep_identified(docs, model, LEAST_SCORE)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked ones: that of the least id, null last; of rows equal in id and text one.
    Documents without words (null texts too) are linked with nothing and stay; very long texts are compared whole."""
    return jaccard_join.deduplicate(docs)


@stage
def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark; null and empty texts are clean and stay, repeated rows fare alike, very long
    texts are judged by their whole share of hit words, exactly a twentieth counts as contaminated."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


@stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in every text and keeps n_chars in step; null and empty texts stay as they are, repeated rows fare alike,
    of spans that overlap the first one's kind is written; very long texts are masked whole."""
    return pii.mask_pii(docs, pii.fit(docs))


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens; null is empty text, of one token; repeated rows are packed one by
    one; only documents of more tokens are cut; of sequences that fit equally well the oldest takes the piece."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", decontaminate_documents),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: The stages are no SQL: trained models, a tokenizer and a packing heuristic. The tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        before = docs
        with scratch(spark) as made:  # what a stage wrote on its way goes once its result is written
            docs = materialize(f(spark, before, sf_dir), name)
            made.remove(docs._paperloom_path)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
