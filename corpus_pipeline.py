"""A corpus pipeline: toxic texts go, near copies go, repeated strings go, benchmark texts go, the rest is packed.

Each stage works on all that its predecessor kept. The result of a stage is written as Parquet and read
again as the ``docs`` of the next; the last one gives the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelworks.llm import decontam, neardup, packing, store, suffixdedup, toxicity
from panelworks.llm.queries import held_out, vocabulary


#: Bytes of a repeated string that goes. Fifty words of the shortest kind, of four letters and a blank, are as long;
#: the words of the documents take about six bytes.
PASSAGE_BYTES = 250


def toxic_texts_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not reject; a document is one (doc_id, text)."""
    labels = store.read(spark, sf_dir, "labels")
    whole = store.read(spark, sf_dir, "documents")
    model = toxicity.fit(whole, labels.filter(~held_out(5, 0)))
    return toxicity.without_toxic(docs, model)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of the smallest id."""
    store.prepared(spark)
    return neardup.without_copies(docs)


def repeated_strings_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its repeated strings."""
    store.prepared(spark)
    return suffixdedup.without_repeats(docs, PASSAGE_BYTES)


def benchmark_texts_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.without_contaminated(docs, store.read(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 tokens."""
    store.prepared(spark)
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxic_texts_out),
    ("minhash_near_dedup", near_copies_out),
    ("suffix_array_dedup", repeated_strings_out),
    ("benchmark_decontamination", benchmark_texts_out),
    ("best_fit_packing", packed_sequences),
]

#: The tokenizer, the classifier and the suffix order have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = store.read(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for number, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if number == last:
            return kept
        before, docs = docs, store.written(kept, name)
        store.dropped(before)  # only the tables written here
    return docs
