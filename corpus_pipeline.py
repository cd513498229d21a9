"""Cleaning a corpus in stages, each by an operator of ``tallymark.llm``.

Toxic documents go, of near-duplicates one document stays, personal data is replaced, the sources are interleaved to their
target weights, and the rest is packed into sequences. Each stage works on all that the one before it kept. All but the
last return the columns of ``documents``.

Every stage takes null ids, null and empty texts, very long texts, repeated rows, an empty table, and further columns of any
name, which it passes on. A null text is empty to all of them and stays null; repeated rows are near-duplicates of one
another, so that one of them stays; an empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import mixing, packing, pii, simhash, toxicity
from tallymark.llm.frames import fresh, importable, table
from tallymark.llm.queries import BLOCK_ROWS, DEFAULT_WEIGHT, MIX_WEIGHTS, toxicity_model, vocabulary
from tallymark.sources.scope import scratch_root

TOXIC_FROM = 0.7

#: No SQL: a trained model, a 64-bit hash of shingles, spans of patterns and a dynamic programme are not expressible.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``; the model learns from labelled documents that are not held out.

    Without labels, or with one label only, the score is the same everywhere: one half, or next to that label. Null and empty
    texts score as the bias does and stay.
    """
    importable(spark)
    settings = toxicity.Settings()
    leans, bias = toxicity_model(docs, table(spark, sf_dir, "labels"), settings)
    name = fresh(docs, "toxicity")
    return toxicity.score(docs, leans, bias, settings, name=name).where(F.col(name) < TOXIC_FROM).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the one with the smallest id.

    All null, empty and wordless texts are one group. Null ids come last; ties go by the text, then by the other columns.
    """
    importable(spark)
    return simhash.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kind in angle brackets in place of every span of personal data; ``n_chars``, if there, counts the new text."""
    importable(spark)
    found = pii.detect(docs, pii.fit(docs), redact=True)
    counted = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return found.withColumns(counted).select(*(F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: files one after another, and rows within them. Null sources are one source."""
    return _in_mix_order(docs)


def _in_mix_order(docs: DataFrame) -> DataFrame:
    """A mix depends on the rows alone, not on their files or order, so that whoever mixes the same rows gets it again."""
    names = {n: fresh(docs, f"mix_{n}") for n in ("block", "slot", "release", "deadline", "place")}
    placed = mixing.mix(docs, MIX_WEIGHTS, default_weight=DEFAULT_WEIGHT, block_rows=BLOCK_ROWS, names=names)
    return placed.orderBy(names["slot"], names["place"]).select(*(F.col(f"`{c}`") for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its ids and its place in a sequence of at most 4,096 tokens.

    Sequences follow the mix. Since a scan deals files and parts of them to tasks by their sizes, the order of the mix is
    made anew. A null or empty text is one token, its end.
    """
    importable(spark)
    return packing.pack(_in_mix_order(docs).select("doc_id", "source", "text"), vocabulary("word_bpe_49k.json")).select(
        "doc_id", "source", "piece.*"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What each returns is written to the shared folder and read again by the next.

    A stage's folder is removed once the next one is written, or failed; that of the last stays, since it is the result.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        try:
            stage(spark, docs, sf_dir).write.parquet(out)
        finally:
            if before is not None:
                _remove(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
