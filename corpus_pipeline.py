"""The corpus pipeline: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder and reads it
back as the next stage's documents. All but the last return the columns of ``documents``, also where
the input has further columns.

* ``language``: documents without a letter, whose language is ``und``, go, and those whose score is below ``LEAST_SCORE``.
  Documents without a language get the predicted one, by which ``mixing`` weighs them; where no row has a language to learn from, the letters
  alone decide.
* ``near_dedup``: of each group of near duplicates the document with the smallest id stays, once.
* ``suffix_dedup``: repeated strings of 100 bytes are cut out; ``n_chars`` counts what is left, bytes that a cut
  left of a character go with it, and documents with nothing left go.
* ``decontaminate``: documents that share a window of words with a benchmark item go.
* ``mixing``: documents are sampled to the target weights; the last stage adds topic, tokens and probability.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import decontaminate, language, mixing, near_dedup, suffix_dedup
from newslake.llm.common import has_bit, id_bits, id_place, map_batches, table, text_or_empty
from newslake.session import released, settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A text that wins each of its duels scores at least 0.5 in both steps, so at least 0.25 in all: only one that loses a duel can score less.
LEAST_SCORE = 0.25
ORACLE_SQL = None  # the language models and the suffix sort are not expressible; tests/llm/test_pipeline.py compares every stage with a plain version


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of documents whose id is not in a settled narrow table. Only rows that share a bit with one of its ids meet it."""
    bits = id_bits(gone)

    @F.arrow_udf("boolean")
    def suspect(place: pa.Array) -> pa.Array:
        return has_bit(bits.value, place)

    left = docs.where(~suspect(id_place()))
    return left.unionByName(docs.where(suspect(id_place())).join(gone, "doc_id", "left_anti"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uses the text and the learned model, if any; every row is decided where it is read."""
    model = language.fit(docs)
    if model is None:
        return docs.select(COLUMNS).where(text_or_empty().rlike(r"\p{L}"))
    found = language.labelled(docs.select(COLUMNS), model)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat an id or have none are kept once per id and text. What near_dedup wrote in between is gone before the next stage."""
    with released(spark) as tables:
        found = settle(near_dedup.near_duplicates(docs).select("doc_id", "kept"), "near-found")
        tables.pop()
    # All rows of an id are kept or none, and those without an id always are.
    left = _without(docs.select(COLUMNS), settle(found.where(~F.col("kept")).select("doc_id").distinct(), "gone-ids"))
    repeated = settle(found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if not repeated.take(1):
        return left
    same = F.col("d.doc_id").eqNullSafe(F.col("i.doc_id"))
    single = left.alias("d").join(repeated.alias("i"), same, "left_anti")
    return single.unionByName(left.alias("d").join(repeated.alias("i"), same, "left_semi").dropDuplicates(["doc_id", "text"]))


def _readable(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    texts = [k.as_py().decode("utf-8", "ignore") for k in batch.column("kept")]
    out = [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("lang"), batch.column("source"),
           pa.array([len(t) for t in texts], pa.int64())]
    return [pa.RecordBatch.from_arrays(out, COLUMNS)]


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, carry=["lang", "source"]).where("n_bytes = 0 or n_removed < n_bytes")
    return map_batches(cut.select("doc_id", "kept", "lang", "source"), _readable, "doc_id long, text string, lang string, source string, n_chars long")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select("doc_id").distinct()
    found = settle(found, "contaminated-ids").alias("i")
    return docs.select(COLUMNS).alias("d").join(found, F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sampled(docs.select(COLUMNS))


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with released(spark) as tables:
            docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
            tables.pop()
    return docs
