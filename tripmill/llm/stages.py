"""The stages of the corpus pipeline: each takes documents and gives documents, the last one pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import decontaminate, language, packing, simhash, substring
from tripmill.llm.common import bounded, table
from tripmill.llm.queries import held_out, word_vocabulary

#: A document whose best language is less probable than this is rejected.
MIN_LANGUAGE_SCORE = 0.5


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under neutral column names, so that no column of it clashes, and the name of each."""
    names = {name: f"__column_{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those no language explains; `lang` stays as given."""
    bounded(spark)
    langs, log_probs = language.learn(docs, train=~held_out())
    plain, names = masked(docs)
    found = language.identify(plain, langs, log_probs, text_column=names["text"])
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col(c).alias(n) for n, c in names.items()])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the least id."""
    bounded(spark)
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that occur more than once; a text with nothing to cut stays as it is."""
    bounded(spark)
    plain, names = masked(docs)
    cut = F.col("n_removed") > 0
    found = substring.remove_repeats(plain, id_column=names["doc_id"], text_column=names["text"])
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(
        *[F.when(cut, new[n]).otherwise(F.col(c)).alias(n) if n in new else F.col(c).alias(n) for n, c in names.items()]
    )


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_copies(docs, table(bounded(spark), sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; the rows of op8_packing over the documents that are left."""
    bounded(spark)
    return packing.pack(docs, word_vocabulary).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
