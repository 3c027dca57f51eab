"""From raw documents to token ids: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, mixing, pii, simhash, toxicity
from tallyloom.llm.common import labelled_sample, stored, table
from tallyloom.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS, MOST_LABELLED, PII_KEY, mix_budget, mix_domain

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labelled rows of ``docs``.

    Null and empty texts score as the model's bias says; a null doc_id or other null column stays
    as it is, repeated rows are judged alike, an empty table gives none. Only the columns of
    documents go on, so others cannot clash.
    """
    sample = labelled_sample(table(spark, sf_dir, "labels"), docs, "toxic", MOST_LABELLED)
    scored = toxicity.score(docs.select(*COLUMNS), toxicity.fit(sample), column="toxic_score")
    return scored.filter(toxicity.predicted(F.col("toxic_score")) == 0).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id.

    Rows that repeat that id with the same text count once, with other texts each text stays,
    so no group loses its last text. Rows without an id stay, once for each text, if some group
    has no row with an id.
    """
    found = simhash.near_duplicates(docs, words_each=3, distance=3)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    rest = F.struct(*[F.col(name) for name in COLUMNS if name != "doc_id"])
    marked = rows.select("doc_id", rest.alias("row"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("mark"))
    one = marked.groupBy("doc_id", "mark").agg(F.min("row").alias("row"))
    return one.select("doc_id", *[F.col(f"row.{name}").alias(name) for name in COLUMNS if name != "doc_id"])


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates for personal data; n_chars follows the new text, and stays null if it was.

    Null and empty texts, texts without personal data and repeated rows pass unchanged; an empty
    table gives none.
    """
    replaced = pii.surrogates(docs.select(*COLUMNS), PII_KEY)
    return replaced.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture draws it.

    A null language or source is a leaf called ``unknown``; null and empty texts have no tokens, so
    whole epochs repeat them and a remainder may hold them; repeated rows tie and are drawn together.
    An empty table gives none.
    """
    return mixing.mix(docs.select(*COLUMNS), mix_domain(), MIX_WEIGHTS, mix_budget(), MIX_EPOCHS, MIX_SEED)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the packed ids of each drawn document.

    The task that encodes a text decodes its ids and compares them with the bytes of the text; a
    difference stops the run. Null and empty texts have no ids, repeated rows stay, an empty table
    gives none.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bpe.encode(spark, docs.select(*COLUMNS), path, public_tokenizers.PATTERN, intact="intact")
    wrong = F.raise_error(F.concat(F.lit("decoded ids differ from the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    ids = F.when(F.col("intact"), F.col("ids")).otherwise(wrong.cast("binary"))
    return tokens.select("doc_id", "lang", "source", bpe.token_count(F.col("ids")).alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii_surrogates", replace_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", tokenise),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
