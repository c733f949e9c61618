"""One query per operator over the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta.llm import (
    bpe, exact_dedup, html_text, language, licenses, merkle, mixing, near_dedup, neighbours, periodic, secrets,
    token_store, warc,
)
from kwarta.llm.shared import WORD, table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record, found by the capture index and read back."""
    return warc.round_trip(table(spark, folder, "pages"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of whole texts: per document the row that stays, the group's size and the text's digest."""
    return exact_dedup.mark_copies(table(spark, folder, "documents"))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of each page."""
    return html_text.extract(table(spark, folder, "pages"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return near_dedup.classes(table(spark, folder, "documents")).drop("text_hash")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token count and digests of ids and of decoded text, per document."""
    return bpe.encode(table(spark, folder, "documents"), WORD_VOCABULARY)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document, with linked parts of credentials."""
    return secrets.find(table(spark, folder, "documents"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that each document names or is."""
    return licenses.scan(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of 150 % of all words takes of each document."""
    return mixing.mix(table(spark, folder, "documents"))


def language_model(docs: DataFrame) -> tuple:
    """Fitted on labelled documents whose id's checksum does not hold them out."""
    return language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), PIECE_VOCABULARY)


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of each document, and whether it was held out when learning."""
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = language.identify(docs, PIECE_VOCABULARY, language_model(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written to directly addressable files, and read back."""
    return token_store.round_trip(table(spark, folder, "documents"), BYTE_VOCABULARY, end_id=2)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """In a tenth of the documents, by the checksum of the id, the words from some place on repeat with some period."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words, seed = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.floor(checksum / 10)
    planted = docs.select("doc_id", "text", checksum.alias("h"), seed.alias("g"), F.when(checksum % 10 == 0, words).alias("w"))
    planted = planted.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.expr("transform(sequence(0L, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)])")
    return planted.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, and its text without the repetitions."""
    return periodic.find(with_planted_runs(table(spark, folder, "documents")))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof in the dataset's tree, and whether a later change of case shows."""
    docs = table(spark, folder, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.manifest(docs, changes={"text": merkle.lowered(docs["text"])}, where=changed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_warc": op2_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_html": op4_html,
    "op5_near_dedup": op5_near_dedup,
    "op6_bpe": op6_bpe,
    "op7_secrets": op7_secrets,
    "op8_licenses": op8_licenses,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_token_files": op11_token_files,
    "op12_periodic": op12_periodic,
    "op13_merkle": op13_merkle,
}
