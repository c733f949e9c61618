"""From raw documents to token ids: the stages, and the query that runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kwarta.llm import bpe, exact_dedup, language, mixing, near_dedup
from kwarta.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY, language_model
from kwarta.llm.shared import table, written


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID does not reject: null and empty texts, and those without a letter, go.

    A corpus without labels, from which no language is learned, stays but for these. Repeated rows stay. Empty table:
    no rows. All columns are carried, whatever their names.
    """
    names = docs.columns
    own = {n: f"_own_{i}" for i, n in enumerate(names) if n != "text"}
    rows = docs.select(*(docs[f"`{n}`"].alias(own.get(n, n)) for n in names))
    found = language.identify(rows, PIECE_VOCABULARY, language_model(docs), columns=rows.columns)
    return found.where(~found["rejected"]).select(*(found[own.get(n, n)].alias(n) for n in names))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with identical text, the one with the largest doc_id; of rows with neither, one. A null text is an
    empty one. Empty table: no rows. All columns are carried, whatever their names."""
    rows = docs.withColumnsRenamed({n: f"_own_{n}" for n in docs.columns})
    kept = exact_dedup.mark_copies(rows, "_own_text", "_own_doc_id", columns=rows.columns, dropped=False)
    return kept.select(rows.columns).withColumnsRenamed({f"_own_{n}": n for n in docs.columns})


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest doc_id. Null, empty and wordless texts are like no other and
    stay. Empty table: no rows. All columns are carried, whatever their names."""
    return near_dedup.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document occurs as often as the mix takes it. A null source is one of its own;
    documents without words are taken like others. Empty table: no rows. All columns are carried, whatever their names."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; none for null and empty texts. Repeated rows give repeated results. Empty table: no
    rows. Other columns are not read."""
    return bpe.encode(docs, WORD_VOCABULARY, columns=("doc_id", "lang", "source"), ids=True)


STAGES = [
    ("language", identify),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mix),
    ("BPE encoding", encode),
]

#: SQL cannot express the models and draws; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
