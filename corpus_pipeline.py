"""The corpus pipeline: documents through five of the numbered operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns they were given.
A stage works on the columns ``doc_id`` and ``text`` (and ``n_chars``, ``lang`` where present) and
carries any other column along.  Empty tables give empty tables; repeated rows are judged one by
one, and a null doc_id is never the reason to drop a row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundswell.frames import materialized, settled, small
from groundswell.llm import bpe, decontaminate, jaccard_join, language, passages
from groundswell.llm.queries import held_out, table


def _short_batches(spark: SparkSession) -> None:
    """Texts are long: 2,000 of them, or 4 MB, are a large enough batch between the JVM and Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: no letters, or far from every centroid."""
    _short_batches(spark)
    learn = table(spark, sf_dir, "documents").where(~held_out("doc_id"))
    name = _free(docs, "language")
    found = language.identified(
        docs, language.fit(learn, "text", "lang"), "doc_id", "text",
        keep=tuple(c for c in docs.columns if c != "doc_id"), result=name)
    return found.where(~F.col(name)["rejected"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates.

    Texts are near duplicates when the Jaccard similarity of their five-word shingles is 0.8 or
    more, directly or over others; every such pair is found: texts whose SimHash fingerprints differ in three bits or fewer
    are linked first, each link checked on the shingles, and the others by prefixes.  Rows are judged by id and text: of rows with the
    smallest doc_id of a group, one stays, and other texts under that id are judged by their own group.
    Documents without a word are not alike in anything and stay, as do rows without a doc_id.
    """
    _short_batches(spark)
    key, text = _free(docs, "report"), ["doc_id", "report_hash"]
    found = settled(spark, lambda: jaccard_join.linked_reports(docs, "doc_id", "text", shingle=5, least=80, far=3).where(
        "group_id is not null and doc_id is not null"))
    firsts = found.groupBy("group_id").agg(F.min(F.struct(*text)).alias("first"), F.count("*").alias("n")).where("n > 1")
    crowd = materialized(found.join(firsts.select("group_id", "first"), "group_id").select(
        *text, (F.struct(*text) == F.col("first")).alias("stays")))
    gone = materialized(crowd.where(~F.col("stays")).select(*text).distinct())
    again = materialized(crowd.where("stays").groupBy(*text).count().where("count > 1").select(*text))
    rows = docs.withColumn(key, jaccard_join.report_hash("text"))

    def keyed(some: DataFrame) -> DataFrame:
        return small(some.withColumnRenamed("report_hash", key), write=False)

    out = ["doc_id", key]
    once = rows.join(keyed(again), out, "left_semi").dropDuplicates(out)
    return rows.join(keyed(gone.union(again)), out, "left_anti").unionByName(once).select(*docs.columns)


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller doc_id has; a text that loses none stays as it is."""
    _short_batches(spark)
    name = _free(docs, "passages")
    found = passages.without_repeats(
        docs, "doc_id", "text", keep=tuple(c for c in docs.columns if c != "doc_id"), result=name)
    cut = F.col(name)["n_removed"] > 0
    text = F.when(cut, F.col(name)["kept"]).otherwise(F.col("text"))
    out = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(cut, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(out).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark passages make up a twentieth or more."""
    _short_batches(spark)
    name = _free(docs, "overlap")
    found = decontaminate.contaminated(
        docs, table(spark, sf_dir, "benchmark"), "doc_id", "text",
        keep=tuple(c for c in docs.columns if c != "doc_id"), result=name)
    return found.where(~F.col(name)["contaminated"]).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text (binary, little-endian 32 bits), their number and digests."""
    _short_batches(spark)
    made = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return bpe.tokenized(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        "doc_id", "text", with_ids=True,
        keep=tuple(c for c in docs.columns if c not in ("doc_id", "text", *made)))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", passages_once),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", byte_bpe),
]

#: Automata, clusters, fingerprints and merges are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
