"""Documents to training tokens: each stage works on what the one before it kept and wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from larder.llm.rows import fresh
from larder.session import materialize


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a number each, in a column of its own. Documents are read from files, which give a row the same
    number whenever they are read."""
    name = fresh(docs, "_row")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Documents whose other columns have names that no operator uses, and what those were."""
    own = {f"_own_{i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.select("doc_id", "text", *[F.col(c).alias(name) for name, c in own.items()]), own


def _together(found: DataFrame, docs: DataFrame, own: dict[str, str]) -> DataFrame:
    return found.select("doc_id", "text", *[F.col(name).alias(c) for name, c in own.items()]).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the chain, fitted on the labels of these documents, takes for toxic go.

    Rows that repeat an id are judged one by one; a null text and a row without an id are judged like others.
    """
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    renamed, own = _apart(docs)
    return _together(toxicity.score(renamed, model).where("not is_toxic"), docs, own)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that a document with a smaller id has; ``n_chars`` follows. No row goes.

    Rows with the same id are one document and keep what the others of them have; a row without an id keeps
    all its lines. A null text stays null.
    """
    renamed, own = _apart(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    found = _together(line_dedup.dedup_lines(renamed).withColumn("text", text), docs, own)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else found


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: that with the smallest id, of several with this id one.

    Rows, not ids, go: a different text under the id of a copy stays. A row without an id stays only if its group
    has no row with one.
    """
    rows, row = _numbered(docs)
    stay = simhash.one_of_each(rows, row, shingle_words=3, max_distance=2)
    return rows.join(stay, row, "left_semi").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text overlaps a benchmark item go, also those without an id; other rows of the same id stay."""
    rows, row = _numbered(docs)
    found = decontaminate.overlaps(rows.select(F.col(row), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    gone = found.select(F.col("doc_id").alias(row)).distinct()
    return rows.join(gone, row, "left_anti").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and their digests: that of the ids, and that of the text they decode to."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    coded = pieces.encode(docs.select("doc_id", "text"), model, decoded=True)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

#: The stages train a model and run a tokenizer, which SQL cannot express; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
