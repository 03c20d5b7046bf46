import pyarrow as pa
from pyspark.sql import types as T

from larder.llm import decontaminate, fingerprint, line_dedup, pieces, rows, simhash, token_counts


def test_pieces_cover_a_batch_in_order():
    texts = ["a" * n for n in (5, 0, 30, 2, 2)] + [None, "zz"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": list(range(7))})
    parts = list(rows.pieces(batch, "text", 10))
    assert [t for _, found in parts for t in found] == [t or "" for t in texts]
    assert [n for part, _ in parts for n in part.column("n").to_pylist()] == list(range(7))
    assert max(len(found) for _, found in parts) < 7
    assert list(rows.pieces(batch.slice(0, 0), "text")) == []


def test_lists_of_numbers():
    import numpy as np
    assert rows.int_lists([np.array([1, 2]), np.array([], np.int64), np.array([3])]).to_pylist() == [[1, 2], [], [3]]
    assert rows.int_lists([]).to_pylist() == []


def test_narrow_ids_and_columns_of_any_kind(spark):
    """32-bit ids, and columns that are only passed on, whatever their type."""
    docs = spark.sql("""
        SELECT CAST(id AS INT) AS doc_id, concat('some words of text number ', id % 3, '\\nand a line that repeats') AS text,
               map('k', id) AS attributes, array(struct(id AS x)) AS nested, DATE '2024-01-01' AS day, CAST(1.5 AS DECIMAL(10, 2)) AS price,
               CAST(NULL AS BINARY) AS raw FROM range(6)""")
    benchmark = spark.createDataFrame([(1, "words")], T.StructType([T.StructField("item_id", T.IntegerType()), T.StructField("text", T.StringType())]))
    kept = line_dedup.dedup_lines(docs)
    assert set(docs.columns) < set(kept.columns) and kept.where("n_dropped > 0").count() == 5 and kept.count() == 6
    assert simhash.near_duplicates(docs).select("component_id").distinct().count() <= 3
    assert decontaminate.overlaps(docs, benchmark).count() == 0
    assert fingerprint.compare_with_next(docs).count() == 6
    assert fingerprint.fingerprints(docs).where("size(nested) = 1").count() == 6
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        assert token_counts.prefix_counts(docs, file.read()).where("attributes['k'] = doc_id").count() == 6
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        assert pieces.encode(docs, file.read()).where("size(ids) > 0").count() == 6
