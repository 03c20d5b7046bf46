import hashlib
import random

import public_tokenizers
import sentencepiece
from test_decontaminate import slow_overlap, words
from test_line_dedup import key
from test_simhash import slow_components, slow_fingerprint
from test_toxicity import _rows

import corpus_pipeline
from larder.llm import toxicity


def _drop_lines(rows):
    holders = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text, *_ in rows:
        kept = [x for x in (text or "").split("\n") if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc]
        out.append((doc, None if text is None else "\n".join(kept)))
    return out


def test_run_matches_brute_force(spark, tmp_path):
    rng = random.Random(1)
    docs, labels = _rows(rng, 260)
    items = [(i, " ".join(rng.choices([f"b{k}" for k in range(60)], k=25))) for i in range(5)]
    texts = dict(docs)
    shared = "a shared line that many of them hold"
    for i in range(0, 260, 9):
        texts[i] += f"\n{shared}\nown line number {i}"
    for i in range(200, 230):  # copies of earlier ones, some with a word changed
        texts[i] = texts[i - 200] + (" extra" if i % 2 else "")
    for i in range(5, 260, 40):
        texts[i] += " " + items[i % 5][1].upper()
    texts[250], texts[251] = None, ""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in sorted(texts.items())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = toxicity.score(frame, toxicity.fit(frame, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    toxic = {r.doc_id for r in scored.where("is_toxic").collect()}
    assert toxic and len(toxic & {i for i, _, t in labels if t and i < 200}) > 0.9 * sum(t for i, _, t in labels if i < 200)
    left = _drop_lines([r for r in rows if r[0] not in toxic])
    fps = {i: slow_fingerprint(t) for i, t in left}
    group = slow_components([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    left = [(i, t) for i, t in left if group[i] == i]
    left = [(i, t) for i, t in left if not any(slow_overlap(words(t), words(p)) for _, p in items)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: library.encode(t or "") for i, t in left}

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and len(got) == len(want)
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(list(r.ids)).encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_tables(spark, tmp_path):
    docs, labels = _rows(random.Random(2), 60)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "x " * 20)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, h1 string, p_toxic string, part string"
    rows = [(i, t, "en", "s", len(t), "a", "b", "c") for i, t in docs] + [(None, None, None, None, None, None, None, None), (docs[0][0], docs[0][1]) + (None,) * 6]
    full = spark.createDataFrame(rows, schema)
    for frame in (full, full.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, frame, str(tmp_path))
            assert found.columns == frame.columns
            assert (found.count() > 0) == (frame.count() > 0)
        assert corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).count() == frame.count()


def test_rows_go_and_ids_stay(spark, tmp_path):
    """Repeated ids of different text, exact repeats, rows without an id, and columns with the operators' own names."""
    docs, labels = _rows(random.Random(3), 120)
    item = " ".join(f"b{i}" for i in range(20))
    copy, other = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = [(503, copy), (503, copy), (505, copy), (505, other), (None, copy), (None, "only once, without an id, and long enough"),
             (507, f"seen {item} here"), (507, "clean text of the same id"), (None, f"hidden {item} too")]
    names = ["n_lines", "kept_text", "p_toxic", "is_toxic", "_lost", "fp", "component", "_row", "seed", "item_id"]
    rows = [(i, t, *[f"{c} {n}" for c in names]) for n, (i, t) in enumerate(docs + extra)]
    spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    known = {(r[0], r[1], r[2]): tuple(r) for r in rows}

    def pairs(found):
        collected = found.collect()
        assert found.columns == frame.columns and [f.dataType for f in found.schema] == [f.dataType for f in frame.schema]
        return collected, sorted(((r.doc_id, r.text) for r in collected if r.doc_id is None or r.doc_id >= 500), key=str)

    kept, some = pairs(corpus_pipeline.drop_near_duplicates(spark, frame, str(tmp_path)))
    assert some == sorted([(503, copy), (505, other)] + [p for p in extra if p[1] not in (copy, other)], key=str)
    assert all(known[r.doc_id, r.text, r.n_lines] == tuple(r) for r in kept)
    kept, some = pairs(corpus_pipeline.drop_contaminated(spark, frame, str(tmp_path)))
    assert some == sorted([p for p in extra if item not in p[1]], key=str) and len(kept) == len(rows) - 2
    assert all(known[r.doc_id, r.text, r.n_lines] == tuple(r) for r in kept)
    kept, some = pairs(corpus_pipeline.drop_toxic(spark, frame, str(tmp_path)))
    assert some == sorted(extra, key=str) and all(known[r.doc_id, r.text, r.n_lines] == tuple(r) for r in kept)
    kept, _ = pairs(corpus_pipeline.drop_repeated_lines(spark, frame, str(tmp_path)))
    assert len(kept) == len(rows) and sorted(r.n_lines for r in kept) == sorted(r[2] for r in rows)
    assert {(r.doc_id, r.text) for r in kept if r.doc_id == 505} == {(505, ""), (505, other)}
