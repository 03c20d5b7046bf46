import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from larder.llm import alignment, queries


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def letters():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def spans(parts):
    ends, at = [], 0
    for p in parts:
        ends.append((at, at + len(p)))
        at += len(p)
    return ends


def brute_force(rows, files):
    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    byte = letters()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        parts_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            docs.append((doc_id, [], [], [], []))
            continue
        at_a, at_b = spans(parts_a), spans(parts_b)
        links = [(i, j) for i, (s, e) in enumerate(at_a) for j, (t, f) in enumerate(at_b) if s < f and t < e]
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(x) for x, (_, e) in zip(ids_a, at_a) if low < e <= cut) + "|"
                          + ",".join(str(x) for x, (_, e) in zip(ids_b, at_b) if low < e <= cut))
            low = cut
        docs.append((doc_id, ids_a, ids_b, groups, links))
        counts.update((ids_a[i], ids_b[j]) for i, j in links)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    for doc_id, ids_a, ids_b, groups, links in docs:
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        yield (doc_id, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in pairs),
               sum(counts[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")


def rows_with_oddities():
    rng = random.Random(3)
    odd = ["", None, " ", "  two  blanks ", "a▁b", "<s> </s> <|endoftext|> <0x41>", "naïvé ﬁ Ａ", "tab\tnew\nline\r\n",
           "\x00nul", "漢字かな交じり文", "👩‍👩‍👧 family", "x" * 400, "<unk>", " 　"]
    words = ["the", "token", "ization", "über", "straße", "été", "1234", "  ", "\n", "don't", "re-", "Ωmega", "🙂"]
    made = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 80))) for _ in range(40)]
    return [(i, t) for i, t in enumerate(odd + made)] + [(3, "repeated id"), (None, "no id"), (None, None), (7, made[0])]


def key(row):
    return tuple((v is not None, v) for v in row)


def test_query_matches_brute_force(spark, files, tmp_path, monkeypatch):
    # Each task makes several batches, so that counts cross batches and partitions.
    monkeypatch.setattr(alignment, "BATCH_CHARS", 300)
    monkeypatch.setattr(alignment, "PART_CHARS", 100)
    rows = rows_with_oddities()
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_token_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_force(rows, files), key=key)


def test_runs_join_at_shared_ends(files, monkeypatch):
    aligner = alignment.Aligner(*files)
    texts = [t or "" for _, t in rows_with_oddities()]
    whole = aligner.align(texts)
    monkeypatch.setattr(alignment, "RUN_TOKENS", 3)
    for a, b in zip(whole, aligner.align(texts)):
        assert (a == b).all()


def test_align_returns_groups_and_links(spark, files):
    rows = rows_with_oddities()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, a_ids int")
    want = {r[:5] for r in brute_force(rows, files)}
    got = alignment.align(docs, *files).collect()
    assert {(r.doc_id, len(r.a_ids), len(r.b_ids), len(set(r.a_groups)), len(r.a_links)) for r in got} == want
    for r in got:
        assert len(r.a_links) == len(set(zip(r.a_links, r.b_links)))
        assert sorted(set(r.a_groups)) == sorted(set(r.b_groups)) == list(range(len(set(r.a_groups))))
        # Only tokens of the same group overlap, and every token overlaps another.
        assert all(r.a_groups[i] == r.b_groups[j] for i, j in zip(r.a_links, r.b_links))
        assert set(r.a_links) == set(range(len(r.a_ids))) and set(r.b_links) == set(range(len(r.b_ids)))


def test_empty_table_and_other_names(spark, files):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.statistics(none, *files).count() == 0
    assert alignment.align(none, *files).count() == 0
    other = spark.createDataFrame([(1, "some words", "x")], "key int, body string, batch string")
    assert alignment.statistics(other, *files, id_col="key", text_col="body").first()["n_a"] == 2


def test_both_encoders_of_a_byte_level_file_agree(files):
    aligner = alignment.Aligner(*files)
    texts = [" " + (t or "") for _, t in rows_with_oddities()] + [" " + chr(c) * 2 + f"1{chr(c)} {chr(c)}\n " for c in range(1, 0x3000, 7)]
    want = [e.ids for e in aligner.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [aligner.ranked.encode_ordinary(t) for t in texts] == want
    # Another split of the text is not the one that the ranked encoder knows.
    other = files[0].replace('"add_prefix_space": false', '"add_prefix_space": true').replace('"add_prefix_space":false', '"add_prefix_space":true')
    slow = alignment.Aligner(other, files[1])
    assert slow.ranked is None
    for a, b in zip(aligner.align(["some words", "naïve"]), slow.align(["some words", "naïve"])):
        assert (a == b).all()
