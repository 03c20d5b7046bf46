import random

import pytest

import public_tokenizers
from tokenizers import Tokenizer

from larder.llm import queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
with open(PATH, encoding="utf-8") as file:
    RAW = file.read()

ODD = ["", " ", "don't DON'T they'RE 's 'l 'll l' '' i've'", "a<|endoftext|>b !<|startoftext|>'s <|ENDOFTEXT|> <|end", "İstanbul ΣΑΣ ß ſ K",
       "½²x3 12,345", "a\x00b\x85c\x1c\x1dx", "é é", "日本語テキスト 語", "can’t ª º", "a​b  c　d ", "😀😀 x" * 20, "x" * 500, "!?" * 70,
       "aaa aaaa aaaaa", "-----", "\n\t ", "ÀÉÎ straße"]


def _texts(rng, count=200):
    alphabet = ["the", "ing", "er", "'", "re", "ll", "s", " ", " ", "é", "日", "😀", "1", "½", ".", "!!", "\n", "_", "X", "Σ", "ǆ", "а́"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(count)]


def test_whole_texts_match_the_library():
    library, own = Tokenizer.from_file(PATH), token_counts.PrefixCounter(RAW)
    for text in ODD + _texts(random.Random(1)):
        totals = own.prefixes(text)[1]
        assert (int(totals[-1]) if len(totals) else 0) == len(library.encode(text, add_special_tokens=False).ids), text


def test_every_prefix_matches_the_library():
    library, own = Tokenizer.from_file(PATH), token_counts.PrefixCounter(RAW)
    for text in [t for t in ODD + _texts(random.Random(2), 40) if "<|" not in t]:
        normal = token_counts.normalise(text)
        ends, totals, found = own.prefixes(text)
        for end, total, word in zip(ends, totals, found):
            row = own.word(word)
            for cut, count in enumerate(row, 1):
                at = end - len(word) + cut
                assert total - row[-1] + count == len(library.encode(normal[:at], add_special_tokens=False).ids)


def test_budget_takes_the_longest_prefix():
    library, own = Tokenizer.from_file(PATH), token_counts.PrefixCounter(RAW)
    for text in [t for t in ODD + _texts(random.Random(3), 60) if "<|" not in t]:
        normal = token_counts.normalise(text)
        counts = [len(library.encode(normal[:i], add_special_tokens=False).ids) for i in range(len(normal) + 1)]
        for budget in (0, 1, 3, 10, 1000):
            at, used = own.fit(text, budget, *own.prefixes(text)[:2])
            assert used == counts[at] <= budget
            after = [i for i in range(at + 1, len(normal) + 1) if counts[i] <= budget and normal[i - 1].strip()]
            # Only a prefix that a later letter makes cheaper again, or blanks, may lie beyond.
            assert all(max(counts[at:i]) > budget for i in after)


def test_budgets_encode_no_more_than_the_word_at_the_edge(monkeypatch):
    own = token_counts.PrefixCounter(RAW)
    texts = [t for t in ODD + _texts(random.Random(6), 40)] + ["a <|endoftext|> b"]
    stored = [own.prefixes(t)[:2] for t in texts]
    encoded, real = [], token_counts.PrefixCounter.word
    for name in ("prefixes", "counts", "whole"):
        monkeypatch.setattr(token_counts.PrefixCounter, name, lambda *a: pytest.fail("counted again"))
    monkeypatch.setattr(token_counts.PrefixCounter, "word", lambda self, w: encoded.append(w) or real(self, w))
    fresh = token_counts.PrefixCounter(RAW)
    for text, (ends, totals) in zip(texts, stored):
        for budget in (0, 1, 2, 7, 100_000):
            before = len(encoded)
            at, used = fresh.fit(text, budget, ends, totals)
            assert used <= budget and len(encoded) - before <= 1
    assert fresh.fit("a <|endoftext|> b", 2, *stored[-1]) == (len("a <|endoftext|>"), 2)
    assert fresh.fit("a <|endoftext|> b", 1, *stored[-1]) == (1, 1)


def test_forgetting_keeps_results(monkeypatch):
    texts = _texts(random.Random(4))
    want = [own_total(token_counts.PrefixCounter(RAW), t) for t in texts[:20]]
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    monkeypatch.setattr(token_counts, "REMEMBERED_PAIRS", 3)
    own = token_counts.PrefixCounter(RAW)
    assert [own_total(own, t) for t in texts[:20]] == want


def own_total(counter, text):
    totals = counter.prefixes(text)[1]
    return int(totals[-1]) if len(totals) else 0


def test_query_matches_the_library(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    rows = list(enumerate([*ODD, None, "word " * 2048, "word " * 2049, *_texts(random.Random(5), 30), ODD[2]]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for doc, text in rows:
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        want.add((doc, len((text or "").encode()), count, count > 2048))
    assert {tuple(r) for r in queries.op8_token_counts(spark, str(tmp_path)).collect()} == want


def test_frames_with_nulls_clashes_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "two words", "x"), (1, None, "y"), (1, None, "y")], "doc_id long, text string, ends string")
    counted = token_counts.prefix_counts(docs, RAW).orderBy("n_tokens").collect()
    assert [(r.ends, r.counts, r.n_tokens) for r in counted] == [([], [], 0), ([], [], 0), ([3, 9], [1, 2], 2)]
    fitted = token_counts.fit_budget(docs, RAW, 1).orderBy("fit_tokens").collect()
    assert [(r.fit_chars, r.fit_tokens, r.ends) for r in fitted] == [(0, 0, "y"), (0, 0, "y"), (3, 1, "x")] or fitted[-1].fit_chars >= 3
    stored = token_counts.prefix_counts(docs, RAW)
    for budget in (0, 1, 2, 3):
        one = token_counts.fit_budget(docs, RAW, budget).select("doc_id", "fit_chars", "fit_tokens").collect()
        two = token_counts.fit_budget(stored, RAW, budget, counted=True).select("doc_id", "fit_chars", "fit_tokens").collect()
        assert sorted(map(str, one)) == sorted(map(str, two)) and max(r.fit_tokens for r in one) == min(budget, 2)
    assert token_counts.fit_budget(docs.where("false"), RAW, 1).count() == 0
    assert token_counts.prefix_counts(docs.where("false"), RAW).count() == 0
