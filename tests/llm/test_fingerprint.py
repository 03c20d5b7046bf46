import hashlib
import random

from larder.llm import fingerprint as fp
from larder.llm import queries


def hashes(text):
    return fp.PrefixHashes(fp.code_points(text))


def test_span_equality_and_common_extension():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 40))) + "日😀é" * rng.randint(0, 3) for _ in range(60)]
    for a, b in zip(texts, texts[1:]):
        ha, hb = hashes(a), hashes(b)
        for _ in range(30):
            i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
            size = rng.randint(0, min(len(a) - i, len(b) - j))
            assert (ha.span(i, i + size) == hb.span(j, j + size)) == (a[i:i + size] == b[j:j + size])
            reach = 0
            while i + reach < len(a) and j + reach < len(b) and a[i + reach] == b[j + reach]:
                reach += 1
            assert ha.common_extension(i, hb, j) == reach


def test_fingerprints_are_equal_for_equal_texts_only():
    texts = ["", "a", "b", "aa", "a" * 33, "a" * 34, "ab" * 500, "ba" * 500, "\0", "\0\0", "日"]
    prints = {t: str(hashes(t).fingerprint()) for t in texts}
    assert len(set(prints.values())) == len(texts)
    for text, written in prints.items():
        assert str(fp.Fingerprint.parse(written)) == written == str(hashes(text[:3] + text[3:]).fingerprint())


def test_shared_head_gives_the_same_arrays():
    a, b = "the same start, then this", "the same start, then something longer"
    head = hashes(a)
    both = fp.PrefixHashes(fp.code_points(b), head, 21)
    assert [x.tolist() for x in both.arrays] == [x.tolist() for x in hashes(b).arrays]


def test_likeness_finds_what_is_shared():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ij", k=4000))
    other = "".join(rng.choices("abcdefgh ij", k=4000))

    def near(a, b):
        one, two = hashes(a).fingerprint(), hashes(b).fingerprint()
        assert one.compare(two) == two.compare(one)
        return one.compare(two)[1]

    assert near(text, text) == 1 and near("", "") == 1 and near("", "a") == 0
    assert near(text, other) < 0.01
    assert near(text, "new start: " + text) > 0.95
    assert near(text, text[:2000] + "x" + text[2000:]) > 0.9
    assert near(text, "X" + text[1:2000] + "X" + text[2001:-1] + "X") > 0.85
    for size in (1, 2, 5, 31, 32, 33, 64, 100, 1000, 4000):
        points = fp.code_points(text[:size])
        changed, own = fp.edited(points, fp.code_points(other))
        assert own == size - size // 4
        assert near(text[:size], fp._text(changed)) >= 0.75 - 1 / 16 - (0.1 if size < 4 else 0)


def test_likeness_of_copies_with_many_edits_and_of_moved_text():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(6666)]

    def near(a, b):
        one, two = hashes(a).fingerprint(), hashes(b).fingerprint()
        written, exact = one.compare(two)
        assert written <= exact and (written, exact) == two.compare(one)
        assert written == one.likeness(two) == fp.Fingerprint.parse(str(one)).likeness(fp.Fingerprint.parse(str(two)))
        return exact, written

    text = " ".join(words)
    for edits, most_lost, least in ((5, 0.01, 0.96), (20, 0.02, 0.9), (200, 0.3, 0.4)):
        changed = list(words)
        for place in rng.sample(range(len(words)), edits):
            changed[place] = "another" * rng.randint(1, 2)
        exact, written = near(text, " ".join(changed))
        assert exact > 1 - most_lost and written > least
    half = len(text) // 2
    assert min(near(text, text[half:] + text[:half])) > 0.99
    other = "".join(rng.choices("klmnop", k=half))
    assert min(near(text, other[:777] + text[half:] + other)) > 0.48
    assert len(str(hashes(text).fingerprint())) > 3 * len(str(hashes(text[:half // 2]).fingerprint()))
    assert near("ab" * 9_000 + "c" + "ab" * 9_000 + "dd" + "ab" * 100, "ab" * 18_100)[0] > 0.99


def slow(rows):
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0], r[1].encode()))
    out = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        quarter = len(text) // 4
        new = text[:len(text) - quarter] + after[:quarter]
        one, two, three = (hashes(t).fingerprint() for t in (text, new, after))
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), str(one), str(two),
                    *(fp.Fingerprint.parse(str(one)).likeness(fp.Fingerprint.parse(str(x))) for x in (two, three)), one.compare(two)[1], one.compare(three)[1]))
    return sorted(out)


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i * 7 - 300, "".join(rng.choices("abé日😀 ", k=rng.choice([0, 1, 3, 30, 700])))) for i in range(90)]
    rows += [(5000, None), (5001, rows[0][1]), (rows[10][0], "twice"), (rows[20][0], rows[20][1])]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op4_document_fingerprints(spark, str(tmp_path)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_edited_extended", "near_next_extended").collect()
    assert sorted(map(tuple, got)) == slow(rows)


def test_one_row_no_rows_no_ids_and_clashes(spark):
    docs = spark.createDataFrame([(1, "abcdefgh", "x"), (None, "abcdefgh", "y"), (None, None, "z")], "doc_id long, text string, part string")
    got = {(r.doc_id, r.edited_text, r.near_next) for r in fp.compare_with_next(docs).collect()}
    assert got == {(1, "abcdefab", 1.0), (None, "abcdef", None), (None, "", None)}
    assert fp.compare_with_next(docs.where("false")).count() == 0
    written = fp.fingerprints(docs.withColumnRenamed("part", "fingerprint"))
    same = written.alias("a").join(written.alias("b")).where("a.doc_id = 1 and b.doc_id is null and b.text is not null")
    assert same.select(fp.likeness("a.fingerprint", "b.fingerprint")).first()[0] == 1.0
