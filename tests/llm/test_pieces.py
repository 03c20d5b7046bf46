import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from larder.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
with open(PATH, "rb") as file:
    RAW = file.read()

ODD = ["", " ", "  ", " a", "a ", "▁", "▁a b", "\n\n x", "日本語テキスト", "a\x00b", "😀😀 x", "<s> </s> <unk> <0x0A>", "�", "x" * 3000,
       "ab" * 900 + "日" * 90, "\t\t", "é" * 3, "é ﬁ ① ㍿ Ⅷ ａｂｃ", "a  b   c    d", " " * 50, "\x80\x81", "½.². 3².", "don't 12,345.67%",
       "　full width​space ", "ｶﾞ ﾊﾟ", "­soft"]


def _varint(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def _with_normaliser(name, remove_extra):
    """The same pieces behind another compiled character map."""
    map_model = sentencepiece.SentencePieceNormalizer(rule_name=name).serialized_model_proto()
    spec = next(v for n, v in pieces._fields(map_model) if n == 3)
    compiled = dict(pieces._fields(spec))[2]
    inner = b"\x12" + _varint(len(compiled)) + compiled + b"\x18\x01\x20" + bytes([remove_extra]) + b"\x28\x01"
    return RAW + b"\x1a" + _varint(len(inner)) + inner


def _texts(rng, count=150):
    alphabet = "ab cdéß日本😀▁\n\t.,'12½ﬁ①　 ́ＡＢ  "
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(count)]


def test_ids_and_decoding_match_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_proto=RAW), pieces.PieceModel(RAW)
    rng = random.Random(2)
    for text in ODD + _texts(rng):
        ids = library.encode(text)
        assert own.encode(text)[0].tolist() == ids
        assert own.decode(ids) == library.decode(ids)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(259), 29871]) for _ in range(rng.randint(0, 6))]
        assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize(("name", "remove_extra"), [("nmt_nfkc", 0), ("nmt_nfkc", 1), ("nfkc_cf", 1)])
def test_compiled_character_maps(name, remove_extra):
    raw = _with_normaliser(name, remove_extra)
    library, own = sentencepiece.SentencePieceProcessor(model_proto=raw), pieces.PieceModel(raw)
    assert own.map
    for text in ODD + _texts(random.Random(4)):
        want, offsets = library.normalize(text, with_offsets=True)
        got, origin = own.normalise(text)
        assert got == want
        # The library counts characters: the source of each written character's first byte.
        starts, at = [], 0
        for c in got:
            starts.append(len(text.encode()[:origin[at]].decode()))
            at += len(c.encode())
        assert starts == list(offsets)[:len(starts)]
        assert own.encode(text)[0].tolist() == library.encode(text)


def test_spans_tile_the_source():
    own = pieces.PieceModel(RAW)
    for text in ODD + _texts(random.Random(6)):
        source = text.encode()
        ids, edges = own.encode(text)
        assert len(edges) == len(ids) + 1 and edges[-1] == len(source)
        assert all(a <= b for a, b in zip(edges, edges[1:]))
        for i, a, b in zip(ids.tolist(), edges, edges[1:]):
            piece = own.surfaces[i]
            covered = source[a:b].replace("▁".encode(), b" ")
            assert covered == piece or (a == 0 and b" " + covered == piece) or (own.is_byte[i] and covered == piece)


def test_forgetting_keeps_results(monkeypatch):
    texts = _texts(random.Random(8), 300)
    want = [pieces.PieceModel(RAW).encode(t)[0].tolist() for t in texts]
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    own = pieces.PieceModel(RAW)
    assert [own.encode(t)[0].tolist() for t in texts] == want


def test_query_matches_the_library(spark, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = list(enumerate([*ODD, None, *_texts(random.Random(9), 40), ODD[0]]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op6_sentencepiece(spark, str(tmp_path)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    want = set()
    for doc, text in rows:
        ids = library.encode(text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.add((doc, len(ids), *digests))
    assert got == want


def test_clashing_columns_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b", "x"), (1, None, "y"), (1, None, "y")], "doc_id long, text string, ids string")
    coded = pieces.decode(pieces.encode(docs, RAW), RAW)
    assert coded.where("doc_id = 1 and size(ids) = 0 and n_bytes = 0 and decoded = ''").count() == 2
    assert coded.where("doc_id is null").first().decoded == "a b"
    assert pieces.encode(docs.where("false"), RAW).count() == 0


def test_decoding_many_bytes_that_are_no_text(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    rng = random.Random(9)
    for ids in ([byte[0xFF]] * 5000, [byte[b] for b in rng.choices([0xE6, 0xBC, 0xA2, 0xF0, 0x9F, 0x41, 0xC3], k=4000)]):
        with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
            assert pieces.PieceModel(file.read()).decode(ids) == library.decode(ids)
