import random
import zlib

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from crashlake.llm import sentencepiece_fst as S

from .conftest import ODD_TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = [*"abcdetionshéß  \n\t▁日本🙂.,!1234567", "the ", "tion", "   ", "▁▁▁", "    \n", "\x00", "́", "ﬁ", "�"]


def random_texts(seed, n, bits=BITS):
    rng = random.Random(seed)
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def fst():
    return S.Transducer(open(PATH, "rb").read())


def test_bpe_paths_are_the_librarys_ids(library, fst):
    texts = random_texts(1, 5000) + [c * n for c in (" ", "a", "=", "-", "0", "ab", "日", "\n", "🙂") for n in range(40)]
    for t in texts:
        ids = fst.encode(t).tolist()
        assert ids == library.encode(t), t
        assert fst.decode(ids) == library.decode(ids) == t.replace("▁", " ")


def test_every_piece_as_text(library, fst):
    rng = random.Random(3)
    words = [p.replace("▁", " ") for p in fst.surface[300:]]
    texts = ["".join(rng.choice(words) for _ in range(6)) for _ in range(4000)]
    for t, ids in zip(texts, library.encode(texts), strict=True):
        assert fst.encode(t).tolist() == ids


def unigram(byte_fallback):
    """A small hand-written unigram model."""
    m = sentencepiece_model_pb2.ModelProto()
    m.trainer_spec.model_type = 1
    m.trainer_spec.byte_fallback = byte_fallback
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.add_dummy_prefix = True
    m.normalizer_spec.remove_extra_whitespaces = False
    m.normalizer_spec.escape_whitespaces = True
    for text, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=text, score=0, type=kind)
    if byte_fallback:
        for b in range(256):
            m.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    rng = random.Random(8)
    seen = set()
    for text in [*"▁abcdet", "▁a", "ab", "abc", "bc", "cd", "de", "▁ab", "▁▁", "et", "tt", "cdet", "bcd", "a▁b", "tab"]:
        if text not in seen:
            seen.add(text)
            m.pieces.add(piece=text, score=round(-rng.uniform(1, 9), 3), type=1)
    return m.SerializeToString()


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_paths_are_the_librarys_ids(byte_fallback):
    model = unigram(byte_fallback)
    lib, fst = sentencepiece.SentencePieceProcessor(model_proto=model), S.Transducer(model)
    for t in random_texts(2, 3000, [*"aabbccddeett  ", "é", "日本", "x", "cdet"]):
        assert fst.encode(t).tolist() == lib.encode(t), t


def test_models_out_of_scope_are_refused():
    m = sentencepiece_model_pb2.ModelProto()
    m.ParseFromString(unigram(True))
    m.pieces.add(piece="USER", score=0, type=4)
    with pytest.raises(ValueError):
        S.Transducer(m.SerializeToString())


def test_parts_are_forgotten_without_changing_results(library, monkeypatch):
    monkeypatch.setattr(S, "PARTS_CACHE", 5)
    monkeypatch.setattr(S, "PAIRS_CACHE", 3)
    fst = S.Transducer(open(PATH, "rb").read())
    for t in random_texts(5, 300):
        assert fst.encode(t).tolist() == library.encode(t)


def test_query_and_odd_rows(docs_of, library):
    texts = [*ODD_TEXTS, "same", "same"]
    rows = [*enumerate(texts), (None, "no id")]
    got = {r["doc_id"]: r for r in S.round_trip(docs_of(rows), PATH).collect()}
    assert len(got) == len(rows) and all(r["exact"] for r in got.values())
    for i, t in rows:
        ids = library.encode(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
    both = S.decode(S.encode(docs_of(rows), PATH), PATH).collect()
    assert len(both) == len(rows) and all(r["decoded"] == r["text"] and len(r["ids"]) == got[r["doc_id"]]["n_tokens"] for r in both)
    assert S.round_trip(docs_of([(0, "a")]).where("false"), PATH).count() == 0
