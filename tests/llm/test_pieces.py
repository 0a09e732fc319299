"""Backtracking over pieces against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from kvloom.llm.pieces import PieceBpe, encode_decode_pieces
from kvloom.llm.remembered import Room

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return PieceBpe(PATH)


def odd_texts():
    rnd = random.Random(3)
    signs = [*"abdeéèñßΣİ😀日本 \t\n'!?.,%1½²\x1d　 Ġ▁\0", "<s>", "</s>", "<unk>", "<0x41>", "  ", "́", "▁▁", "ing", " the"]
    mixed = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    dense = ["".join(rnd.choice("aeinrst ") for _ in range(rnd.randint(0, 80))) for _ in range(2000)]
    spaces = [" " * n + end for n in (1, 2, 3, 7, 17, 40, 777) for end in ("", "a", "\n", "é")]
    return mixed + dense + spaces + ["", "▁", "x" * 5000, "ab" * 3000, "a" * 900 + " " + "b" * 301, "日" * 400]


def test_odd_texts_like_the_library(model, library):
    texts = odd_texts()
    for text, (ids, decoded) in zip(texts, model.encode_batch(texts)):
        expected = library.encode(text)
        assert ids.decode() == ",".join(map(str, expected)), repr(text)
        assert decoded.decode() == library.decode(expected), repr(text)


def test_backtracking_equals_plain_merging_where_the_longest_piece_is_wrong(model):
    rnd = random.Random(8)
    given_way = 0
    for _ in range(3000):
        text = "".join(rnd.choice("aehinorstu") for _ in range(rnd.randint(1, 40)))
        expected = model.merge(list(text))
        assert model.pieces(text) == expected
        longest = max((p for p in model.id_of if text.startswith(p)), key=len) if _ < 100 else expected[0]
        given_way += longest != expected[0]
    assert given_way > 10


def test_two_pieces_are_compatible_if_merging_keeps_them(model):
    rnd = random.Random(1)
    pieces = sorted(p for p in model.shorter if len(p) < 6)
    for _ in range(3000):
        a, b = rnd.choice(pieces), rnd.choice(pieces)
        assert model.compatible(a, b) == (model.merge(list(a + b)) == [a, b])


def test_texts_are_cut_only_where_no_piece_goes(model):
    side_by_side = {p[k : k + 2] for p in model.id_of for k in range(len(p) - 1)}
    cuts = 0
    for text in odd_texts():
        chunks = model.chunks_in(text.replace("▁", " "))
        assert "".join(chunks) == text.replace("▁", " ")
        for a, b in zip(chunks, chunks[1:]):
            assert (a[-1] + b[0]).replace(" ", "▁") not in side_by_side
            cuts += 1
    assert cuts > 1000 and model.chunks_in(" word,' (so)\n  x") == [" word", ",'", " (so", ")", "\n", "  x"]


def test_stores_are_emptied_and_fill_again(model, library):
    texts = odd_texts()[:600]
    expected = [",".join(map(str, library.encode(t))) for t in texts]
    small = PieceBpe(PATH)
    small.chunk_room.most = small.fit_room.most = 5_000
    found = [ids.decode() for k in range(0, 600, 20) for ids, _ in small.encode_batch(texts[k : k + 20])]
    assert found == expected
    assert small.fit_room.held <= 5_000
    store = {}
    room = Room(store, most=1000)
    assert [room.take(1, 500) for _ in range(4)] == [False, True, False, True] and room.held == 0


def test_documents_and_awkward_rows(documents, awkward, nothing, library):
    for docs in (documents, awkward, nothing):
        expected = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "")
            raw = ",".join(map(str, ids)), library.decode(ids)
            expected.append((r.doc_id, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in raw)))
        found = [tuple(r) for r in encode_decode_pieces(docs, PATH).collect()]
        assert sorted(map(str, found)) == sorted(map(str, expected))
    row = encode_decode_pieces(awkward, PATH, output="ids").filter("doc_id = 12").first()
    assert row.ids == library.encode("Two WORDS") and row.decoded == "Two WORDS"
    assert encode_decode_pieces(awkward, PATH, output="ids").filter("doc_id = 5").first().ids == []


def test_other_models_are_refused(tmp_path, monkeypatch):
    import sentencepiece

    class Normalises(sentencepiece.SentencePieceProcessor):
        def normalize(self, text):
            return text.strip()

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Normalises)
    with pytest.raises(ValueError):
        PieceBpe(PATH)
