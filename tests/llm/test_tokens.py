"""BPE and token sequences against the tokenizers library."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kvloom.llm.bpe import WordBpe, encode_decode
from kvloom.llm.sequences import (
    ChunkEncoder,
    ShardReader,
    ShardWriter,
    arrow_system,
    read_sequences,
    write_sequences,
)

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def odd_texts():
    rnd = random.Random(3)
    signs = list("abdeéèñßΣİ😀日 \t\n'!?.,%1½²\x1d　 Ġ") + ["<|endoftext|>", "'s ", "  "]
    made = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return made + ["", " ", "  a  b", " a", "a ", "ΣΑΣ", "x" * 5000, "<|startoftext|>q<|endoftext|>", "ﬁ ǅ"]


def test_segment_trees_merge_like_the_library():
    library, bpe = Tokenizer.from_file(WORDS), WordBpe(WORDS)
    texts = odd_texts()
    for text, (ids, decoded) in zip(texts, bpe.encode_batch(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.decode() == " ".join(map(str, expected)), repr(text)
        assert decoded.decode() == library.decode(expected, skip_special_tokens=False), repr(text)


def test_documents_and_awkward_rows(documents, awkward, nothing):
    library = Tokenizer.from_file(WORDS)
    for docs in (documents, awkward, nothing):
        found = encode_decode(docs, WORDS).collect()
        expected = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            digests = [
                hashlib.sha256(t.encode()).hexdigest()
                for t in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
            ]
            expected.append((r.doc_id, len(ids), *digests))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    ids = encode_decode(awkward, WORDS, output="ids").filter("doc_id = 11").first()
    assert ids.ids == library.encode("one", add_special_tokens=False).ids and ids.decoded == "one</w>"


def test_chunks_encode_like_whole_texts():
    library, encoder = Tokenizer.from_file(BYTES), ChunkEncoder(BYTES)
    texts = odd_texts()
    for text, ids in zip(texts, encoder(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, np.uint16).tolist() == expected, repr(text)


def test_long_chunks_and_a_pool_that_starts_anew():
    library, encoder = Tokenizer.from_file(BYTES), ChunkEncoder(BYTES)
    assert encoder.merges is not None
    encoder.room.most = 3_000
    texts = [f"a {'x' * n} b{'日' * n}c {n}'s\ny  " for n in (1, 999, 1000, 1001, 4000)] + odd_texts()[:300]
    for k in range(0, len(texts), 7):
        for text, ids in zip(texts[k : k + 7], encoder(texts[k : k + 7])):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, np.uint16).tolist() == expected, repr(text[:50])
    assert encoder.room.held <= 12_000 and len(encoder.places) == len(encoder.numbers) + 1


def test_merges_out_of_order_are_left_to_the_library(tmp_path):
    with open(BYTES, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    (a, b), (c, d) = (tuple(m.split(" ")) if isinstance(m, str) else m for m in spec["model"]["merges"][3:5])
    vocab[a + b], vocab[c + d] = vocab[c + d], vocab[a + b]
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    library, encoder = Tokenizer.from_file(path), ChunkEncoder(path)
    assert encoder.merges is None
    texts = odd_texts()[:200]
    for text, ids in zip(texts, encoder(texts)):
        assert np.frombuffer(ids, np.uint16).tolist() == library.encode(text, add_special_tokens=False).ids


def test_sequences_read_back(documents, awkward):
    library = Tokenizer.from_file(BYTES)
    for docs in (documents, awkward):
        rows = docs.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        start, expected = 0, []
        for r in rows:
            ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], np.uint32)
            expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        table = write_sequences(docs, BYTES, 2, sequence=16, batch=4)
        assert sorted(read_sequences(table).collect(), key=lambda r: r.start) == expected


def test_no_rows_no_shards(nothing):
    assert read_sequences(write_sequences(nothing, BYTES, 2)).count() == 0


def test_shards_are_views_of_equal_batches(tmp_path):
    uri = str(tmp_path / "x" / "a.arrows")
    shard = ShardWriter(uri, np.uint16, 8, 4)
    values = np.arange(70, dtype=np.uint16)
    for part in np.split(values, [3, 50]):
        shard.add(part.tobytes())
    shard.close()
    reader = ShardReader(uri)
    assert np.concatenate(list(reader.read(5, 60))).tolist() == list(range(5, 65))
    assert np.concatenate(list(reader.read(3, 9))).tolist() == list(range(3, 12))
    mapped = pa.memory_map(uri)
    batches = list(pa.ipc.open_stream(mapped))
    assert [b.num_rows for b in batches] == [4, 4, 4]
    assert sum(b.column("mask").flatten().true_count for b in batches) == 70
    mapped.seek(0)
    before = pa.total_allocated_bytes()
    views = [b.column("ids").flatten().to_numpy(zero_copy_only=True) for b in pa.ipc.open_stream(mapped)]
    assert pa.total_allocated_bytes() == before and np.concatenate(views)[:70].tolist() == list(range(70))


def test_any_sequence_by_its_number(tmp_path):
    uri = f"file://{tmp_path}/y/b.arrows"
    shard = ShardWriter(uri, np.uint32, 5, 3)
    values = np.arange(101, dtype=np.uint32) * 7
    for part in np.split(values, [1, 2, 60]):
        shard.add(part.tobytes())
    shard.close()
    reader = ShardReader(uri)
    assert (reader.n_batches, reader.rows, reader.n_sequences) == (7, 3, 21)
    padded = np.append(values, np.zeros(4, np.uint32)).reshape(21, 5)
    for number in [20, 0, *range(19, -1, -1), 7, 7]:
        ids, mask = reader.sequence_at(number)
        assert ids.tolist() == padded[number].tolist()
        assert mask.to_pylist() == [5 * number + k < 101 for k in range(5)]
    for number in (-1, 21):
        with pytest.raises(IndexError):
            reader.sequence_at(number)
    # Views of the mapped file: reading a sequence allocates nothing that grows with the batch.
    before = pa.total_allocated_bytes()
    reader.sequence_at(11)
    assert pa.total_allocated_bytes() - before < 100
    assert [p.tolist() for p in reader.read(33, 3)] == [[231, 238, 245]]


def test_a_shard_without_ids(tmp_path):
    shard = ShardWriter(f"file://{tmp_path}/none.arrows", np.uint16, 8, 4)
    shard.close()
    reader = ShardReader(f"file://{tmp_path}/none.arrows")
    assert reader.n_sequences == 0 and list(reader.read(0, 0)) == []
    with pytest.raises(IndexError):
        reader.sequence_at(0)


def test_names_of_stores():
    system, path = arrow_system("file:///a/b")
    assert path == "/a/b" and type(system).__name__ == "LocalFileSystem"
    with pytest.raises(pa.ArrowInvalid, match="nosuch"):
        arrow_system("nosuch://x/y")
