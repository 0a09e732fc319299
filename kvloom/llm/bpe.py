"""BPE encoding and decoding over a segment tree of adjacent pair ranks.

A word's symbols stand at the leaves of a segment tree; a leaf holds the rank of the pair that
starts there, joined with its place, so that the root is the leftmost pair of the lowest rank. A
merge changes three leaves and the nodes above them. Words of like length are merged side by side:
the trees of many words are the rows of one array, and each step merges one pair in every word
that still has one.

Everything per document runs in Spark tasks over Arrow batches; there is no shuffle. Words are
remembered within a task, up to a fixed number of bytes.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.common import documents
from kvloom.llm.remembered import STORE_BYTES, Room, within_task

#: Words merged side by side.
SIDE_BY_SIDE = 20_000
_NONE = np.int64(2**62)
#: Control characters that Python takes for white space and the pattern does not.
_PYTHON_SPACES = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in printable else chr(256 + extra))
        extra += b not in printable
    return out


class WordBpe:
    """A vocabulary of BPE with word ends, read from a tokenizer's JSON file.

    Texts are put into NFC and lower case and cut by the file's pattern; white space goes.
    Special tokens in a text become their ids. Decoding joins the tokens by spaces, as the file
    names no decoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in (vocab | self.special).items()}
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_in = regex.compile(pattern).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words: dict[str, tuple[str, str]] = {}
        self.ids_text: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.chunk_room = Room(self.ids_text, self.decoded)
        self.word_room = Room(self.words, most=STORE_BYTES // 2)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NONE)

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word; the words are cut already."""
        raw = [w.encode() for w in words]
        out: list[list[int]] = [[] for _ in words]
        sizes = np.array([len(r) for r in raw])
        widths = 1 << np.maximum(1, np.ceil(np.log2(np.maximum(sizes, 1)))).astype(int)
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            step = max(1, SIDE_BY_SIDE * 16 // int(width))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                for i, ids in zip(some, self._merge([raw[i] for i in some], int(width))):
                    out[i] = ids
        return out

    def _merge(self, raw: list[bytes], width: int) -> Iterator[list[int]]:
        n = len(raw)
        sizes = np.array([len(r) for r in raw])
        codes = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8)
        symbol = self.inner[codes].reshape(n, width)
        every = np.arange(n)
        symbol[every, sizes - 1] = self.last[codes.reshape(n, width)[every, sizes - 1]]
        places = np.arange(width)
        after = np.broadcast_to(places + 1, (n, width)).copy()
        before = np.broadcast_to(places - 1, (n, width)).copy()
        shift = width.bit_length()
        tree = np.full((n, 2 * width), _NONE)
        ranks = self.pair_ranks(symbol[:, :-1], symbol[:, 1:])
        within = (places[None, 1:] < sizes[:, None]) & (ranks < _NONE)
        tree[:, width : 2 * width - 1] = np.where(within, (ranks << shift) | places[:-1], _NONE)
        node = width
        while node > 1:
            tree[:, node // 2 : node] = np.minimum(
                tree[:, node : 2 * node : 2], tree[:, node + 1 : 2 * node : 2]
            )
            node //= 2

        def put(rows: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
            at = place + width
            tree[rows, at] = value
            while at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = tree[live, 1]
            i, rank = root & ((1 << shift) - 1), root >> shift
            j = after[live, i]
            k = after[live, j]
            symbol[live, i] = self.merged[rank]
            after[live, i] = k
            inside = k < sizes[live]
            before[live[inside], k[inside]] = i[inside]
            put(live, j, np.full(len(live), _NONE))
            found = self.pair_ranks(symbol[live, i], symbol[live, np.minimum(k, width - 1)])
            put(live, i, np.where(inside & (found < _NONE), (found << shift) | i, _NONE))
            h = before[live, i]
            some = h >= 0
            if some.any():
                rows, h = live[some], h[some]
                found = self.pair_ranks(symbol[rows, h], symbol[rows, i[some]])
                put(rows, h, np.where(found < _NONE, (found << shift) | h, _NONE))
            live = live[tree[live, 1] < _NONE]
        for row in range(n):
            ids, at, size = [], 0, sizes[row]
            line, then = symbol[row].tolist(), after[row].tolist()
            while at < size:
                ids.append(line[at])
                at = then[at]
            yield ids

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.token_of[i] for i in ids])

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        plain = unicodedata.normalize("NFC", text)
        # Lower case character by character: a final sigma stays the usual one.
        return self.words_in(plain.replace("Σ", "σ").lower())

    def learn(self, chunks: set[str]) -> None:
        """Remember ids and decoded text of these chunks, which hold no white space."""
        new = list(chunks - self.ids_text.keys())
        if self.chunk_room.take(len(new), 6 * sum(map(len, new))):
            new = list(chunks)
            self.chunk_room.take(len(new), 6 * sum(map(len, new)))
        found = [self.cut(c) for c in new]
        distinct = {w for words in found for w in words}
        fresh = list(distinct - self.words.keys())
        if self.word_room.take(len(fresh), 6 * sum(map(len, fresh))):
            fresh = list(distinct)
            self.word_room.take(len(fresh), 6 * sum(map(len, fresh)))
        for word, ids in zip(fresh, self.merge_words(fresh)):
            self.words[word] = " ".join(map(str, ids)), self.decode(ids)
        known = self.words
        for chunk, words in zip(new, found):
            if len(words) == 1:
                ids, text = known[words[0]]
            else:
                ids = " ".join([known[w][0] for w in words])
                text = " ".join([known[w][1] for w in words])
            self.ids_text[chunk] = ids.encode()
            self.decoded[chunk] = text.encode()

    def chunks(self, text: str) -> list[str]:
        """White-space separated parts and special tokens, in order."""
        if "<|" in text:
            parts = self.specials.split(text)
        elif _PYTHON_SPACES.search(text):
            parts = [text]
        else:
            return text.split()
        out = []
        for part in parts:
            out += [part] if part in self.special else regex.findall(r"\S+", part)
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Decimal ids joined by a space and the decoded text, as bytes, of each text."""
        found = [self.chunks(t) for t in texts]
        self.learn(set().union(*found) - self.special.keys() if found else set())
        ids, decoded = self.ids_text, self.decoded
        for token, i in self.special.items():
            ids[token], decoded[token] = str(i).encode(), token.encode()
        for line in found:
            yield b" ".join([ids[c] for c in line]), b" ".join([decoded[c] for c in line])


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The vocabulary, read once a worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def slices(texts: list[str], most: int) -> Iterator[slice]:
    """Runs of texts with at most this many characters together, or a single longer one."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def encode_decode(docs: DataFrame, path: str, output: str = "digests") -> DataFrame:
    """Encode every text and decode it again.

    `docs` has doc_id and text. `output`: "digests" gives doc_id, n_tokens, ids_sha256,
    decoded_sha256; "ids" gives doc_id, n_tokens, ids (array of ints), decoded. A null text is
    an empty one: no tokens, an empty decoded text. Repeated rows and null ids stay as they are;
    other columns are not returned, whatever their names. A very long text is encoded whole; a word
    of any length is merged in a tree of twice its length. No rows give no rows.
    """
    fields = {
        "digests": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        "ids": "doc_id long, n_tokens long, ids array<int>, decoded string",
    }[output]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in slices(texts, 1_000_000):
                counts, first, second = [], [], []
                for ids, decoded in bpe.encode_batch(texts[part]):
                    counts.append(ids.count(b" ") + 1 if ids else 0)
                    if output == "digests":
                        first.append(hashlib.sha256(ids).hexdigest())
                        second.append(hashlib.sha256(decoded).hexdigest())
                    else:
                        first.append(pa.array(list(map(int, ids.split())), pa.int32()))
                        second.append(decoded.decode())
                names = [f.split()[0] for f in fields.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[part.start : part.stop],
                        pa.array(counts, pa.int64()),
                        pa.array(first, pa.string() if output == "digests" else pa.list_(pa.int32())),
                        pa.array(second, pa.string()),
                    ],
                    names=names,
                )

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        return within_task(encode, bpe.chunk_room, bpe.word_room)(batches)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(in_task, fields)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
