"""Exact encoding with a SentencePiece model of merge type, by backtracking, and decoding.

A sequence of pieces is what merging gives if and only if every piece is what merging gives for its
own text and every two adjacent pieces are what merging gives for their texts together: the first
wrong merge would cross the border of two neighbours, and nothing outside them can bring it about.
So a text is encoded from left to right. An Aho-Corasick automaton tells the longest piece at each
position. It is taken if it goes with the piece before it, which is found out by merging both again
and remembered; if not, the next shorter piece is tried. A position from which nothing leads on is
marked in a bitfield, and the piece before it gives way to a shorter one.

Texts are cut into chunks first, where no piece has the neighbours of the cut side by side: before
spaces, say, or between a letter and a comma. Each distinct chunk is encoded once in a while: a
worker remembers chunks within a number of bytes until its task ends. What it found out about pieces
side by side it keeps, within a number of bytes, for the tasks that follow. Texts are encoded where they are read, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.bpe import slices
from kvloom.llm.common import documents
from kvloom.llm.remembered import Room, within_task

#: The sign that stands for a space in pieces.
SPACE = "▁"
_NEVER = 1 << 60


class PieceBpe:
    """The pieces of a model and their ranks: the better the score, the lower; equal scores share one.

    Only models that leave texts as they are (no normalisation but a space before the text) and that
    fall back to bytes are taken; others raise ValueError.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        # Ligature, decomposed accent and several spaces: whatever is normalised shows up here.
        probe = " ﬁ  é "
        if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model normalises texts")
        every = range(library.get_piece_size())
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(library.is_byte, self.bytes)):
            raise ValueError("the model does not fall back to bytes")
        plain = [
            i for i in every
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        self.id_of = {library.id_to_piece(i): i for i in plain}
        scores = sorted({library.get_score(i) for i in plain}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        self.rank = {p: place[library.get_score(i)] for p, i in self.id_of.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece has a space after another character")

        self.automaton = ahocorasick.Automaton()
        sound = {p for p in self.id_of if len(p) == 1 or self.merge(list(p)) == [p]}
        self.shorter: dict[str, str] = {}
        for p in sound:
            # A single character needs no match: it stands for itself, also where it is no piece.
            if len(p) > 1:
                self.automaton.add_word(p, (len(p) - 1, p))
                self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in sound), p[0])
        self.automaton.make_automaton()

        self.chunks_in = self._chunk_pattern().findall
        self.written = _Written(self.id_of, self.bytes)
        self.ids: dict[str, bytes] = {}
        #: Decoded bytes of the chunks that do not come back as they were.
        self.changed: dict[str, bytes] = {}
        #: The piece to take by the one before and the longest one that begins here.
        self.fits: dict[tuple[str, str], str] = {}
        self.chunk_room = Room(self.ids, self.changed)
        self.fit_room = Room(self.fits)

    def _chunk_pattern(self) -> re.Pattern:
        """Cuts a text only where no merge can cross: no piece has both neighbours side by side.

        That is before spaces, around characters of no longer piece, and between a letter or digit
        and a sign that stands after none of them in any piece.
        """
        longer = [p for p in self.id_of if len(p) > 1]
        joined = {c for p in longer for c in p} - {SPACE}
        word = {c for c in joined if c.isalnum()}
        apart = joined - word - {b for p in longer for a, b in zip(p, p[1:]) if a in word}

        def either(characters: set[str], but: str = "") -> str:
            return f"[{but}{''.join(map(re.escape, sorted(characters)))}]" if characters else "(?!)"

        signs, others = either(joined - word), either(joined - word - apart)
        # Signs and word characters in turn; after a word character come no signs that stand apart.
        body = f"{signs}*(?:{either(word)}++{others}{signs}*)*{either(word)}*"
        return re.compile(f" *(?={either(joined)}){body}| +|{either(joined | {' '}, '^')}", re.DOTALL)

    def merge(self, symbols: list[str], border: int = 0) -> list[str] | None:
        """Merge adjacent symbols, the best pair first, of equal ones the leftmost.

        With a border, the number of symbols left of it, a merge across it ends the work: None.
        """
        rank = self.rank.get
        ranks = [rank(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) < _NEVER:
            i = ranks.index(least)
            if i < border:
                border -= 1
                if i == border:
                    return None
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(symbols[i] + symbols[i + 1], _NEVER)
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + symbols[i], _NEVER)
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        """Do these pieces stay apart when their texts are merged together?"""
        return not left or self.merge(list(left + right), border=len(left)) is not None

    def first_fit(self, left: str, piece: str) -> str:
        """The longest of a piece and those that it begins with that goes with the one before it.

        Without one, an empty text. What was found is remembered, also for the shorter ones.
        """
        passed, right = [], piece
        while right is not None and (left, right) not in self.fits and not self.compatible(left, right):
            passed.append(right)
            right = self.shorter.get(right)
        found = "" if right is None else self.fits.get((left, right), right)
        new = [*passed, right] if right is not None else passed
        size = len(new) * (len(left) + len(piece))
        if self.fit_room.take(len(new), size):
            self.fit_room.take(len(new), size)
        for p in new:
            self.fits[left, p] = found
        return found

    def pieces(self, chunk: str) -> list[str]:
        """The pieces of a text; characters that are no piece stand alone."""
        n = len(chunk)
        longest: list[str | None] = [None] * n
        for end, (before, piece) in self.automaton.iter(chunk):
            # Ends ascend, so the last piece that starts at a position is its longest.
            longest[end - before] = piece
        fits, first_fit, shorten = self.fits, self.first_fit, self.shorter.get
        failed: bytearray | None = None
        taken: list[str] = []
        at, last = 0, ""
        piece = longest[0] or chunk[0]
        while True:
            fit = fits.get((last, piece))
            if fit is None:
                fit = first_fit(last, piece)
            if fit:
                end = at + len(fit)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    taken.append(fit)
                    if end == n:
                        return taken
                    at, last = end, fit
                    piece = longest[at] or chunk[at]
                    continue
                shorter = shorten(fit)
            else:
                shorter = None
            while shorter is None:
                # Nothing leads on from here: the piece before has to be a shorter one.
                if failed is None:
                    failed = bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                fit = taken.pop()
                at -= len(fit)
                last = taken[-1] if taken else ""
                shorter = shorten(fit)
            piece = shorter

    def encode(self, chunk: str) -> tuple[bytes, bytes]:
        """Decimal ids joined by a comma, and the bytes that they decode to, of a chunk."""
        pieces = self.pieces(chunk.replace(" ", SPACE))
        written = [self.written[p] for p in pieces]
        return b",".join([ids for ids, _ in written]), b"".join([text for _, text in written])

    def _learn(self, chunks: list[str]) -> None:
        for chunk in chunks:
            self.ids[chunk], text = self.encode(chunk)
            if text != chunk.encode():
                self.changed[chunk] = text

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Decimal ids joined by a comma, and the bytes decoded from them, of each text."""
        # A space goes before every text; decoding takes it away.
        found = [self.chunks_in(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        every = set().union(*found) if found else set()
        new = list(every - self.ids.keys())
        if self.chunk_room.take(len(new), 6 * sum(map(len, new))):
            new = list(every)
            self.chunk_room.take(len(new), 6 * sum(map(len, new)))
        self._learn(new)
        ids, changed = self.ids, self.changed
        odd = changed.keys() & every
        for line in found:
            if odd and not odd.isdisjoint(line):
                text = b"".join([changed[c] if c in odd else c.encode() for c in line])
            else:
                text = "".join(line).encode()
            yield b",".join([ids[c] for c in line]), text[1:]


class _Written(dict):
    """Ids of a piece as decimals joined by a comma, and the bytes that those ids decode to.

    A character that is no piece is written by the ids of its bytes, each of which decodes to one.
    """

    def __init__(self, id_of: dict[str, int], byte_ids: list[int]):
        text_of = {i: p.replace(SPACE, " ").encode() for p, i in id_of.items()}
        super().__init__({p: (str(i).encode(), text_of[i]) for p, i in id_of.items()})
        self.byte_ids = byte_ids
        self.byte_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}

    def __missing__(self, character: str) -> tuple[bytes, bytes]:
        ids = [self.byte_ids[b] for b in character.encode()]
        return ",".join(map(str, ids)).encode(), b"".join([self.byte_of[i] for i in ids])


_LOADED: dict[str, PieceBpe] = {}


def loaded(path: str) -> PieceBpe:
    """The model, read once a worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceBpe(path)
    return _LOADED[path]


def encode_decode_pieces(docs: DataFrame, path: str, output: str = "digests") -> DataFrame:
    """Encode every text with a merge-type model and decode it again.

    `docs` has doc_id and text; other columns are not returned, whatever their names. `output`:
    "digests" gives doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256;
    "ids" gives doc_id, n_tokens, ids (array of ints), decoded.

    A null text is an empty one: no ids, an empty decoded text. Null ids and repeated rows stay as
    they are. The sign that stands for spaces is read as a space, so it comes back as one. A very
    long text is encoded whole; a chunk without a cut takes time in proportion to its length, and
    memory of some hundred times that of the text. No rows give no rows.
    """
    fields = {
        "digests": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        "ids": "doc_id long, n_tokens long, ids array<int>, decoded string",
    }[output]
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in slices(texts, 1_000_000):
                counts, first, second = [], [], []
                for ids, text in model.encode_batch(texts[part]):
                    counts.append(ids.count(b",") + 1 if ids else 0)
                    if output == "digests":
                        first.append(hashlib.sha256(ids).hexdigest())
                        second.append(hashlib.sha256(text).hexdigest())
                    else:
                        first.append(pa.array(list(map(int, ids.split(b",") if ids else ())), pa.int32()))
                        second.append(text.decode())
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
        model = loaded(path)
        return within_task(run, model.chunk_room)(batches)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(in_task, fields)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode_pieces(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
