"""Fill-in-the-middle texts, cut by a piecewise-linear learned index of token ends.

The ends of all tokens of a slice of documents form one ascending array: token number to byte
offset. Straight lines are fitted to it from left to right, each as long as it stays within an error
bound of every end it covers, and what is left over, one small integer a token, is stored beside
them. An offset is looked up by predicting it from its line and adding its residual, so cuts are
exact without keeping the offsets: a byte a token and a few numbers a line.

Everything per document happens in the task that reads it: there is no shuffle and no state, and
memory follows a slice of texts or the longest text, whichever is larger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvloom.llm.common import documents

#: The largest distance of an end from its line; residuals are signed bytes.
ERROR = 63
#: Bytes of text cut together.
SLICE_BYTES = 4_000_000
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FORMS = np.array(["plain", "spm", "psm"], object)


@dataclass
class RankIndex:
    """Lines from rank to offset, and the distance of each rank's offset from its line."""

    first: np.ndarray
    start: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.first, ranks, side="right") - 1
        return self.start[line] + np.rint(self.slope[line] * (ranks - self.first[line])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offset of each rank."""
        return self.predict(ranks) + self.residual[ranks]


def fit_lines(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Fit lines to ascending offsets, none of which is further than `error` from its line.

    A line starts at the first offset it covers. It is carried on while some slope passes within
    the bound of all offsets so far: the cone of such slopes narrows with each of them. The search
    looks at runs that double in length, so it costs a few array operations a line.
    """
    n = len(offsets)
    first, slopes = [], []
    at = 0
    while at < n:
        low, high, upto, run = -np.inf, np.inf, at + 1, 64
        while upto < n:
            end = min(n, upto + run)
            steps = np.arange(upto - at, end - at, dtype=np.float64)
            rise = (offsets[upto:end] - offsets[at]).astype(np.float64)
            # Half a unit less than the bound: predictions are rounded.
            lows = np.maximum(np.maximum.accumulate((rise - error + 0.5) / steps), low)
            highs = np.minimum(np.minimum.accumulate((rise + error - 0.5) / steps), high)
            open_ = lows <= highs
            good = len(open_) if open_.all() else int(np.argmin(open_))
            if good:
                low, high = lows[good - 1], highs[good - 1]
            upto += good
            if good < end - upto + good:
                break
            run *= 2
        first.append(at)
        slopes.append((low + high) / 2 if upto > at + 1 else 0.0)
        at = upto
    heads = np.array(first, np.int64)
    index = RankIndex(heads, offsets[heads], np.array(slopes), np.zeros(0, np.int8))
    index.residual = (offsets - index.predict(np.arange(n))).astype(np.int8)
    return index


def token_ends(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the tokens of texts that follow each other in `raw`, and how many each text has.

    A token is white space and the word after it; white space that ends a text is one, too.
    """
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ends = np.zeros(len(raw) + 1, bool)
    ends[1:-1] = ~blank[:-1] & blank[1:]
    ends[stops[stops > starts]] = True
    at = np.flatnonzero(ends)
    counts = np.searchsorted(at, stops, side="right") - np.searchsorted(at, starts, side="right")
    return at, counts


def hashed_words(salt: int, ids: list) -> np.ndarray:
    """The first four 32-bit words of the SHA-256 of salt and id, a row for each id."""
    raw = b"".join(
        hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).digest()[:16] for i in ids
    )
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def assemble(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that was made into `output`: no mark occurs in a text that is not plain."""
    if form == "plain":
        return output
    between = SUFFIX if form == "psm" else PREFIX
    cut = output.index(between, 3)
    last = output.index(MIDDLE, cut)
    one, two, middle = output[3:cut], output[cut + 3 : last], output[last + 3 :]
    return one + middle + two if form == "psm" else two + middle + one


def characters(raw: bytes) -> int:
    """Code points of UTF-8."""
    return len(raw) - int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))


@dataclass
class Rates:
    """Shares of documents, in hundredths: made over at all, and of those with the suffix first."""

    transformed: int = 50
    suffix_first: int = 80


def transform_slice(ids: list, texts: list[bytes], salt: int, rates: Rates) -> Iterator[tuple]:
    """Number of tokens, form, prefix, middle and suffix of each text, by one index for all."""
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    ends, counts = token_ends(np.frombuffer(b"".join(texts), np.uint8), starts, stops)
    h = hashed_words(salt, ids)
    cuts = np.sort(h[:, :2] % (counts + 1)[:, None], axis=1)
    marked = np.array([any(m in t for m in (PREFIX, SUFFIX, MIDDLE)) for t in texts], bool)
    plain = (sizes == 0) | marked | (h[:, 2] % 100 >= rates.transformed)
    forms = FORMS[np.where(plain, 0, np.where(h[:, 3] % 100 < rates.suffix_first, 1, 2))]
    at = np.repeat(starts[:, None], 2, axis=1)
    if len(ends):
        index = fit_lines(ends)
        # A cut after k tokens is the end of the text's k-th token; after none it is the text's start.
        rank = np.cumsum(counts)[:, None] - counts[:, None] + cuts - 1
        inside = (cuts > 0) & ~plain[:, None]
        at[inside] = index.offsets(rank[inside])
    at -= starts[:, None]
    for text, n, form, (a, b) in zip(texts, counts.tolist(), forms, at.tolist()):
        yield n, form, text[:a], text[a:b], text[b:]


def byte_slices(texts: list[bytes], most: int) -> Iterator[slice]:
    """Runs of texts of at most so many bytes together, or a single longer one."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)
TEXTS = "doc_id long, n long, form string, prefix string, middle string, suffix string, output string"


def fill_in_middle(
    docs: DataFrame, salt: int = 42, rates: Rates | None = None, output: str = "digests"
) -> DataFrame:
    """Cut every text at two token ends and put its parts into another order.

    `docs` has doc_id and text; other columns are not returned, whatever their names. `output`:
    "digests" gives doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256
    (of the text rebuilt from the output and the form); "texts" gives doc_id, n, form, prefix,
    middle, suffix, output. Parts and their lengths are null if the form is plain.

    A null text is an empty one: plain, no tokens. A null doc_id is hashed as an empty string and
    stays null. Rows that share an id get the same random numbers; repeated rows stay repeated. Texts
    that hold a mark stay plain. Both cuts may fall on one place: an empty middle. A text longer than
    a slice is cut alone, whole, and needs some twenty times its size in memory. No rows give no rows.
    """
    rates = rates or Rates()
    fields = {"digests": DIGESTS, "texts": TEXTS}[output]
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64() if f.endswith("long") else pa.string() for f in fields.split(", ")]

    def digests(n: int, form: str, prefix: bytes, middle: bytes, suffix: bytes) -> tuple:
        if form == "plain":
            whole = prefix + middle + suffix
            lengths = None, None
        else:
            whole = assemble(form, prefix, middle, suffix)
            lengths = characters(prefix), characters(middle)
        back = restore(whole, form)
        return n, form, *lengths, hashlib.sha256(whole).hexdigest(), hashlib.sha256(back).hexdigest()

    def parts(n: int, form: str, prefix: bytes, middle: bytes, suffix: bytes) -> tuple:
        if form == "plain":
            return n, form, None, None, None, (prefix + middle + suffix).decode()
        texts = (prefix, middle, suffix, assemble(form, prefix, middle, suffix))
        return n, form, *(t.decode() for t in texts)

    made = digests if output == "digests" else parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            for some in byte_slices(texts, SLICE_BYTES):
                rows = [made(*cut) for cut in transform_slice(ids[some], texts[some], salt, rates)]
                columns = [ids[some], *zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, fields)


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(documents(spark, sf_dir))


OP11_SQL = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
cut AS (
    SELECT doc_id, text,
           regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
),
ranked AS (
    SELECT *, len(tokens) AS n,
           least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a,
           greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
),
parts AS (
    SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
           array_to_string(tokens[b + 1:n], '') AS suffix
    FROM ranked
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
