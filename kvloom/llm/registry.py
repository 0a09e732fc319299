"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kvloom.llm.bpe import op2_bpe
from kvloom.llm.fingerprints import op4_fingerprints
from kvloom.llm.infill import OP11_SQL, op11_infill
from kvloom.llm.language import op8_language
from kvloom.llm.minhash import op6_minhash
from kvloom.llm.mixing import OP5_SQL, op5_mixing
from kvloom.llm.periods import op13_periods
from kvloom.llm.pieces import op12_pieces
from kvloom.llm.quality import op10_quality
from kvloom.llm.repeats import op3_repeats
from kvloom.llm.scoring import op1_scoring
from kvloom.llm.sequences import op7_sequences
from kvloom.llm.vectors import op9_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_scoring": op1_scoring,
    "op2_bpe": op2_bpe,
    "op3_repeats": op3_repeats,
    "op4_fingerprints": op4_fingerprints,
    "op5_mixing": op5_mixing,
    "op6_minhash": op6_minhash,
    "op7_sequences": op7_sequences,
    "op8_language": op8_language,
    "op9_vectors": op9_vectors,
    "op10_quality": op10_quality,
    "op11_infill": op11_infill,
    "op12_pieces": op12_pieces,
    "op13_periods": op13_periods,
}

SQL: dict[str, str] = {
    "op5_mixing": OP5_SQL,
    "op11_infill": OP11_SQL,
}
