"""Column functions. All of them stay inside whole-stage code generation."""

from kvloom.functions.buckets import bucket_start, directory_bucket
from kvloom.functions.casting import retype_strings, string_as_double, string_as_long
from kvloom.functions.ids import canonical_uuid, is_canonical, is_time_uuid, key_id_of, lookup_uuid
from kvloom.functions.times import ntz_to_millis, utc_text

__all__ = [
    "bucket_start",
    "canonical_uuid",
    "directory_bucket",
    "is_canonical",
    "is_time_uuid",
    "key_id_of",
    "lookup_uuid",
    "ntz_to_millis",
    "retype_strings",
    "string_as_double",
    "string_as_long",
    "utc_text",
]
