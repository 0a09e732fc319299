"""Entity ids as canonical lower-case UUID text, and key ids given as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: UUID text forms -------------------------------------------
CANONICAL_FORM = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
BARE_FORM = r"^[0-9a-f]{32}\z"
DECORATION = r"urn:|uuid:|[{}-]"
HEX_GROUPS = r"^(.{8})(.{4})(.{4})(.{4})(.{12})\z"
# An integer as text, with ASCII white space around it.
KEY_ID_FORM = r"^[\x20\x09-\x0D]*([+-]?[0-9]+)[\x20\x09-\x0D]*\z"
# ----------------------------------------------------------------------------


def canonical_uuid(text: Column) -> Column:
    """Canonical form of a UUID text, null where the text is no UUID.

    Texts that are canonical already, the normal case, cost one pattern match.
    """
    bare = F.regexp_replace(F.lower(F.trim(text)), DECORATION, "")
    rebuilt = F.regexp_replace(bare, HEX_GROUPS, "$1-$2-$3-$4-$5")
    return F.when(text.rlike(CANONICAL_FORM), text).when(bare.rlike(BARE_FORM), rebuilt)


def lookup_uuid(text: Column) -> Column:
    """The text to look an id up by among canonical ids.

    A text as long as a canonical id, the normal case, is only put in lower
    case; a malformed one among them is found in no table. Other texts are
    parsed.
    """
    return F.when(F.octet_length(text) == 36, F.lower(text)).otherwise(canonical_uuid(text))


def is_canonical(text: Column) -> Column:
    """Whether a text is a UUID in canonical form."""
    return text.rlike(CANONICAL_FORM)


def is_time_uuid(canonical: Column) -> Column:
    """True for version-1 ids, given canonical text."""
    return F.substring(canonical, 15, 1) == F.lit("1")


def key_id_of(text: Column) -> Column:
    """The key id that a text reads like, null where it is no 32-bit integer."""
    digits = F.regexp_extract(text, KEY_ID_FORM, 1)
    return F.when(text.rlike(KEY_ID_FORM), digits.try_cast("int"))
