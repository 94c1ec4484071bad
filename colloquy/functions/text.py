"""Text and hash expressions, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that Unicode-aware splitting treats as white space, as a Java character class.
UNICODE_SPACE = "[\\s\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")


#: Those of them that are rare in texts.
RARE_SPACE = "[\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def collapse_space(text: Column) -> Column:
    """Runs of white space as one space, none at the ends; texts with common white space alone need one short pattern."""
    common = F.regexp_replace(F.translate(text, "\t\n\x0b\x0c\r", "     "), " {2,}", " ")
    return F.trim(F.when(text.rlike(RARE_SPACE), F.regexp_replace(text, f"{UNICODE_SPACE}+", " ")).otherwise(common))


def json_string(text: Column) -> Column:
    """A JSON string literal, non-ASCII kept."""
    inner = F.to_json(F.array(text))
    return F.substring(inner, F.lit(2), F.length(inner) - 2)


def branch_of(dialogue_id: Column) -> Column:
    """The id up to its last dash; the whole id if it has none."""
    return F.regexp_replace(dialogue_id, "(?s)-[^-]*$", "")


def unit_bucket(fingerprint: Column, salt: str) -> Column:
    """First 64 bits of SHA-256 of salt:fingerprint, as a share of 2^64."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), fingerprint), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def split_side(fingerprint: Column, salt: str = "v1", eval_fraction: float = 0.1) -> Column:
    if not 0 < eval_fraction < 1:
        raise ValueError("eval_fraction must lie between 0 and 1")
    return F.when(unit_bucket(fingerprint, salt) < eval_fraction, "eval").otherwise("train")
