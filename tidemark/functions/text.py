"""Text predicates, tags and normal forms."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when text is split on white space.
WHITE = (
    r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# A letter, digit or underscore of any script.
WORD = r"[\p{L}\p{N}_]"

# Fixed value: how an explicit venue tag is written in free text.
TAG_PATTERN = r"gym:\s*([a-z0-9_ ]+)"


def explicit_tag(text: Column) -> Column:
    """Value of a ``gym: name`` tag with inner spaces as underscores, else NULL."""
    found = F.trim(F.regexp_extract(F.lower(text), TAG_PATTERN, 1))
    return F.nullif(F.replace(found, F.lit(" "), F.lit("_")), F.lit(""))


def has_words(text: Column, words: list[str]) -> Column:
    """True when any phrase occurs as whole words. Expects lower-case text."""
    options = "|".join(re.escape(w) for w in words)
    return text.rlike(f"(?<!{WORD})(?:{options})(?!{WORD})")


def has_stems(text: Column, stems: list[str]) -> Column:
    """True when any word starts with one of the stems. Expects lower-case text."""
    options = "|".join(re.escape(s) for s in stems)
    return text.rlike(f"(?<!{WORD})(?:{options})")


def squeeze(text: Column) -> Column:
    """Lower case, white space runs as one blank, none at the ends."""
    single = F.regexp_replace(F.coalesce(text, F.lit("")), WHITE + "+", " ")
    return F.lower(F.trim(single))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.length(squeeze(text)), F.lit(0)) == 0


def fingerprint(text: Column) -> Column:
    """Digest of the whole normalised text; equal texts share it."""
    return F.sha2(squeeze(text), 256)


def trim_white(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"^{WHITE}+", ""), f"{WHITE}+$", "")


def strip_fences(text: Column) -> Column:
    """Remove a surrounding code fence and trailing semicolons."""
    bare = trim_white(text)
    bare = F.regexp_replace(bare, f"^(?i)```(?:sql)?{WHITE}*", "")
    bare = F.regexp_replace(bare, f"{WHITE}*```$", "")
    return F.regexp_replace(trim_white(bare), ";+$", "")
