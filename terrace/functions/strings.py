"""Names, tags, identifiers."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


@functools.cache
def _letters() -> tuple[str, str, dict[str, str]]:
    """Lower-case characters beyond ASCII by what compatibility decomposition without combining marks leaves of them.

    The first two strings are those that one plain letter or digit is left of, with these, and behind them the marks, which go; the
    map has those that several characters with a letter or digit among them are left of. All others count as separators.
    """
    plain, to, marks, several = [], [], [], {}
    for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x30000))):
        left = "".join(x if re.fullmatch("[a-z0-9]", x) else " " for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if not left:
            marks.append(c)
        elif left.strip() and len(left) == 1:
            plain.append(c)
            to.append(left)
        elif left.strip():
            several[c] = left
    return "".join(plain + marks), "".join(to), several


def normalize_name(name: Column) -> Column:
    """Lower case without diacritics, runs of other characters than a-z and 0-9 as one space, null if nothing is left.

    All of Unicode is decomposed by compatibility, in the JVM. ASCII names, by far the most, take no step of that.
    """
    plain, to, several = _letters()
    lower = F.lower(name)
    bare = F.translate(lower, plain, to)
    spelled = F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in several.items())), F.lit("\x02"), F.lit("\x01"))
    longer = F.array_join(F.transform(F.split(bare, ""), lambda c: F.coalesce(F.try_element_at(spelled, c), c)), "")
    some = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in several) + "]"
    own = F.when(~lower.rlike(r"[^\x00-\x7F]"), lower).when(~bare.rlike(some), bare).otherwise(longer)
    return F.nullif(F.trim(F.regexp_replace(own, "[^a-z0-9]+", " ")), F.lit(""))


def brand(tags: Column) -> Column:
    return normalize_name(F.try_element_at(tags, F.lit("brand")))


def failures(counts: Column) -> Column:
    """A map of failures as ``name:count;...`` in order of name, without zero counts; ``none`` if empty."""
    shown = F.transform(F.array_sort(F.map_entries(F.map_filter(counts, lambda _, n: n > 0))), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return F.coalesce(F.nullif(F.array_join(shown, ";"), F.lit("")), F.lit("none"))


def missing_text(value: Column) -> Column:
    return F.coalesce(F.trim(value), F.lit("")) == ""


def releases(listing: Column) -> Column:
    """All release names of a store's listing."""
    return F.regexp_extract_all(listing, F.lit(r"release/([0-9]{4}-[0-9]{2}-[0-9]{2}\.[0-9]+)/"), F.lit(1))
