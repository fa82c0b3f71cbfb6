"""Text clean-up, keys and aliases as Column expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column, functions as F

# Characters that count as white space, for Java regular expressions.
SPACE = r"[\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# The same characters, for trimming.
_SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Blocks of the Basic Multilingual Plane whose letters are folded to plain ones.
_FOLDED_BLOCKS = (
    (0x00A0, 0x024F),  # Latin-1 supplement, Latin extended A and B
    (0x1E00, 0x1EFF),  # Latin extended additional
    (0x2000, 0x206F),  # general punctuation
    (0x2070, 0x209F),  # superscripts and subscripts
    (0x2100, 0x218F),  # letter-like symbols and number forms
    (0x3000, 0x3000),  # ideographic space
    (0xFB00, 0xFB06),  # ligatures
    (0xFF01, 0xFF5E),  # full-width forms
)


@cache
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Compatibility decomposition without combining marks, built from the Unicode rule."""
    source, target, longer = [], [], []
    for first, last in _FOLDED_BLOCKS:
        for char in map(chr, range(first, last + 1)):
            plain = "".join(
                c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
            )
            if plain == char:
                continue
            if len(plain) == 1:
                source.append(char)
                target.append(plain)
            else:
                longer.append((char, plain))
    return "".join(source), "".join(target), tuple(longer)


def fold_accents(c: Column) -> Column:
    """Drop accents and compatibility forms: ``é`` to ``e``, the ``fi`` ligature to two letters."""
    source, target, longer = _fold_tables()
    folded = F.regexp_replace(F.translate(c, source, target), r"\p{Mn}+", "")
    # One text literal keeps the plan small: a character and its expansion per line.
    pairs = F.split(F.lit("\n".join(a + b for a, b in longer)), "\n")
    expanded = F.aggregate(
        pairs, folded, lambda text, p: F.replace(text, F.substring(p, 1, 1), F.substr(p, F.lit(2))))
    # Folding neither makes nor drops such characters; asked of the text itself, it is folded once.
    needs_expansion = c.rlike("[" + "".join(a for a, _ in longer) + "]")
    return F.when(needs_expansion, expanded).otherwise(folded)


def strip_space(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE_CHARS))


def clean_text(c: Column) -> Column:
    """NULL to ``''``, white-space runs to one space, trimmed."""
    return F.coalesce(F.trim(F.regexp_replace(c, rf"{SPACE}+", " ")), F.lit(""))


def canonical_text(c: Column) -> Column:
    """Upper-case ASCII key: accents folded, other runs to ``_``; NULL to ``''``."""
    folded = F.when(c.rlike(r"[^\x00-\x7f]"), fold_accents(c)).otherwise(c)
    key = F.btrim(F.regexp_replace(F.upper(folded), "[^A-Z0-9]+", "_"), F.lit("_"))
    return F.coalesce(key, F.lit(""))


def contains_total(c: Column) -> Column:
    """The word TOTAL is one of the canonical tokens."""
    return is_total_key(canonical_text(c))


def is_total_key(canonical: Column) -> Column:
    return canonical.rlike("(^|_)TOTAL(_|$)")


def sheet_key(c: Column) -> Column:
    """Sheet name for matching: trimmed, one space, case folded, accents kept."""
    return F.translate(F.replace(F.lower(clean_text(c)), F.lit("ß"), F.lit("ss")), "ς", "σ")


def slugify(c: Column) -> Column:
    """File-name part: ASCII, lower case, other runs to ``_``; what is not ASCII is dropped."""
    other = r"[^\x00-\x7f]"
    ascii_text = F.when(c.rlike(other), F.regexp_replace(fold_accents(c), other, "")).otherwise(c)
    return F.btrim(F.regexp_replace(F.lower(ascii_text), "[^a-z0-9]+", "_"), F.lit("_"))


def header_name(c: Column) -> Column:
    """Snake-case column name."""
    return F.lower(canonical_text(c))


def readable(raw: Column, ts: Column) -> Column:
    """Dates as ISO text, anything else cleaned."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), clean_text(raw))


def map_alias(c: Column, mapping: Mapping[str, Iterable[str]]) -> Column:
    """Target whose own name or alias has the same canonical text, else NULL.

    The mapping is configuration; use :func:`alias_pairs` when it comes with the data.
    """
    entries = F.lit(json.dumps({k: list(v or []) for k, v in mapping.items()}))
    return lookup_alias(canonical_text(c), alias_pairs(F.from_json(entries, "map<string,array<string>>")))


def alias_pairs(mapping: Column) -> Column:
    """MAP<target, aliases> to ARRAY<STRUCT<key, target>>, keys canonical."""
    per_target = F.transform(
        F.map_entries(mapping),
        lambda e: F.transform(
            F.concat(F.array(e["key"]), F.coalesce(e["value"], F.array().cast("array<string>"))),
            lambda alias: F.struct(canonical_text(alias).alias("key"), e["key"].alias("target")),
        ),
    )
    return F.flatten(per_target)


def lookup_alias(canonical: Column, pairs: Column) -> Column:
    """The last pair with this key wins."""
    matches = F.filter(pairs, lambda p: p["key"] == canonical)
    return F.try_element_at(matches, F.lit(-1))["target"]
