"""Text normalisation as JVM-side column expressions (no Python worker).

``strip_accents`` reproduces "NFKD, then drop every combining character" for the
whole of Unicode. The tables are generated once from :mod:`unicodedata` (a rule,
not a hand list):

* characters that become exactly one other character, or vanish, go through one
  ``translate`` call (fast path, a per-character table lookup in the JVM);
* characters that expand to several characters (fractions, ligatures, Hangul
  syllables, squared CJK words ...) only occur in some rows; those rows are
  split into characters and mapped through a literal map, again all in the JVM.
  The ``rlike`` guard keeps the slower path off every other row.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Whitespace: Python's str.strip() removes every character for which
# str.isspace() is true; Java's \s is ASCII-only, so list them.
# ---------------------------------------------------------------------------
@functools.lru_cache(maxsize=None)
def _space_class() -> str:
    cps = [cp for cp in range(sys.maxunicode + 1)
           if not 0xD800 <= cp <= 0xDFFF and chr(cp).isspace()]
    return "[" + "".join(f"\\x{{{cp:X}}}" for cp in cps) + "]"


def strip_whitespace(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace (Unicode-aware, like ``str.strip``)."""
    cls = _space_class()
    return F.regexp_replace(F.regexp_replace(_col(c), f"^{cls}+", ""), f"{cls}+$", "")


def lower(c: ColumnOrName) -> Column:
    return F.lower(_col(c))


# ---------------------------------------------------------------------------
# Accents
# ---------------------------------------------------------------------------
def _strip_one(ch: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))


@functools.lru_cache(maxsize=None)
def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """(translate source, translate target, one-to-many map) over all code points."""
    src_1, dst_1, deleted, multi = [], [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = _strip_one(ch)
        if out == ch:
            continue
        if len(out) == 1:
            src_1.append(ch)
            dst_1.append(out)
        elif not out:
            deleted.append(ch)
        else:
            multi[ch] = out
    # translate() deletes source characters that have no partner in the target.
    return "".join(src_1) + "".join(deleted), "".join(dst_1), multi


def _ranges(cps: list[int]) -> str:
    parts, start, prev = [], None, None
    for cp in sorted(cps) + [None]:
        if start is None:
            start = prev = cp
            continue
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        parts.append(f"\\x{{{start:X}}}" if start == prev else f"\\x{{{start:X}}}-\\x{{{prev:X}}}")
        start = prev = cp
    return "[" + "".join(parts) + "]"


@functools.lru_cache(maxsize=None)
def _multi_class() -> str:
    return _ranges([ord(k) for k in _accent_tables()[2]])


_PAIR, _KV = "\u0002", "\u0001"  # separators absent from every key and value


@functools.lru_cache(maxsize=None)
def _multi_map_text() -> str:
    return _PAIR.join(k + _KV + v for k, v in _accent_tables()[2].items())


def _multi_map() -> Column:
    # One string literal parsed into a map; constant-folded once per query plan.
    return F.str_to_map(F.lit(_multi_map_text()), F.lit(_PAIR), F.lit(_KV))


def strip_accents(c: ColumnOrName) -> Column:
    """NFKD decomposition followed by removal of combining characters."""
    src, dst, _ = _accent_tables()
    col = _col(c)
    expanded = F.array_join(
        F.transform(F.split(col, ""),
                    lambda x: F.coalesce(F.element_at(_multi_map(), x), x)), "")
    return F.translate(F.when(col.rlike(_multi_class()), expanded).otherwise(col), src, dst)


def strip_accents_legacy(c: ColumnOrName) -> Column:
    """Like :func:`strip_accents` but a null first becomes the text ``'nan'``.

    The source pipeline stringified missing values before stripping, so a null
    comment was loaded as the word 'nan'. Opt-in only (``legacy_nan=True``).
    """
    return strip_accents(F.coalesce(_col(c), F.lit("nan")))


def normalize_place(c: ColumnOrName, legacy_nan: bool = False) -> Column:
    """lower -> strip whitespace -> strip accents, the city normalisation chain.

    As one expression; :func:`with_normalized_place` is the cheaper DataFrame form.
    """
    base = strip_whitespace(lower(c))
    return strip_accents_legacy(base) if legacy_nan else strip_accents(base)


def with_normalized_place(df, src: str, dst: str, legacy_nan: bool = False):
    """Add ``dst`` = normalised ``src``, one projection per step.

    ``strip_accents`` reads its input three times (guard, split, pass-through) and
    the city rules read theirs twice per rule; separate projections keep each step
    evaluated once per row (Catalyst does not inline a non-trivial expression into
    several references).
    """
    tmp = f"__{dst}_base"
    strip = strip_accents_legacy if legacy_nan else strip_accents
    return (df.withColumn(tmp, strip_whitespace(lower(src)))
            .withColumn(dst, strip(F.col(tmp))).drop(tmp))


# Case-insensitive substring -> replacement for the whole city
# value, applied in this order (the first rule that matches wins).
CITY_RULES: tuple[tuple[str, str], ...] = (
    ("rio de janeiro", "rio de janeiro"),
    ("sao miguel", "sao miguel d'oeste"),
    ("sao pau", "sao paulo"),
)


def apply_contains_rules(c: ColumnOrName, rules=CITY_RULES) -> Column:
    """Replace the whole value when it contains a rule's key (case-insensitive).

    Rules are applied sequentially like the source: a later rule sees the output
    of an earlier one. None of the outputs triggers a later rule, so this equals
    a first-match ladder; it is written sequentially anyway to stay exact for
    caller-supplied rules. Nulls stay null.
    """
    out = _col(c)
    for key, value in rules:
        out = F.when(F.lower(out).contains(key.lower()), F.lit(value)).otherwise(out)
    return out


def replace_values(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Exact whole-value replacement; values not in ``mapping`` (and nulls) pass through."""
    out = _col(c)
    for old, new in mapping.items():
        out = F.when(out == F.lit(old), F.lit(new)).otherwise(out)
    return out
