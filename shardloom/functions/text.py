"""Cleaning rules as Spark column expressions (JVM-side, whole-stage codegen friendly).

Every rule is a pure ``Column -> Column`` function so Catalyst can fuse the whole chain
into one projection next to the scan. Regexes use explicit Unicode classes: Java's ``\\s``
and ``\\d`` are ASCII-only, while the rules are defined over Python's Unicode ``str``
semantics (``isspace``, ``isalpha``, ``isdigit``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the rule definitions of the original pipeline).
#
# Whitespace = every code point where Python's str.isspace() is true:
#   U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029,
#   U+202F, U+205F, U+3000
# Digits = Python str.isdigit(): category Nd plus
#   U+00B2-00B3, U+00B9, U+1369-1371, U+19DA, U+2070, U+2074-2079, U+2080-2089,
#   U+2460-2468, U+2474-247C, U+2488-2490, U+24EA, U+24F5-24FD, U+24FF, U+2776-277E,
#   U+2780-2788, U+278A-2792, U+10A40-10A43, U+10E60-10E68, U+11052-1105A, U+1F100-1F10A
# Quality thresholds: 100 <= length <= 80,000; alpha ratio >= 0.62; digit ratio <= 0.15.
# Boilerplate (case-insensitive, anchored at the start of the text):
#   (cookie|privacy) policy | all rights reserved | copyright \d{4} | subscribe (to|now)
#   | (sign|log) (in|up) | \d+\s*(comments?|shares?|likes?|views?)
#   | (click here|read more|see also) | advertisement | this (article|page) (was|is)
# Wikitext artifacts: "@-@" -> "-", "@,@" -> ",", "@.@" -> "."
# Heading line: ^=+.*=+$        Symbols-only line: ^[\W_]+$
# Citations: \[[0-9]+\] and, case-insensitive, \[[^\]]*citation[^\]]*\]
# ---------------------------------------------------------------------------
WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
             (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
             (0x3000, 0x3000)]
EXTRA_DIGIT_RANGES = [(0xB2, 0xB3), (0xB9, 0xB9), (0x1369, 0x1371), (0x19DA, 0x19DA),
                      (0x2070, 0x2070), (0x2074, 0x2079), (0x2080, 0x2089), (0x2460, 0x2468),
                      (0x2474, 0x247C), (0x2488, 0x2490), (0x24EA, 0x24EA), (0x24F5, 0x24FD),
                      (0x24FF, 0x24FF), (0x2776, 0x277E), (0x2780, 0x2788), (0x278A, 0x2792),
                      (0x10A40, 0x10A43), (0x10E60, 0x10E68), (0x11052, 0x1105A),
                      (0x1F100, 0x1F10A)]
MIN_CHARS = 100
MAX_CHARS = 80_000
MIN_ALPHA_RATIO = 0.62
MAX_DIGIT_RATIO = 0.15
BOILERPLATE_ALTERNATIVES = [
    r"(cookie|privacy) policy",
    r"all rights reserved",
    r"copyright \d{4}",
    r"subscribe (to|now)",
    r"(sign|log) (in|up)",
    r"\d+\s*(comments?|shares?|likes?|views?)",
    r"(click here|read more|see also)",
    r"advertisement",
    r"this (article|page) (was|is)",
]
WIKI_ARTIFACTS = [("@-@", "-"), ("@,@", ","), ("@.@", ".")]

POLICIES = ("wikitext", "bookcorpus", "default")


def _char_class(ranges) -> str:
    """Body of a regex character class using ``\\x{...}`` (valid in Java and RE2)."""
    out = []
    for lo, hi in ranges:
        out.append(f"\\x{{{lo:04X}}}" if lo == hi else f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}")
    return "".join(out)


WS = _char_class(WS_RANGES)                 # class body, e.g. used as f"[{WS}]"
DIGIT = "\\p{Nd}" + _char_class(EXTRA_DIGIT_RANGES)


def _java_unicode(p: str) -> str:
    """Translate Python-regex shorthands used by the rules to explicit Unicode classes."""
    return p.replace("\\d", "\\p{Nd}").replace("\\s", f"[{WS}]")


BOILERPLATE_RE = "(?iu)^(?:" + "|".join(_java_unicode(a) for a in BOILERPLATE_ALTERNATIVES) + ")"
HEADING_RE = "^=+.*=+$"
SYMBOLS_ONLY_RE = "^[^\\p{L}\\p{N}]+$"
NUM_CITATION_RE = "\\[[0-9]+\\]"
WORD_CITATION_RE = "(?iu)\\[[^\\]]*citation[^\\]]*\\]"
LINE_BREAK_RE = "\\r\\n|\\r|\\n"


@dataclass(frozen=True)
class QualityRules:
    min_chars: int = MIN_CHARS
    max_chars: int = MAX_CHARS
    min_alpha: float = MIN_ALPHA_RATIO
    max_digit: float = MAX_DIGIT_RATIO


def split_lines(c: Column) -> Column:
    """Lines of a text; without a CR the break is one character, which needs no regex engine."""
    return F.when(F.contains(c, F.lit("\r")), F.split(c, LINE_BREAK_RE, -1)).otherwise(F.split(c, "\n", -1))


# --------------------------------------------------------------------------- predicates

def not_blank(c: Column) -> Column:
    """non-null and containing a non-whitespace character (Python ``s.strip()``)."""
    return c.isNotNull() & c.rlike(f"[^{WS}]")


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()`` over the Unicode whitespace set."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


# --------------------------------------------------------------------------- P1-P7

def _latin1(c: Column) -> Column:
    """No code point beyond U+00FF."""
    return ~c.rlike("[^\\x{00}-\\x{FF}]")


def _latin1_class(member) -> str:
    """The Latin-1 members of a class, one by one: the regex engine looks them up in a table, while every range and
    property of a class is a test of its own."""
    return "".join(f"\\x{{{i:02X}}}" for i in range(256) if member(chr(i)))


LATIN1_WS = _latin1_class(str.isspace)
SPACE = "\\x{20}"
LATIN1_ALPHA = _latin1_class(lambda x: x.isalpha() or x.isspace())
LATIN1_DIGIT = _latin1_class(str.isdigit)


def _replaced(c: Column, latin1: str, pattern: str, by: str) -> Column:
    """``pattern`` replaced; ``latin1`` is the same pattern for texts without code points beyond U+00FF, which most are."""
    return F.when(_latin1(c), F.regexp_replace(c, latin1, by)).otherwise(F.regexp_replace(c, pattern, by))


def normalize_text(c: Column) -> Column:
    """Strip, tab to space, collapse whitespace runs (collapse first, then trim ' ')."""
    plain = F.when(F.contains(c, F.lit("  ")) | c.rlike(f"[{LATIN1_WS.replace(SPACE, '')}]"), F.regexp_replace(c, f"[{LATIN1_WS}]++", " ")).otherwise(c)
    return F.trim(F.when(_latin1(c), plain).otherwise(F.regexp_replace(c, f"[{WS}]++", " ")))


def fix_wiki_artifacts(c: Column) -> Column:
    """The three ``@x@`` wikitext artifacts."""
    fixed = c
    for old, new in WIKI_ARTIFACTS:
        fixed = F.replace(fixed, F.lit(old), F.lit(new))
    return F.when(F.contains(c, F.lit("@")), fixed).otherwise(c)


def is_heading(c: Column) -> Column:
    return c.rlike(HEADING_RE)


def is_symbols_only(c: Column) -> Column:
    return c.rlike(SYMBOLS_ONLY_RE)


def remove_wiki_markup(c: Column) -> Column:
    """P3+P4: heading lines and symbols-only lines become empty."""
    return F.when(is_heading(c) | is_symbols_only(c), F.lit("")).otherwise(c)


def is_boilerplate(c: Column) -> Column:
    return c.rlike(BOILERPLATE_RE)


def remove_boilerplate(c: Column) -> Column:
    """P5: a boilerplate opening empties the whole text."""
    return F.when(is_boilerplate(c), F.lit("")).otherwise(c)


def remove_citations(c: Column) -> Column:
    """P6+P7: numeric citations, then bracket groups mentioning 'citation'. No re-collapse."""
    without = F.regexp_replace(F.regexp_replace(c, NUM_CITATION_RE, ""), WORD_CITATION_RE, "")
    return F.when(F.contains(c, F.lit("[")), without).otherwise(c)


# --------------------------------------------------------------------------- P8-P10

# What does not count goes run by run: a replacement for each single character would take most of the time.

def alpha_count(c: Column) -> Column:
    return F.length(_replaced(c, f"[^{LATIN1_ALPHA}]++", f"[^\\p{{L}}{WS}]++", ""))


def digit_count(c: Column) -> Column:
    return F.length(_replaced(c, f"[^{LATIN1_DIGIT}]++", f"[^{DIGIT}]++", ""))


def alpha_ratio(c: Column) -> Column:
    """(letters + whitespace) / length; 0.0 for empty text."""
    n = F.length(c)
    return F.when(n > 0, alpha_count(c) / n).otherwise(F.lit(0.0))


def digit_ratio(c: Column) -> Column:
    """Digits (``str.isdigit``) / length; 0.0 for empty text."""
    n = F.length(c)
    return F.when(n > 0, digit_count(c) / n).otherwise(F.lit(0.0))


def quality_reason(c: Column, rules: QualityRules = QualityRules()) -> Column:
    """P10 as an ordered CASE: NULL when the text passes, else the first failed rule.

    The cheap length tests come first; CASE evaluates branches in order, so the regex
    based ratios only run on texts of admissible length.
    """
    n = F.length(c)
    return (F.when(n < rules.min_chars, F.lit("too_short"))
            .when(n > rules.max_chars, F.lit("too_long"))
            .when(alpha_count(c) / n < rules.min_alpha, F.lit("low_alpha"))
            .when(digit_count(c) / n > rules.max_digit, F.lit("high_digit")))


def passes_quality(c: Column, rules: QualityRules = QualityRules()) -> Column:
    return quality_reason(c, rules).isNull()


# --------------------------------------------------------------------------- P11

def registry_value(source: Column, mapping: dict) -> Column:
    """A source's entry in a driver-side registry (bounded by construction); null for others."""
    if not mapping:
        return F.lit(None)
    return F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])[source]


def policy_of_registry(source: Column, mapping: dict[str, str], default: str = "default") -> Column:
    """Cleaning policy of a source by the registry."""
    return F.coalesce(registry_value(source, mapping), F.lit(default))


# --------------------------------------------------------------------------- P12-P15

def source_of_shard(shard_id: Column) -> Column:
    """First '__' part of a shard id."""
    return F.substring_index(shard_id, "__", 1)


def shard_id_expr(source: Column, split: Column, idx: Column) -> Column:
    """Shard id ``source__split__NNNNNN``."""
    return F.format_string("%s__%s__%06d", source, split, idx)


def sha1_hex(c: Column) -> Column:
    """SHA-1 hex of the UTF-8 bytes."""
    return F.sha1(F.encode(c, "UTF-8"))


def sha256_hex(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def sha256_mod(c: Column, modulus: int = 10_000) -> Column:
    """256-bit SHA-256 value mod ``modulus``, folded over eight 32-bit hex chunks.

    Unrolled into plain arithmetic so it stays inside whole-stage codegen.
    """
    h = sha256_hex(c)
    acc = F.lit(0).cast("long")
    for i in range(8):
        chunk = F.conv(F.substring(h, i * 8 + 1, 8), 16, 10).cast("long")
        acc = (acc * F.lit(4294967296) + chunk) % F.lit(modulus)
    return acc


def split_of_shard(shard_id: Column, test_frac: float = 0.001, val_frac: float = 0.005) -> Column:
    """Deterministic split from ``sha256(shard_id) mod 10000``."""
    test_cut = int(test_frac * 10000)
    val_cut = int((val_frac + test_frac) * 10000)
    h = sha256_mod(shard_id)
    return (F.when(h < test_cut, F.lit("test"))
            .when(h < val_cut, F.lit("validation"))
            .otherwise(F.lit("train")))
