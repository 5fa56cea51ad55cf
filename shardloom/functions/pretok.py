"""NFKC normalisation and byte-level pre-tokenisation as Spark expressions.

Pre-tokens are extracted JVM-side with ``regexp_extract_all`` (Java regex supports the
look-ahead of the pattern). NFKC has no Spark built-in, so it is an Arrow (pandas) UDF,
applied only to rows that are not pure ASCII (NFKC is the identity on ASCII).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

# The byte-level pre-tokenizer pattern (published GPT-2 pattern),
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# where \s is the Unicode White_Space set:
#   U+0009-000D, U+0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000
TOKEN_WS_RANGES = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                   (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                   (0x3000, 0x3000)]


def _cls(ranges) -> str:
    return "".join(f"\\x{{{a:04X}}}" if a == b else f"\\x{{{a:04X}}}-\\x{{{b:04X}}}" for a, b in ranges)


TWS = _cls(TOKEN_WS_RANGES)
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PRETOKEN_RE = (f"{CONTRACTIONS}| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{TWS}\\p{{L}}\\p{{N}}]+"
               f"|[{TWS}]+(?![^{TWS}])|[{TWS}]+")


@F.pandas_udf(Ty.StringType())
def _nfkc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def is_ascii(c: Column) -> Column:
    return c.rlike("^\\p{ASCII}*$")


def nfkc_frame(df: DataFrame, col: str) -> DataFrame:
    """NFKC of ``col``; null and ASCII rows skip Python entirely (filter + union, no UDF call).

    Expects a materialised input (e.g. the cleaned table), since it is scanned twice.
    """
    plain = F.coalesce(is_ascii(F.col(col)), F.lit(True))
    asc = df.filter(plain)
    other = df.filter(~plain).withColumn(col, _nfkc_udf(F.col(col)))
    return asc.unionByName(other)


def with_prefix_space(c: Column) -> Column:
    """Byte-level pre-tokenizer adds one space unless the text starts with U+0020."""
    return F.when(c.startswith(" "), c).otherwise(F.concat(F.lit(" "), c))


def pretokens(c: Column, add_prefix_space: bool = True) -> Column:
    """Array of pre-token strings (their concatenation is the input)."""
    t = with_prefix_space(c) if add_prefix_space else c
    return F.regexp_extract_all(t, F.lit(PRETOKEN_RE), 0)


def utf8_bytes(c: Column) -> Column:
    """Array of the UTF-8 byte values (0-255) of a string."""
    h = F.hex(F.encode(c, "UTF-8"))
    n = (F.length(h) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.conv(F.substring(h, i * 2 + 1, 2), 16, 10).cast("int"))


# Byte-level alphabet: a byte maps to a printable character. Bytes 33-126, 161-172 and
# 174-255 map to themselves; the others map to 256, 257, ... in byte order (published
# GPT-2 rule). The alphabet is ordered by that character's code point.
def _printable(b: int) -> bool:
    return 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255


def byte_char_code(b: int) -> int:
    if _printable(b):
        return b
    return 256 + sum(1 for x in range(b) if not _printable(x))


def byte_char(b: int) -> str:
    return chr(byte_char_code(b))


def byte_char_code_expr(b: Column) -> Column:
    """Same rule as a column expression (no 256-entry table needed)."""
    printable = ((b >= 33) & (b <= 126)) | ((b >= 161) & (b <= 172)) | ((b >= 174) & (b <= 255))
    return (F.when(printable, b)
            .when(b <= 32, F.lit(256) + b)
            .when(b <= 160, F.lit(256 + 33) + (b - 127))
            .otherwise(F.lit(256 + 33 + 34)))
