"""Normal forms of short codes and enumerated values, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every blank the normalisers treat as white space (a regex character class body).
BLANKS = r"\t\n\x0B\f\r\x{85} \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
BLANK_CHARS = "\t\n\x0b\f\r\x85 \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
HALF_WIDTH = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def fold_width(c: Column) -> Column:
    """Full-width ASCII and the ideographic space become their plain forms."""
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


def trim_blanks(c: Column) -> Column:
    """Strip blanks of any kind from both ends."""
    return F.btrim(c, F.lit(BLANK_CHARS))


def norm_code(c: Column) -> Column:
    """Country code: width-folded, trimmed, lower case; blank becomes null."""
    return F.nullif(F.lower(trim_blanks(fold_width(c))), F.lit(""))


def norm_term(c: Column) -> Column:
    """Enumerated value: case, outer blanks and the kind of word separator do not count; blank is null."""
    t = F.lower(trim_blanks(fold_width(c)))
    return F.nullif(F.regexp_replace(t, rf"[{BLANKS}_\-\x{{2010}}-\x{{2015}}\x{{2212}}]+", "_"), F.lit(""))


def norm_instant(c: Column) -> Column:
    """An ISO time in any notation as epoch microseconds; an unreadable value keeps its text; blank is null."""
    t = F.nullif(trim_blanks(c), F.lit(""))
    return F.coalesce(F.unix_micros(t.try_cast("timestamp")).cast("string"), F.concat(F.lit("?"), t))
