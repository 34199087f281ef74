"""Text that looks alike but differs in its characters: one consistent form.

Each character has a quick-check property: stable, or unstable because it is a
width or presentation form, an invisible or blank character, a combining mark,
or a look-alike of another letter. A text whose characters are all stable is
its own canonical form, which one search settles. Of the others only the unstable segments are normalised, each with the base character
before and the marks behind it as context, and the results are spliced into the
unchanged rest.

Equal canonical form means: reads the same to the eye, character for character.
Letter case, visible accents, punctuation and wording still count.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jurisdiff.session import materialize

# Letters of Greek, Cyrillic, Armenian, Latin extensions, Cherokee, Coptic and Lisu and the
# Latin letter each looks like. Styled letters (mathematical, wide, small and the like) follow by rule, see _SAME_LOOK.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C",
    "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ѵ": "v", "Ү": "Y", "һ": "h", "Ӏ": "l", "ԁ": "d", "ԛ": "q", "Ԛ": "Q", "ԝ": "w", "Ԝ": "W",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ı": "i", "ȷ": "j", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g",
    "Ԍ": "G", "ӏ": "l", "Լ": "L", "Օ": "O", "Ս": "U", "Տ": "S", "գ": "q", "զ": "q",
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
    "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    "ꓐ": "B", "ꓑ": "P", "ꓒ": "d", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}

# Han characters and the Katakana each looks like; they change beside Katakana only.
HAN_KATAKANA = {"口": "ロ", "力": "カ", "夕": "タ", "卜": "ト", "工": "エ", "二": "ニ", "八": "ハ", "才": "オ", "厶": "ム", "丿": "ノ", "千": "チ", "三": "ミ"}
# Hiragana and the Katakana each looks like; the neighbours decide which of the two stands.
HIRAGANA_KATAKANA = {"へ": "ヘ", "べ": "ベ", "ぺ": "ペ", "り": "リ"}

#: Invisible characters: joiners, marks of direction, soft hyphen, variation selectors and the like.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁤⁦-⁯ㅤ︀-️﻿ﾠ"
BLANK = "\t\n\u000b\u000c\r\u0085    -     　"
# Compatibility forms that look like what they decompose to; circled, raised and squared forms do not.
_SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<small>", "<vertical>", "<font>")


_HIGH = re.compile("[\U00010000-\U0010ffff]")  # kept apart: a class within one plane is searched by table
_KANA = frozenset([*map(chr, range(0x30A1, 0x30FB)), "ー"])
_HAN, _HIRA, _KATA = "".join(HAN_KATAKANA), "".join(HIRAGANA_KATAKANA), "".join(HIRAGANA_KATAKANA.values())
_KATA_MAP = {v: k for k, v in HIRAGANA_KATAKANA.items()}


def _letters(c: str) -> str:
    """What the characters of a segment stand for, blanks and invisible ones aside."""
    out = []
    for x in unicodedata.normalize("NFD", c):
        kind, _, rest = unicodedata.decomposition(x).partition(" ")
        out.append("".join(_letters(chr(int(y, 16))) for y in rest.split()) if kind in _SAME_LOOK else LOOKALIKES.get(x, x))
    return unicodedata.normalize("NFC", "".join(out))


def _fails(c: str) -> bool:
    return unicodedata.combining(c) > 0 or _letters(c) != c or bool(re.match(f"[{INVISIBLE}]", c)) or bool(re.match(f"[{BLANK}]", c))


@lru_cache(None)
def unstable_ranges() -> list[tuple[int, int]]:
    """Ranges of the characters beyond ASCII that fail the quick check wherever they stand; those of the higher planes all do."""
    out: list[list[int]] = []
    for c in range(0x80, 0x10000):
        if not 0xD800 <= c < 0xE000 and _fails(chr(c)):
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
    return [(a, b) for a, b in out]


@lru_cache(None)
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
    bad = "\t\n\x0b\f\r" + "".join(chr(a) + ("-" + chr(b) if b > a else "") for a, b in unstable_ranges())
    return re.compile(f"[{bad}]"), re.compile(f"(?:[{bad}]|[\U00010000-\U0010ffff])+"), re.compile(f"[{INVISIBLE}]+"), re.compile(f"[{_HAN}{_HIRA}{_KATA}]")


def _settle_kana(s: str) -> str:
    """Han, Hiragana and Katakana of one look become the one their neighbours call for: passes left to right and back until none changes."""
    places = [m.start() for m in _patterns()[3].finditer(s)]
    if not places:
        return s
    text = list(s)
    for _ in range(4):  # what spreads does so in one pass of its direction; marks of both scripts side by side settle in the next ones
        changed = False
        for order in (places, reversed(places)):
            for i in order:
                c = text[i]
                before, after = i > 0 and text[i - 1] in _KANA, i + 1 < len(text) and text[i + 1] in _KANA
                new = HAN_KATAKANA.get(c) if before or after else None
                if c in HIRAGANA_KATAKANA and before and after:
                    new = HIRAGANA_KATAKANA[c]
                elif c in _KATA_MAP and not before and not after:
                    new = _KATA_MAP[c]
                if new:
                    text[i], changed = new, True
        if not changed:
            break
    return "".join(text)


@lru_cache(1 << 16)
def _canonical_segment(t: str) -> str:
    return re.sub(f"[{BLANK}]", " ", _letters(_patterns()[2].sub("", t)))


def canonical(s: str) -> str:
    """The canonical form of one text; canonical(canonical(s)) == canonical(s)."""
    if s.isascii() and s.isprintable() and "  " not in s and s == s.strip(" "):
        return s
    check, segment, _, _ = _patterns()
    if check.search(s) or _HIGH.search(s):
        out, at = [], 0
        for m in segment.finditer(s):
            start = max(at, m.start() - 1)  # the character before a segment goes along: a mark may compose with it
            out += [s[at:start], _canonical_segment(s[start : m.end()])]
            at = m.end()
        s = "".join([*out, s[at:]])
        # What was spliced may stand beside a mark: one more look at the context.
        if check.search(s):
            s = _letters(s)
    if "  " in s or s[:1] == " " or s[-1:] == " ":
        s = re.sub("  +", " ", s).strip(" ")
    for _ in range(len(s) + 1):
        t = _settle_kana(s)
        if t == s:
            break
        s = _letters(t) if check.search(t) else t  # a mark may compose with the new letter
    return s


def canonical_column(df: DataFrame, column: str, to: str) -> DataFrame:
    """df with the canonical form of a string column; null stays null. ASCII without irregular blanks never leaves the JVM."""

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: canonical(s) if isinstance(s, str) else None)

    return df.withColumn(to, F.coalesce(form(F.when(F.col(column).rlike(r"[^!-~ ]|^ | $|  "), F.col(column))), F.col(column)))


#: Rows of one text in one task of a pair expansion; a text with more is spread over several.
ROWS_A_TASK = 20_000


def alike_pairs(rows: DataFrame) -> DataFrame:
    """field, row_key_a, row_key_b (a < b): rows of one group whose texts differ but have the same canonical form.

    rows: field, grp, row_key, text. Null texts and null groups pair with
    nothing; empty texts only with texts of blanks and invisible characters.
    Equal texts are not paired with one another. Texts are paired once per
    distinct form, then expanded to their rows, so the work follows the result;
    a text repeated in very many rows is salted over tasks.
    """
    keyed = canonical_column(rows.where("text is not null and grp is not null"), "text", "form")
    digest = lambda c: F.unhex(F.md5(F.col(c)))
    base = materialize(keyed.select("field", "row_key", digest_group(), digest("text").alias("t")), "forms")
    texts = base.groupBy("field", "g", "t").agg(F.count("*").alias("n"))
    varied = texts.groupBy("field", "g").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("field", "g")
    few = texts.join(varied, ["field", "g"], "left_semi").withColumn("salts", F.ceil(F.col("n") / ROWS_A_TASK).cast("int"))
    members = base.join(few.select("field", "g", "t", "salts"), ["field", "g", "t"]).withColumn("salt", F.pmod(F.xxhash64("row_key"), F.col("salts")).cast("int"))
    spread = lambda df, s: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col(s) - 1)))
    a, b = few.select("field", "g", F.col("t").alias("ta"), F.col("salts").alias("sa")), few.select("field", "g", F.col("t").alias("tb"), F.col("salts").alias("sb"))
    pairs = a.join(b, ["field", "g"]).where("ta < tb")
    left = spread(pairs, "sa").join(members.select("field", "g", F.col("t").alias("ta"), "salt", F.col("row_key").alias("ka")), ["field", "g", "ta", "salt"]).drop("salt")
    both = spread(left, "sb").join(members.select("field", "g", F.col("t").alias("tb"), "salt", F.col("row_key").alias("kb")), ["field", "g", "tb", "salt"])
    return both.select("field", F.least("ka", "kb").alias("row_key_a"), F.greatest("ka", "kb").alias("row_key_b")).where("row_key_a < row_key_b")


def alike_classes(rows: DataFrame) -> DataFrame:
    """field, row_key, class_key, forms, members: every row of a class of texts that look alike but differ, by the class's smallest row_key.

    The same classes as alike_pairs, in one row a member instead of a row a
    pair. rows as there.
    """
    keyed = canonical_column(rows.where("text is not null and grp is not null"), "text", "form")
    base = materialize(keyed.select("field", "row_key", digest_group(), F.unhex(F.md5("text")).alias("t")), "forms")
    texts = base.groupBy("field", "g", "t").agg(F.count("*").alias("n"), F.min("row_key").alias("k"))
    classes = texts.groupBy("field", "g").agg(F.min("k").alias("class_key"), F.count("*").alias("forms"), F.sum("n").alias("members")).where("forms > 1")
    return base.join(classes, ["field", "g"]).select("field", "row_key", "class_key", "forms", "members")


def digest_group():
    """Identity of a group and canonical form, in 16 bytes."""
    return F.unhex(F.md5(F.concat_ws("\x00", F.col("grp").cast("string"), F.col("form")))).alias("g")
