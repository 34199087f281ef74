"""Text, URL and date functions as JVM expressions over columns.

White space is every blank of ``codes.BLANKS``; lengths count code points.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from jurisdiff.functions.codes import BLANKS, trim_blanks
from jurisdiff.functions.values import BODY_CHARS, LABEL_CHARS, SNIPPET_CHARS

WS = f"[{BLANKS}]"
_SCRIPT = r"(?is)<script\b[^>]*>.*?</script>"
_STYLE = r"(?is)<style\b[^>]*>.*?</style>"
NEWS_HOSTS = ("news.google.com", "news.url.google.com")
TRACKING = ("utm_source", "utm_medium", "utm_campaign")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    # A lone space stays as it is, which spares nearly all replacements in running text.
    return F.trim(F.regexp_replace(c, f"[{BLANKS.replace(' ', '', 1)}]{WS}*| {WS}+", " "))


def strip_html(c: Column) -> Column:
    """Text of a page: scripts and styles go with their content, every other tag becomes a space; entities stay as they are."""
    bare = F.regexp_replace(F.regexp_replace(c, _SCRIPT, ""), _STYLE, "")
    return squeeze(F.when(F.contains(c, F.lit("<")), F.regexp_replace(bare, "<[^>]+>", " ")).otherwise(c))


def fragment_text(c: Column) -> Column:
    return F.substring(strip_html(c), 1, SNIPPET_CHARS)


def article_body(c: Column) -> Column:
    return F.substring(strip_html(c), 1, BODY_CHARS)


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: unicodedata.normalize("NFKC", s) if isinstance(s, str) else None)


def event_label(c: Column, compat: bool = True) -> Column:
    """Comparable form of an event's name: lower case, compatibility forms folded, addresses and signs as spaces, 120 characters; null becomes ''.

    compat: fold compatibility forms. Only texts beyond ASCII leave the JVM for it.
    """
    low = F.lower(F.coalesce(c, F.lit("")))
    if compat:
        low = F.coalesce(nfkc(F.when(low.rlike(r"[^\x00-\x7f]"), low)), low)
    words = F.regexp_replace(F.regexp_replace(low, rf"https?://[^{BLANKS}]+", " "), r"[^\p{L}\p{N}]+", " ")
    return F.substring(F.trim(F.regexp_replace(words, " +", " ")), 1, LABEL_CHARS)


def first_truthy(*cols: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def url_host(c: Column) -> Column:
    """Host in lower case; null for what is no URL."""
    return F.lower(F.try_parse_url(c, F.lit("HOST")))


def is_news_search(c: Column) -> Column:
    """Does the link lead to a search-news host? What is no URL doesn't."""
    h = url_host(c)
    return F.coalesce(h.isin(*NEWS_HOSTS) | h.endswith("." + NEWS_HOSTS[0]), F.lit(False))


def normalize_url(c: Column) -> Column:
    """Without fragment and tracking parameters, scheme and host in lower case, no default port, "/" for an empty path; other texts stay."""
    bare = F.regexp_replace(c, "#.*$", "")
    for p in TRACKING:
        bare = F.regexp_replace(bare, rf"([?&]){p}=[^&]*", "$1")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, "&&+", "&"), r"\?&", "?"), "[?&]$", "")
    once = lambda c, f: F.element_at(F.transform(F.array(c), f), 1)  # noqa: E731 - a value used several times is computed once
    port = lambda o: F.regexp_replace(F.regexp_replace(o, "^(http://[^/]*):80$", "$1"), "^(https://[^/]*):443$", "$1")
    path = lambda rest: F.when(rest == "", "/").when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)
    whole = lambda b, o: F.when(o != "", F.concat(port(o), once(F.substring(b, F.length(o) + 1, F.length(b)), path)))
    return F.coalesce(once(bare, lambda b: once(F.lower(F.regexp_extract(b, r"^(?i)(https?://[^/?]+)", 1)), lambda o: whole(b, o))), c)


def resolve_url(href: Column, base: Column) -> Column:
    """An absolute, protocol-relative, root-relative, query or directory-relative link against the page it stands on (without ".." segments)."""
    scheme, origin = F.regexp_extract(base, r"^(?i)(https?:)", 1), F.regexp_extract(base, r"^(?i)(https?://[^/?#]+)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(page.rlike(r"^(?i)https?://[^/]+$"), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?") | href.startswith("#"), F.concat(page, href))
        .otherwise(F.concat(folder, F.regexp_replace(href, r"^(\./)+", "")))
    )


def encode_component(c: Column) -> Column:
    """Percent-encoding with %20 for a space; ~ ! ' ( ) and * stay."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for code, sign in (("%7E", "~"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def news_search_url(query: Column, prefix: str, suffix: str) -> Column:
    """Search-feed address of a query."""
    return F.concat(F.lit(prefix), encode_component(query), F.lit(suffix))


def is_ymd(c: Column) -> Column:
    """Has the text the shape of a date, possible or not? Null has not."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def rolled_date(c: Column) -> Column:
    """The date of a text of that shape; months and days beyond the calendar roll over. Null for other shapes and the year 0."""
    part = lambda a, n: F.substring(c, a, n).try_cast("int")
    ok = is_ymd(c) & (part(1, 4) > 0)
    return F.when(ok, F.date_add(F.add_months(F.make_date(F.when(ok, part(1, 4)), F.lit(1), F.lit(1)), part(6, 2) - 1), part(9, 2) - 1))


def days_between(earlier: Column, later: Column) -> Column:
    """Whole days from one date text to another."""
    return F.datediff(rolled_date(later), rolled_date(earlier))


def month_key(c: Column) -> Column:
    return F.substring(c, 1, 7)


def format_minute(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm UTC`` of a timestamp; the session's time zone is UTC."""
    return F.date_format(c, "yyyy-MM-dd HH:mm 'UTC'")


def content_hash(c: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes, in hex; null counts as empty."""
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def charset_name(header: Column, head: Column) -> Column:
    """Character set of a page: from its header, else from its first 2,000 bytes, else utf-8; lower case."""
    of = lambda c: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?i)charset=[\"']?([\w-]+)", 1), F.lit(""))
    return F.lower(F.coalesce(of(header), of(F.substring(head, 1, 2000)), F.lit("utf-8")))


# The mark before a page's content in what a reader service returns, and the date line that may follow it.
READER_MARK, _READER_DATE = "\nMarkdown Content:\n", rf"^{WS}*20\d{{2}}[-/.年]{WS}?\d{{1,2}}[-/.月]{WS}?\d{{1,2}}日?[^\n]*\n"


def strip_reader_preamble(c: Column) -> Column:
    """Text of a page fetched through a reader: what follows the content mark (up to a second one), without a leading date line."""
    return F.regexp_replace(F.coalesce(F.try_element_at(F.split(c, READER_MARK), F.lit(2)), c), _READER_DATE, "")


def truncated(c: Column, n: int = LABEL_CHARS) -> Column:
    return F.substring(c, 1, n)
