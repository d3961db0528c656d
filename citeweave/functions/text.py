"""Text and URL functions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points trimmed from both ends of a text (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop all Unicode white space at both ends (``trim`` alone knows only the plain blank)."""
    return F.trim(text, F.lit(WHITESPACE))


def url_quote(text: Column) -> Column:
    """Percent-encode for a URL path: blank as ``%20``; ``/`` and ``~`` stay."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def url_unquote(text: Column) -> Column:
    """Undo percent-encoding: ``+`` stays, a ``%`` that starts no valid code stays."""
    guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B"))), text)


def item_url(base: str, ident: Column) -> Column:
    """Address of one item: the base followed by its id."""
    return F.concat(F.lit(base), ident)


def search_url(base: str, quoted_term: Column, page: Column) -> Column:
    """Address of one page of search results for an already quoted term."""
    return F.concat(F.lit(base), quoted_term, F.lit("&page="), page.cast("string"))


def clean_affixes(text: Column, prefix: str, suffix: str) -> Column:
    """Drop a leading ``prefix``, then a trailing ``suffix``, once each, trimming after each cut."""
    head = F.when(F.startswith(text, F.lit(prefix)), strip(F.substr(text, F.lit(len(prefix) + 1)))).otherwise(text)
    kept = F.char_length(head) - F.lit(len(suffix))
    return F.when(F.endswith(head, F.lit(suffix)), strip(F.substr(head, F.lit(1), kept))).otherwise(head)


def id_after_dash(text: Column) -> Column:
    """What follows the first ``-``; null where there is none."""
    return F.try_element_at(F.split(text, "-", 2), F.lit(2))


def or_default(text: Column, label: str) -> Column:
    """``No <label> available`` in place of null or the empty text."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(f"No {label} available"))
