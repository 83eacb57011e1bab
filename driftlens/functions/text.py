"""Column functions on text, numbers and dates with the semantics the operators rely on."""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(c) -> Column:
    """Without white space at both ends, Unicode's included; null stays null."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, f"^{SPACE}+|{SPACE}+$", "")


def text_or_blank(c) -> Column:
    return strip(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))


def blank_to_null(c) -> Column:
    return F.nullif(c, F.lit(""))


def number(c) -> Column:
    """A double, or null for anything that isn't a plain decimal number."""
    value = strip(F.col(c) if isinstance(c, str) else c)
    plain = value.rlike(r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$")
    return F.when(plain, F.regexp_replace(value, "_", "").try_cast("double"))


#: The layouts of dates that are understood, in the order they are tried.
DATE_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd", "dd-MMM-yy HH:mm", "dd-MMM-yy", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")


def timestamp(c) -> Column:
    """A timestamp, or null for blanks and for layouts that aren't known."""
    value = strip(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(layout)) for layout in DATE_LAYOUTS])


def round4(c: Column) -> Column:
    """To four decimals, halves up, in a form that engines agree on (for numbers from 0 up)."""
    return F.floor(c * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)


def round5(c: Column) -> Column:
    """To five decimals, as ``round4``."""
    return F.floor(c * F.lit(100000.0) + F.lit(0.5)) / F.lit(100000.0)


def normalise(c) -> Column:
    """Lower case, everything but letters, digits, ``_``, ``-``, ``/`` and white space blanked, white space collapsed."""
    low = F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    return strip(F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}_\s\p{Z}\-/]", " "), r"[\s\p{Z}]+", " "))


#: Characters that memo texts hold by accident.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: Comments, declarations, and tags; a quoted attribute may hold ">", and a tag with a stray quote ends at the first.
MARKUP = r"""<!--[\s\S]*?-->|<[!?][^>]*>|</?[A-Za-z](?:"[^"]*"|'[^']*'|[^"'>])*>|</?[A-Za-z][^>]*>"""
_CONTROL, _MARKUP = re.compile(CONTROL), re.compile(MARKUP)


def plain_text(html: str | None) -> str:
    """A memo's text: entities resolved first, then markup blanked, white space collapsed."""
    return " ".join(_MARKUP.sub(" ", unescape(_CONTROL.sub(" ", html))).split()) if html else ""


@F.pandas_udf(StringType())
def html_text(html: pd.Series) -> pd.Series:
    """``plain_text`` by batches."""
    return html.map(plain_text)


def html_text_native(c) -> Column:
    """``html_text`` without Python, but only for the five common entities; a quoted ``>`` ends a tag."""
    source = F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), CONTROL, " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        source = F.replace(source, F.lit(entity), F.lit(sign))
    source = F.regexp_replace(source, r"<!--[\s\S]*?-->|<[!?][^>]*>|</?[A-Za-z][^>]*>", " ")
    return F.trim(F.regexp_replace(source, r"[ \t\n\r\f]+", " "))


def references(c, pattern: str, group: int = 0) -> Column:
    """The sorted distinct matches of a pattern."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(group))))


def contained(words: tuple[str, ...] | list[str], low: Column) -> Column:
    """Those of ``words``, in their order, whose lower-case form is a substring of ``low``."""
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w.lower())), F.lit(w)) for w in words])) if words else F.array().cast("array<string>")
