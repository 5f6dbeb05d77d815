"""Text column functions.  All are plain Catalyst expressions."""

from __future__ import annotations

import string
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitarium.fixed import ACTIVITY_SEPARATORS, LABEL_JOINER, QS_DATE_FORMAT, WHITESPACE, WHITESPACE_BUT_SPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """NULL becomes empty; each run of white space becomes one space; ends trimmed."""
    # runs that are one plain space already need no replacing, and most are
    runs = f"[{WHITESPACE_BUT_SPACE}]{WHITESPACE}*| {WHITESPACE}+"
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), runs, " "))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(from, to) for ``translate`` on lower-case text.

    Letters whose canonical decomposition is one ASCII letter or digit plus combining
    marks lose the marks, the barred l becomes l, other ASCII becomes a space, and
    the marks themselves have no counterpart and vanish.
    """
    marks = [chr(p) for p in range(0x300, 0x370)]
    strip = dict.fromkeys(map(ord, marks))
    source, target = [], []
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        if letter != letter.lower() or letter in "- ":
            continue
        plain = unicodedata.normalize("NFD", letter).translate(strip).replace("ł", "l")
        if len(plain) == 1 and plain.isascii() and plain.isalnum():
            if plain == letter:
                continue
        elif letter.isascii():
            plain = " "
        else:
            continue
        source.append(letter)
        target.append(plain)
    return "".join(source + marks), "".join(target)


def match_key(c: Column | str) -> Column:
    """Lower-case, accent-free words of ``[a-z0-9-]`` separated by one space."""
    plain = F.translate(F.lower(F.coalesce(_col(c), F.lit(""))), *accent_table())
    # The table leaves little to replace: other scripts, and runs of more than one space.
    # Letters are listed because Java tests a listed class several times faster than ranges.
    kept = string.ascii_lowercase + string.digits
    return F.trim(F.regexp_replace(plain, f"[^{kept} -][^{kept}-]*| [^{kept}-]+", " "))


def split_activities(c: Column | str) -> Column:
    """Pieces between ``|``, ``;`` and ``,``, trimmed, in order, none empty."""
    # a piece runs from a letter that is neither separator nor space to the last such letter
    edge = f"[^{ACTIVITY_SEPARATORS} {WHITESPACE_BUT_SPACE}]"
    piece = f"({edge}(?:[^{ACTIVITY_SEPARATORS}]*{edge})?)"
    return F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(piece), F.lit(1))


def first_truthy(*columns: Column | str) -> Column:
    """The first value that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns], F.lit(""))


def clean_labels(labels: Column | str) -> Column:
    """Each label normalised; empty ones dropped; order kept."""
    return F.filter(F.transform(_col(labels), normalize_text), lambda label: label != "")


def join_labels(labels: Column | str, distinct: bool = False) -> Column:
    """Labels of an array joined by ``' | '``, optionally each only once."""
    kept = clean_labels(labels)
    return F.array_join(F.array_distinct(kept) if distinct else kept, LABEL_JOINER)


def leading_int(c: Column | str) -> Column:
    """The whole number a text starts with, or NULL."""
    digits = F.regexp_extract(_col(c), rf"^{WHITESPACE}*([+-]?[0-9]+)", 1)
    return digits.try_cast("bigint")


def first_text(values: Column | str) -> Column:
    """Normalised first element of an array, empty if there is none."""
    return normalize_text(F.get(_col(values), F.lit(0)))


def qs_quote(url: Column | str) -> Column:
    """A URL as a quoted QuickStatements string."""
    return F.concat(F.lit('"'), F.replace(_col(url), F.lit('"'), F.lit("%22")), F.lit('"'))


def qs_date(moment: Column | str) -> Column:
    """A date or timestamp as a day-precision QuickStatements date (session zone UTC)."""
    return F.date_format(_col(moment), QS_DATE_FORMAT)
