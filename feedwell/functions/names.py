"""Accent-, case- and space-insensitive text keys.

Spark has no function for NFKD. Of a decomposition only the ASCII characters count here, and these are
the same whatever stands around a character, so a table made from ``unicodedata`` when a plan is built
does: characters that stand for one of ASCII are translated, the few that stand for several are looked
up, the rest is dropped. All of it is built-in expressions, so text stays in the JVM, and filters on
other columns are pushed below them.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space (fixed values).
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def plain(text: str) -> str:
    """NFKD without what is not ASCII."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if c.isascii())


@cache
def _decomposed() -> tuple[dict[str, str], dict[str, str]]:
    """Characters outside ASCII that stand for one ASCII character, and those that stand for several."""
    found = {c: plain(c) for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.decomposition(c)}
    return {c: t for c, t in found.items() if len(t) == 1}, {c: t for c, t in found.items() if len(t) > 1}


@cache
def _one_of(characters: str) -> str:
    """A pattern for one of the characters; ASCII is told apart first, as it is most of any text."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return r"[[^\x00-\x7F]&&[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]]"


#: Characters of private use, which no decomposition has: one that marks several, one that cuts around them.
_SEVERAL, _CUT = "\ue001", "\ue000"


def _ascii(col: Column | str) -> Column:
    one, several = _decomposed()
    text = F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))
    foreign = r"[^\x00-\x7F]"
    single = F.translate(text, "".join([*one, *several]), "".join(one.values()) + _SEVERAL * len(several))

    def bare(folded: Column) -> Column:
        rest = F.when(folded.contains(_SEVERAL), _looked_up(text)).otherwise(folded)
        return F.regexp_replace(rest, f"{foreign}+", "")

    return F.when(text.rlike(foreign), F.get(F.transform(F.array(single), bare), F.lit(0))).otherwise(text)


def _looked_up(text: Column) -> Column:
    """Text with what its characters stand for, cut around those that stand for several: only these are looked up."""
    one, several = _decomposed()
    table = F.str_to_map(F.lit("\x01".join(f"{c}\x02{t}" for c, t in several.items())), F.lit("\x01"), F.lit("\x02"))
    pieces = F.split(F.regexp_replace(text, f"({_one_of(''.join(several))})", f"{_CUT}$1{_CUT}"), _CUT)
    known = F.transform(pieces, lambda p: F.when(F.length(p) == 1, F.coalesce(F.try_element_at(table, p), p)).otherwise(p))
    return F.translate(F.array_join(known, ""), "".join(one), "".join(one.values()))


def ascii_key(text: Column) -> Column:
    """The key of text that is ASCII already: lower case, no white space."""
    return F.regexp_replace(ascii_marker(text), r"[\t-\r\x1c-\x1f]+", "")


def ascii_marker(text: Column) -> Column:
    """As ``ascii_key``, but without the space character only."""
    return F.replace(F.lower(text), F.lit(" "), F.lit(""))


def key_text(col: Column | str) -> Column:
    """NFKD, ASCII only, lower case, no white space. NULL gives the empty string."""
    return ascii_key(_ascii(col))


def marker_text(col: Column | str) -> Column:
    """As ``key_text``, but removes the space character only."""
    return ascii_marker(_ascii(col))


def key_of(text: str | None) -> str:
    """``key_text`` of one parameter, on the driver."""
    return reduce(lambda t, space: t.replace(space, ""), _SPACES, plain(text or "").lower())


def marker_of(text: str | None) -> str:
    """``marker_text`` of one parameter, on the driver."""
    return plain(text or "").lower().replace(" ", "")


def prefix_key(text: str | None) -> str:
    """Key of a prefix. A prefix whose key is empty would match everything."""
    key = key_of(text)
    if not key:
        raise ValueError(f"prefix {text!r} is empty after normalisation and would match every name")
    return key


def marker_key(text: str | None) -> str:
    """Key of a marker. A marker whose key is empty would match everything."""
    key = marker_of(text)
    if not key:
        raise ValueError(f"marker {text!r} is empty after normalisation and would match every name")
    return key
