"""Standard forms of text values."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def normal_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def decoded(uri: Column) -> Column:
    """A path from Spark's ``_metadata``, where a space is written ``%20``, as it is on storage.

    Most paths hold no ``%``, and a row's path is decoded for every row: those are taken as they are.
    """
    return F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Letters beyond ASCII and what is left of them by Unicode's compatibility decomposition: those that become
    one ASCII letter or digit (two strings side by side), and those that become several."""
    one, several = {}, {}
    for point in range(0x80, 0x20000):
        char = chr(point)
        left = re.sub("[^a-z0-9]", "", unicodedata.normalize("NFKD", char).lower()) if not 0xD800 <= point < 0xE000 else ""
        if len(left) == 1:
            one[char] = left
        elif left:
            several[char] = left
    return "".join(one), "".join(one.values()), several


def _class_of(chars: Iterable[str]) -> str:
    """A regex class of the characters as ranges: Java tries a class entry by entry."""
    points, ranges = sorted(map(ord, chars)), []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def slug(value: Column) -> Column:
    """Lower case, accents folded, ASCII letters and digits only; letters that don't decompose are dropped."""
    accented, plain, several = _folding()
    # What has no counterpart in ``plain`` is dropped: ASCII marks and blanks go here, not match by match below.
    marks = "".join(chr(p) for p in range(0x80) if not chr(p).isalnum())
    folded = F.translate(F.lower(value), accented + marks, plain)
    # Ligatures and the like are rare. A map and a class are searched entry by entry: the map once for each distinct
    # ligature of a value, the class at characters beyond ASCII alone.
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    beyond = "[^\\x00-\\x7F]"
    rare = f"(?={beyond}){_class_of(several)}"

    def plain_letters(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({rare})"), F.lit(1)))
        apart = F.aggregate(found, text, lambda left, c: F.replace(left, c, F.try_element_at(table, c)))
        held = F.when(text.rlike(rare), apart).otherwise(text)
        return F.when(text.rlike(beyond), F.regexp_replace(held, f"{beyond}+", "")).otherwise(text)

    # An array of one, so that the folded text is made once and not for each mention of it.
    return F.transform(F.array(folded), plain_letters)[0]
