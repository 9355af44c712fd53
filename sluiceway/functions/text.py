"""Text columns of a greeting message, ``Hello <name>!``.

A payload may be long, so nothing here splits or repairs more of it than the second word.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a greeting around the name.
GREETING_START = "Hello "
GREETING_END = "!"

NO_SECOND_WORD = "malformed greeting: the payload has no second word"

# Fixed value: a UTF-8 encoded surrogate, perhaps cut short, with bytes as Latin-1 letters.
ENCODED_SURROGATE = "\u00ed[\u00a0-\u00bf][\u0080-\u00bf]?"


def payload_text(payload: Column) -> Column:
    """The payload as UTF-8 text; every malformed byte sequence becomes U+FFFD."""
    return repaired(payload.cast("string"))


def repaired(text: Column) -> Column:
    """``text`` with each malformed byte sequence as one U+FFFD, where the JVM puts one.

    The JVM takes a surrogate encoded in UTF-8 for one malformed sequence,
    ``make_valid_utf8`` for two or three, so those are made a single bad byte first.
    """
    latin = F.decode(text.cast("binary"), "ISO-8859-1")
    single = F.regexp_replace(latin, ENCODED_SURROGATE, "\u00ff")
    malformed = F.encode(single, "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.make_valid_utf8(malformed))


def second_word(text: Column) -> Column:
    """What stands between the first and the second space; NULL if there is no space."""
    first_two = F.substring_index(text, " ", 2)
    return F.when(F.contains(text, F.lit(" ")), F.substring_index(first_two, " ", -1))


def name_of_word(word: Column, on_malformed: str = "fail") -> Column:
    """The name in a greeting: its second word without the last character.

    A payload without a second word is malformed. ``on_malformed="fail"`` raises on it,
    ``"quarantine"`` gives NULL so that the caller can set such rows apart.
    """
    name = F.when(F.octet_length(word) > 0, F.left(word, F.length(word) - 1))
    if on_malformed == "fail":
        return name.otherwise(F.raise_error(F.lit(NO_SECOND_WORD)))
    if on_malformed == "quarantine":
        return name
    raise ValueError(f"on_malformed must be 'fail' or 'quarantine', not {on_malformed!r}")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 code units: a character outside the BMP counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def utf16_shorter_than(text: Column, units: int) -> Column:
    """Whether ``text`` has fewer than ``units`` UTF-16 code units.

    A code unit takes one to three bytes of UTF-8, so the byte length alone decides most
    rows and only the rest are transcoded.
    """
    size = F.octet_length(text)
    return (size < units) | ((size <= 3 * (units - 1)) & (utf16_length(text) < units))


def first_match(text: Column, prefixes: tuple[str, ...]) -> Column:
    """The first of ``prefixes`` that ``text`` starts with (case-sensitive), else NULL."""
    route = F.when(F.startswith(text, F.lit(prefixes[0])), prefixes[0])
    for prefix in prefixes[1:]:
        route = route.when(F.startswith(text, F.lit(prefix)), prefix)
    return route


def greeting(name: Column) -> Column:
    """The payload that greets ``name``."""
    return F.concat(F.lit(GREETING_START), name, F.lit(GREETING_END)).cast("binary")
