"""Escaped one-line form of a message, as Column expressions.

A stored line holds printable ASCII only, so a newline always ends a record.
Both directions work byte by byte and never fail: a line whose escapes are
malformed is handed back unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes that have a letter of their own (byte, escape).
# The backslash comes last so that it cannot touch an escape made before.
NAMED_ESCAPES = [
    ("\x07", r"\a"),
    ("\x08", r"\b"),
    ("\t", r"\t"),
    ("\n", r"\n"),
    ("\x0b", r"\v"),
    ("\x0c", r"\f"),
    ("\r", r"\r"),
    ("\\", r"\\"),
]

# Stands for a pair of backslashes while the other escapes are replaced.
MARK = "\x01"

# What may stand in a line as itself, and a backslash out of place.
PLAIN = r"[ -\[\]-~]"
# After whole pairs, a last backslash that begins nothing.
MALFORMED = r"(?:^|[^\\])(?:\\\\)*+\\(?![abtnvfr]|x[0-9A-Fa-f]{2})"

# Tokens are found one after the other. Bounded, possessive repetition keeps
# the regex engine off the Java stack however long the line is.
_HEX_RUN = r"(?:\\x[0-9A-Fa-f]{2}){1,4096}+"
_TOKEN = rf"[^\\]++|{_HEX_RUN}|\\[abtnvfr\\]"
_RUN = r"[ -\[\]-~]++|[^ -\[\]-~]++"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bytes_as_chars(col: Column) -> Column:
    """One character per byte, so regexes can address bytes that are no UTF-8."""
    return F.decode(col.cast("binary"), "ISO-8859-1")


def chars_as_bytes(col: Column) -> Column:
    return F.encode(col, "ISO-8859-1")


def _spell(run: Column) -> Column:
    """Escapes for a run of bytes none of which may stand as itself."""
    spelled = F.regexp_replace(F.hex(chars_as_bytes(run)), "(..)", r"\\x$1")
    for byte, escape in NAMED_ESCAPES:
        spelled = F.replace(spelled, F.lit(f"\\x{ord(byte):02X}"), F.lit(escape))
    return F.when(run == "\n", F.lit(r"\n")).otherwise(spelled)


def escape(col: Column | str) -> Column:
    """Printable form of a string or binary column."""
    col = _column(col)
    text = col.cast("string")
    # Enough where no byte needs a hex escape. The backslash first: it is in all others.
    named = F.replace(text, F.lit("\\"), F.lit(r"\\"))
    for byte, escape_ in NAMED_ESCAPES[:-1]:
        named = F.replace(named, F.lit(byte), F.lit(escape_))
    runs = F.regexp_extract_all(bytes_as_chars(col), F.lit(_RUN), F.lit(0))
    spelled = F.array_join(
        F.transform(runs, lambda r: F.when(r.rlike("^" + PLAIN), r).otherwise(_spell(r))), ""
    )
    return (
        F.when(text.rlike(rf"^{PLAIN}*+\z"), text)
        .when(named.rlike(r"^[ -~]*+\z"), named)
        .otherwise(spelled)
    )


def _meaning(token: Column, literal: Column) -> Column:
    value = F.when(~token.startswith("\\"), literal).when(
        token.startswith(r"\x"), F.unhex(F.replace(token, F.lit(r"\x"))).cast("string")
    )
    for byte, escape_ in NAMED_ESCAPES:
        value = value.when(token == escape_, F.lit(byte))
    return value


def escape_valid(col: Column | str) -> Column:
    """False where a backslash does not start a valid escape."""
    col = _column(col)
    return ~F.contains(col, F.lit("\\")) | ~F.rlike(col, F.lit(MALFORMED))


def unescape(col: Column | str) -> Column:
    """Original message of an escaped line; the line itself if it is malformed.

    The result may hold any bytes; cast it to binary to see them as stored.
    """
    col = _column(col)

    def decoded(text: Column, literal: Callable[[Column], Column]) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
        return F.array_join(F.transform(tokens, lambda t: _meaning(t, literal(t))), "")

    slash = F.lit("\\")
    # Of printable ASCII, as escape makes it, a pair of backslashes can be marked by a byte
    # that the line cannot hold; the letters are then replaced one after the other.
    printable = (F.length(col) == F.octet_length(col)) & ~F.contains(col, F.lit(MARK))
    named = F.replace(col, F.lit(r"\\"), F.lit(MARK))
    for byte, escape_ in NAMED_ESCAPES[:-1]:
        named = F.replace(named, F.lit(escape_), F.lit(byte))
    # Hex escapes are those of a URL, which has a decoder. It gives null for a malformed
    # one, and U+FFFD for bytes that are no UTF-8: both are left to the tokens.
    url = F.replace(F.replace(named, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    url = F.replace(F.replace(url, F.lit(MARK), F.lit("%5C")), F.lit(r"\x"), F.lit("%"))
    from_url = F.try_url_decode(url)
    clean = ~F.contains(url, slash) & ~F.contains(from_url, F.lit("\ufffd"))

    return (
        F.when(~F.contains(col, slash), col)
        .when(~escape_valid(col), col)
        .when(printable & ~F.contains(named, slash), F.replace(named, F.lit(MARK), slash))
        .when(printable & F.coalesce(clean, F.lit(False)), from_url)
        .when(F.is_valid_utf8(col), decoded(col, lambda t: t))
        # Any other line is read with one character per byte.
        .otherwise(decoded(bytes_as_chars(col), lambda t: chars_as_bytes(t).cast("string")))
    )
