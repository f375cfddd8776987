"""Character encodings: bytes or mis-declared text to proper text.

UTF-8, Latin-1 and, for the charsets that agree on ASCII, every cell that is plain ASCII are handled inside the JVM.
Other cells go to a pandas UDF in Arrow batches. Bytes that are not valid in the charset keep their original text, that is, each byte as the Latin-1
character of the same number.
"""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from crossfeed.errors import ExternalError
from crossfeed.functions.batches import in_bounded_batches

# Accepted encoding names, after normalisation, and the charset each one stands for.
UTF_8 = ("UTF-8", "UTF8", "CP65001")
WINDOWS_PAGES = (1250, 1251, 1252, 1253, 1254, 1255, 1256, 1257, 1258)
ISO_PARTS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 15)
EAST_ASIAN = {
    "SHIFT_JIS": "cp932", "SHIFT-JIS": "cp932", "CP932": "cp932",
    "GB2312": "gbk", "GBK": "gbk", "CP936": "gbk",
    "BIG5": "cp950", "CP950": "cp950",
    "EUC-KR": "cp949", "CP949": "cp949",
}
# Code page numbers that differ from the digits in the charset's name.
PAGE_NUMBERS = {65001: "utf-8", 936: "gbk", **{28590 + part: f"iso8859-{part}" for part in ISO_PARTS}}

ALIASES = {
    **{name: "utf-8" for name in UTF_8},
    **{f"{prefix}{page}": f"cp{page}" for page in WINDOWS_PAGES for prefix in ("CP", "WINDOWS-")},
    **{f"ISO-8859-{part}": f"iso8859-{part}" for part in ISO_PARTS},
    **EAST_ASIAN,
}
LATIN = "ISO-8859-1"


def charset(encoding: str) -> str:
    """The charset an encoding name or code page number stands for; an unknown one is an error."""
    name = encoding.strip().upper()
    if name.startswith("CP_"):
        name = "CP" + name[3:]
    name = name.replace("_", "-")
    found = ALIASES.get(name)
    if found is None and name.isdigit():
        found = PAGE_NUMBERS.get(int(name), ALIASES.get(f"CP{name}"))
    return found or _codec(name) or _unknown(encoding)


def _codec(name: str) -> str | None:
    """Any other name or code page number that Python has a text codec for."""
    for spelled in (f"cp{name}" if name.isdigit() else name, name.removeprefix("WINDOWS-")):
        try:
            known = codecs.lookup(spelled)
        except (LookupError, ValueError):
            continue
        if known._is_text_encoding and known.name not in ("idna", "punycode", "unicode_escape", "raw_unicode_escape", "undefined"):
            return known.name
    return None


def _unknown(encoding: str) -> str:
    raise ExternalError(f"Unknown encoding '{encoding}'")


def _keeps_ascii(name: str) -> bool:
    """Whether plain ASCII bytes are the same text in a charset, as they are in all but a few."""
    plain = bytes(range(128))
    return plain.decode(name, "replace") == plain.decode("ascii")


def decode_text(column: Column, encoding: str) -> Column:
    """A binary column in ``encoding`` as text."""
    name = charset(encoding)
    latin = F.decode(column, LATIN)
    if name == "utf-8":
        text = column.cast("string")
        return F.when(F.is_valid_utf8(text), text).otherwise(latin)
    if name == "iso8859-1":
        return latin

    in_bounded_batches(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda cell: decoded(cell, name))

    if not _keeps_ascii(name):
        return decode(column)
    return F.coalesce(decode(F.when(_beyond_ascii(column, latin), column)), latin)


def redecode_text(column: Column, encoding: str) -> Column:
    """Text the driver took for Latin-1 although it is in ``encoding``; anything beyond Latin-1 is left alone."""
    name = charset(encoding)
    if name in ("utf-8", "iso8859-1"):
        return column

    in_bounded_batches(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: redecoded(text, name))

    if not _keeps_ascii(name):
        return decode(column)
    return F.coalesce(decode(F.when(F.octet_length(column) != F.length(column), column)), column)


def decode_each(column: Column, encoding: Column, names: list[str]) -> Column:
    """A binary column whose rows each name their own encoding, out of ``names``."""
    charsets = {name.upper(): charset(name) for name in names}
    latin = F.decode(column, LATIN)

    in_bounded_batches(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def decode(raw: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([decoded(cell, charsets[kind]) if cell is not None else None
                          for cell, kind in zip(raw, kinds)], index=raw.index, dtype=object)

    kind = F.upper(F.trim(encoding))
    known = F.when(kind.isin(*charsets), column)
    return F.when(kind.isin(*charsets), F.coalesce(decode(F.when(_beyond_ascii(column, latin), known), kind), latin))


def decode_utf16(column: Column) -> Column:
    """Little-endian wide text as text."""
    return F.decode(column, "UTF-16LE")


def encode_utf16(column: Column) -> Column:
    return F.encode(column, "UTF-16LE")


def encode_text(column: Column, encoding: str) -> Column:
    """Text as bytes in ``encoding``; a letter the charset lacks becomes a question mark."""
    name = charset(encoding)
    if name == "utf-8":
        return F.encode(column, "UTF-8")

    in_bounded_batches(SparkSession.getActiveSession())

    @F.pandas_udf("binary")
    def to_bytes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: None if text is None else text.encode(name, errors="replace"))

    if not _keeps_ascii(name):
        return to_bytes(column)
    plain = F.octet_length(column) == F.length(column)
    return F.coalesce(to_bytes(F.when(~plain, column)), F.when(plain, F.encode(column, "UTF-8")))


def encode_each(column: Column, encoding: Column, names: list[str]) -> Column:
    """Text whose rows each name the encoding, out of ``names``, to be written in; NULL for other names."""
    charsets = {name.upper(): charset(name) for name in names}

    in_bounded_batches(SparkSession.getActiveSession())

    @F.pandas_udf("binary")
    def to_bytes(texts: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([text.encode(charsets[kind], errors="replace") if text is not None else None
                          for text, kind in zip(texts, kinds)], index=texts.index, dtype=object)

    kind = F.upper(F.trim(encoding))
    plain = F.octet_length(column) == F.length(column)
    alike = kind.isin(*[name for name, known in charsets.items() if _keeps_ascii(known)])
    return (F.when(plain & alike, F.encode(column, "UTF-8"))
            .when(kind.isin(*charsets), to_bytes(F.when(~(plain & alike) & kind.isin(*charsets), column), kind)))


def _beyond_ascii(column: Column, latin: Column) -> Column:
    """Whether a cell has a byte above 127: as Latin-1 text in UTF-8, each of those takes two bytes."""
    return F.octet_length(latin) != F.octet_length(column)


def decoded(raw: bytes | None, name: str) -> str | None:
    if raw is None:
        return None
    try:
        return bytes(raw).decode(name)
    except UnicodeDecodeError:
        return bytes(raw).decode("latin-1")


def redecoded(text: str | None, name: str) -> str | None:
    if text is None:
        return None
    try:
        return decoded(text.encode("latin-1"), name)
    except UnicodeEncodeError:
        return text
