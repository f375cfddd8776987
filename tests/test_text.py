import pytest
from pyspark.sql import functions as F

from crossfeed.errors import ExternalError
from crossfeed.functions import text


def test_number_of_known_names():
    assert len(text.ALIASES) == 41


@pytest.mark.parametrize("given, found", [
    ("utf-8", "utf-8"), ("Cp_1252", "cp1252"), ("windows_1251", "cp1251"), ("ISO_8859_15", "iso8859-15"),
    ("shift_jis", "cp932"), ("gb2312", "gbk"), ("euc-kr", "cp949"), ("1250", "cp1250"), ("28605", "iso8859-15"),
    ("65001", "utf-8"), ("936", "gbk"), ("932", "cp932")])
def test_names(given, found):
    assert text.charset(given) == found


@pytest.mark.parametrize("name", ["", "KLINGON", "1234", "CP9999"])
def test_unknown_names(name):
    with pytest.raises(ExternalError, match="Unknown encoding"):
        text.charset(name)


@pytest.fixture(scope="module")
def cells(spark):
    """Every single byte, every pair with a high first byte, empty and missing cells."""
    values = [bytes([n]) for n in range(256)] + [bytes([n, m]) for n in range(128, 256, 3) for m in range(32, 256, 5)]
    values += [b"", None, "Grüße, 世界".encode(), b"plain"]
    return spark.createDataFrame([(n, value) for n, value in enumerate(values)], "id int, raw binary").cache()


def decoded(raw, name):
    if raw is None:
        return None
    try:
        return bytes(raw).decode(name)
    except UnicodeDecodeError:
        return bytes(raw).decode("latin-1")


@pytest.mark.parametrize("name", sorted(set(text.ALIASES.values())))
def test_every_charset_against_its_codec(cells, name):
    alias = next(key for key, value in text.ALIASES.items() if value == name)
    for row in cells.select("raw", text.decode_text(F.col("raw"), alias).alias("text")).collect():
        assert row["text"] == decoded(row["raw"], name), row["raw"]


def test_each_row_by_its_own_name(cells):
    names = sorted(text.ALIASES)
    frame = cells.withColumn("name", F.get(F.array(*[F.lit(one) for one in names]), F.col("id") % len(names)))
    done = frame.select("raw", "name", text.decode_each(F.col("raw"), F.col("name"), names).alias("text"))
    for row in done.collect():
        assert row["text"] == decoded(row["raw"], text.charset(row["name"])), (row["raw"], row["name"])


@pytest.mark.parametrize("name", ["CP1251", "SHIFT_JIS", "UTF-8"])
def test_text_that_was_misread_as_latin(cells, name):
    frame = cells.select("raw", F.decode("raw", "ISO-8859-1").alias("misread"))
    done = frame.select("raw", "misread", text.redecode_text(F.col("misread"), name).alias("text")).collect()
    for row in done:
        wanted = row["misread"] if name == "UTF-8" else decoded(row["raw"], text.charset(name))
        assert row["text"] == wanted
    kept = cells.limit(1).select(text.redecode_text(F.lit("日本"), name)).first()[0]
    assert kept == "日本"


def test_wide_text(spark):
    frame = spark.createDataFrame([("Grüße 👋",), (None,)], "word string")
    raw = frame.select("word", text.encode_utf16(F.col("word")).alias("raw"))
    assert raw.first()["raw"] == "Grüße 👋".encode("utf-16-le")
    assert [tuple(row) for row in raw.select("word", text.decode_utf16(F.col("raw"))).collect()] == [
        ("Grüße 👋", "Grüße 👋"), (None, None)]


def test_latin_and_utf_8_stay_in_the_jvm(cells):
    for name, python in (("ISO-8859-1", False), ("UTF-8", False), ("CP1252", True)):
        plan = cells.select(text.decode_text(F.col("raw"), name))._jdf.queryExecution().executedPlan().toString()
        assert ("ArrowEvalPython" in plan) is python


def test_a_name_that_was_not_announced_gives_null(cells):
    frame = cells.limit(3).select(text.decode_each(F.col("raw"), F.lit("CP1250"), ["UTF-8"]).alias("text"))
    assert [row["text"] for row in frame.collect()] == [None, None, None]
