import pytest
from celltables import tuples
from pyspark.sql import functions as F

from refmill.functions import dates as D
from refmill.functions import text as X
from refmill.operators import inventory as I
from refmill.sources.config import Settings, config_hash


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", "12"), ("1,234", "1234"), ("1,2,3", "123"), ("12.0", "12.0"), ("-3.5", "-3.5"), ("+4", "+4"),
        ("1e3", "1e3"), (".5", ".5"), ("1.", None), ("007", None), ("0", "0"), ("00.5", "00.5"), ("-007", "-007"),
        ("$5", None), ("12%", None), ("[x]", None), ("NaN", None), ("1d", None), ("1 000", None), ("", None),
        (" 8 ", "8"), ("\u00a08\u3000", "8"), ("0,123", "0123"), ("12345678901234567890", "12345678901234567890"),
    ],
)
def test_number_text(spark, text, number):
    assert one(spark, text, X.number_text(F.col("v"))) == number


@pytest.mark.parametrize("text, value", [("1.234,5", 1234.5), ("1,5", 1.5), ("1.000", 1000.0)])
def test_number_locale(spark, text, value):
    assert one(spark, text, X.number_double(X.number_text(F.col("v"), ".", ","))) == value


@pytest.mark.parametrize(
    "text, value", [("-007", -7), ("+4", 4), ("1e3", 1000), ("2.0", 2), ("2.5", None), ("12345678901234567890", None), ("1e30", None)]
)
def test_number_bigint(spark, text, value):
    assert one(spark, text, X.number_bigint(X.number_text(F.col("v")))) == value


@pytest.mark.parametrize(
    "text, value, header",
    [
        (" abc ", "abc", "abc"), ("[x]", None, "[x]"), ("[c]", None, "[c]"), ("..", None, ".."), ("-", "-", "-"),
        ("", None, None), ("   ", None, None), ("Gas\n use [Note 12]", "Gas\n use [Note 12]", "Gas use"),
        ("[note 3]", "[note 3]", None), ("a\u00a0\t b", "a\u00a0\t b", "a b"), ("\u2003wide\u2003", "wide", "wide"),
    ],
)
def test_clean(spark, text, value, header):
    assert one(spark, text, X.clean_value(F.col("v"))) == value
    assert one(spark, text, X.clean_header(F.col("v"))) == header


def test_values_that_are_not_text_pass(spark):
    df = spark.createDataFrame([("..", "number"), ("..", "string")], "v string, k string")
    assert [r["x"] for r in df.select(X.clean_value(F.col("v"), F.col("k")).alias("x")).collect()] == ["..", None]


@pytest.mark.parametrize("letters, index", [("A", 1), ("Z", 26), ("AA", 27), ("AZ", 52), ("BA", 53), ("ZZ", 702), ("AAA", 703), ("XFD", 16384)])
def test_column_letters(spark, letters, index):
    df = spark.createDataFrame([(letters, index)], "l string, i int")
    row = df.select(X.column_index(F.col("l")).alias("i"), X.column_letters(F.col("i")).alias("l")).first()
    assert (row["i"], row["l"]) == (index, letters)
    assert X.letters_to_index(letters) == index
    assert X.letters_to_index(7) == 7 and X.letters_to_index("7") == 7


FILES = [
    ("/d/a", "NG_Output_20240611", "2024-06-11", "FN_YYYYMMDD"),
    ("/d/a", "NG_x_01012024.psv", "2024-01-01", "FN_DDMMYYYY"),
    ("/d/20240102", "NG_x.psv", "2024-01-02", "FolderName"),
    ("D:\\drop\\20240103", "NG_x.psv", "2024-01-03", "FolderName"),
    ("/d/a", "NG_x.psv", None, "None"),
    ("/d/a", "NG_20241399", None, "None"),
    ("/d/20240102/b", "NG_x.psv", None, "None"),
    ("/d/a", "NG_20112012.psv", "2012-11-20", "FN_DDMMYYYY"),
    ("/d/a", "NG_20101112.psv", "2010-11-12", "FN_YYYYMMDD"),
    ("/d/a", "NG_123456789.psv", None, "None"),
    ("/d/a", "NG-19850101.psv", None, "None"),
]


def test_dates_in_names(spark):
    df = spark.createDataFrame([f[:2] for f in FILES], "folder string, name string")
    found = I.dated_files(df).select("folder", "name", F.col("file_day").cast("string"), "method")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(FILES, key=repr)


def test_name_filter_and_keyword(spark):
    df = spark.createDataFrame(
        [("/X/DROP-1", "NG_a"), ("/X/DROP-1", "XNG_a"), ("/X/other", "NG-b"), ("/X/drop", "ng_c")], "folder string, name string"
    )
    assert tuples(I.matching_files(df, "drop")) == [("/X/DROP-1", "NG_a")]


def test_freshness_label(spark):
    df = spark.createDataFrame([(424, 400), (400, 400), (None, 400), (9, None)], "days long, sla int")
    labels = [r["x"] for r in df.select(D.freshness(F.col("days"), F.col("sla")).alias("x")).collect()]
    assert labels == [D.STALE, D.FRESH, D.FRESH, D.FRESH]


def test_day_difference_counts_midnights(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 23:59:00' AS a, timestamp'2024-01-02 00:01:00' AS b")
    assert df.select(D.days_since(F.col("a"), F.col("b")).alias("x")).first()["x"] == 1


def test_config_hash_ignores_key_order():
    assert config_hash({"a": 1, "b": [1, 2]}) == config_hash({"b": [1, 2], "a": 1})
    assert len(config_hash({})) == 16


def test_settings_defaults_and_old_keys():
    assert Settings.of({}).null_markers == X.NULL_MARKERS
    assert Settings.of({"null_markers": ["-"]}).null_markers == ("-",)
    assert Settings.of({"null_markers": ["-"], "settings": {"null_markers": ["?"]}}).null_markers == ("?",)
    with pytest.raises(ValueError):
        Settings.of({"settings": {"type_inference": "maybe"}})
    with pytest.raises(ValueError):
        Settings.of({"settings": {"on_error": "stop"}})
