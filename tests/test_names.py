import pytest

from cubeshelf.functions import names as nm


@pytest.mark.parametrize("name,expected", [
    ("Column Name", "Column_Name"), ("Another/Column", "Another_Column"), ("With-Hyphen", "With_Hyphen"),
    ("Value / Amount - Total", "Value___Amount___Total"), ("already_clean", "already_clean"), ("", ""),
    ("REF_DATE", "REF_DATE"), ("a  b", "a__b"),
])
def test_sanitize_name(name, expected, spark):
    assert nm.sanitize_name(name) == expected
    got = spark.createDataFrame([(name,)], "n string").select(nm.sanitize_col("n")).first()[0]
    assert got == expected


def test_unique_names_case_and_collisions():
    names, renamed = nm.unique_names(["A_B", "A_B", "GEO", "Geo", "x"])
    assert names == ["A_B", "A_B_2", "GEO", "Geo_2", "x"]
    assert renamed == [("A_B", "A_B_2"), ("Geo", "Geo_2")]


@pytest.mark.parametrize("title,slug", [
    ("International Trade", "7-international-trade"), ("Trade (monthly) [x]", "7-trade-monthly-x"),
    ("Many   spaces  here", "7-many-spaces-here"), ("Inner-hyphen title", "7-inner-hyphen-title"),
    ("Prix à la consommation", "7-prix-à-la-consommation"), ("人口 统计", "7-人口-统计"), ("Area km² Ⅷ", "7-area-km²-ⅷ"),
    ("tab\tand\nnewline", "7-tabandnewline"), ("", "7-"), ("a -- b", "7-a----b"),
    ("café combiné é", "7-café-combiné-é"), (" leading and trailing ", "7-leading-and-trailing"),
])
def test_folder_slug_of_titles(title, slug, spark):
    got = spark.createDataFrame([(7, title)], "id long, t string").select(nm.folder_slug("id", "t")).first()[0]
    assert got == slug


def test_folder_slug_null_title(spark):
    assert spark.createDataFrame([(7, None)], "id long, t string").select(nm.folder_slug("id", "t")).first()[0] == "7-"


@pytest.mark.parametrize("folder,expected", [
    ("12100163-international-trade", 12100163), ("catalog", None), ("nodashhere", None),
    ("abc-dataset", None), ("12345", None), ("-5-x", None), ("007-x", 7),
])
def test_folder_product_id(folder, expected, spark):
    got = spark.createDataFrame([(folder,)], "f string").select(nm.folder_product_id("f")).first()[0]
    assert got == expected


@pytest.mark.parametrize("folder,expected", [
    ("12100163-trade", 12100163), ("12345", 12345), ("catalog", None), ("-5-x", None), ("abc-1", None),
])
def test_loose_folder_id(folder, expected, spark):
    assert spark.createDataFrame([(folder,)], "f string").select(nm.loose_folder_id("f")).first()[0] == expected


@pytest.mark.parametrize("name,expected", [
    ("12100163_international_trade", 12100163), ("catalog", None), ("nounderscore", None),
    ("abc_table_name", None), ("", None), ("5_", 5),
])
def test_table_product_id(name, expected, spark):
    assert spark.createDataFrame([(name,)], "n string").select(nm.table_product_id("n")).first()[0] == expected


@pytest.mark.parametrize("title,expected", [
    ("Short title", "[1] Short title"),
    ("x" * 50, "[1] " + "x" * 50),
    ("x" * 51, "[1] " + "x" * 50 + "..."),
    ("", "[1] "),
    ("é" * 51, "[1] " + "é" * 50 + "..."),
])
def test_display_title(title, expected, spark):
    got = spark.createDataFrame([(1, title)], "id long, t string").select(nm.display_title("id", "t")).first()[0]
    assert got == expected


@pytest.mark.parametrize("msg,expected", [
    ("short", "short"), ("m" * 50, "m" * 50), ("m" * 51, "ValueError"), ("", ""),
])
def test_error_label(msg, expected, spark):
    df = spark.createDataFrame([("ValueError", msg)], "c string, m string")
    assert df.select(nm.error_label("c", "m")).first()[0] == expected


def test_target_path(spark):
    df = spark.createDataFrame([("1-a",)], "f string")
    assert df.select(nm.target_path("s3://b/p/", "f")).first()[0] == "s3://b/p/1-a/"
    assert df.select(nm.target_path("s3://b/p", "f")).first()[0] == "s3://b/p1-a/"
