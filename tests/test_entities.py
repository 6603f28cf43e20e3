from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions import entities as E
from prosemill.operators import extract

T1 = ("Jane Doe: a nurse from Boston, CA 02134 lives at 12 Main St, Orange County, "
      "jane.doe@x.org, (415) 555-1234 or 415.555.9876.")
T2 = "John Roe of Acme, NY and CA, 9 Elm Blvd, mail john@roe.com!! or jr@roe.net. +1 (743) 555-3824"


def test_entity_rows(spark):
    df = spark.createDataFrame([(1, T1), (2, T2), (3, "Solo"), (4, None)], "id int, text string")
    rows = {r.id: r for r in extract.extract_entities(df, "id", "text").collect()}
    assert rows[1].asDict() == {
        "id": 1, "First_Name": "Jane", "Last_Name": "Doe", "Address": "02134 lives at 12 Main St",
        "Email": "jane.doe@x.org", "Phone_1": "415) 555-1234", "Phone_2": "415.555.9876",
        "City": "Boston", "County": "Orange", "State": "CA-California", "Company name": None,
    }
    assert rows[2].asDict() == {
        "id": 2, "First_Name": "John", "Last_Name": "Roe", "Address": "9 Elm Blvd",
        "Email": "jr@roe.net", "Phone_1": "1 (743) 555-3824", "Phone_2": None, "City": None,
        "County": None, "State": "CA-California", "Company name": "Acme",
    }
    for i in (3, 4):
        assert [rows[i][c] for c in dims.ENTITY_COLUMNS] == [None] * 10


def test_gazetteer_is_a_parameter(spark):
    cities = spark.createDataFrame([("Acme",)], "name string")
    df = spark.createDataFrame([(2, T2)], "id int, text string")
    assert extract.extract_company(df, "text", cities).first()["Company name"] is None
    assert extract.extract_city(df, "text", cities).first()["City"] is None


def test_conditions(spark):
    text = ("Influenza, pneumonia. PNEUMONIA; dengue fever, HIV/AIDS, "
            "chronic lower respiratory disease; strokes; kidney diseases")
    df = spark.createDataFrame([(1, text), (1, "cancer CANCER"), (2, None)], "volume int, text string")
    got = {(r.volume, r.condition): r.n for r in extract.condition_counts(df, "volume", "text").collect()}
    want = {"Influenza and Pneumonia": 3, "Dengue fever": 1, "HIV/AIDS": 1, "Respiratory diseases": 1,
            "Chronic lower respiratory disease": 1, "Stroke": 1, "Kidney diseases": 1, "Cancer": 2}
    assert {c: got[1, c] for c in dims.CONDITIONS} == {c: want.get(c, 0) for c in dims.CONDITIONS}
    assert all(got[2, c] == 0 for c in dims.CONDITIONS)
    wide = extract.condition_pivot(df, "volume", "text").where("volume = 1").first()
    assert wide["Alzheimer's disease"] == 0 and wide["Cancer"] == 2


def test_parse_condition():
    assert E.condition_literals("Accidents/injuries") == ["Accidents", "injuries"]
    assert E.condition_literals("HIV/AIDS") == ["HIV/AIDS"]
    assert E.condition_literals("Influenza and Pneumonia") == ["Influenza", "Pneumonia"]
    assert E.condition_literals("Dengue fever") == ["Dengue"]
    assert E.condition_literals("Kidney diseases") == ["Kidney disease"]


def test_literals(one):
    assert one(E.count_literal(F.lit("aAa aaaa"), "aa")) == 3
    assert one(E.extract_state(F.lit("from NY or ME"))) == "ME-Maine"
    assert one(E.extract_county(F.lit("in Orange  COUNTY."))) == "Orange"
    assert one(E.extract_email(F.lit("a@b.co c@d.org"))) == "c@d.org"
