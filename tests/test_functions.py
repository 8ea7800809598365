from pyspark.sql import functions as F

from gridmill.functions import codes, numbers, places, text
from gridmill.operators import geo


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


def test_phones(spark):
    cases = {
        "254712345678": "0712345678", "+254712345678": "0712345678", "2540712345678": "0712345678", "712345678": "0712345678", "112345678": "0112345678", "0712 345-678": "0712345678",
        "2.54712345678E11": "0712345678", "n/a": "", "": None, None: None, "abcE": None, "256700000001": "0700000001",
    }
    rows = spark.createDataFrame(list(cases.items()), "raw string, want string").select("raw", "want", text.standard_phone(F.col("raw")).alias("got")).collect()
    assert [(r.raw, r.got) for r in rows] == [(r.raw, r.want) for r in rows]


def test_names(spark):
    for full, want in {"Ann": ("Ann", "N/A"), " Jo  Van Dam ": ("Jo", "Van Dam"), "": ("N/A", "N/A"), None: ("N/A", "N/A")}.items():
        row = spark.createDataFrame([(full,)], "n string").select(text.first_name(F.col("n")).alias("a"), text.last_name(F.col("n")).alias("b")).first()
        assert (row.a, row.b) == want


def test_times(spark):
    for raw, want in {"2024-01-31T10:11:12.500Z": "2024-01-31 10:11:12.5", "2024-01-31 10:11:12": "2024-01-31 10:11:12", "1706695872": "2024-01-31 10:11:12", "soon": None, None: None}.items():
        assert one(spark, numbers.any_time(F.col("t")).cast("string"), t=raw) == want
    assert one(spark, numbers.day_first(F.col("t")).cast("string"), t="31/02/2024") is None


def test_numbers(spark):
    assert one(spark, numbers.half_even(F.col("v")), v=2.5) == 2.0
    assert one(spark, numbers.percent_change(F.col("a"), F.col("b")), a=0, b=3) == 100.0
    assert one(spark, numbers.percent_change(F.col("a"), F.col("b")), a=0, b=0) == 0.0
    assert one(spark, numbers.number_or_zero(F.col("v")), v="x") == 0.0


def test_codes(spark):
    assert one(spark, codes.mapped(F.col("v"), *codes.STATUS), v="Odd") == "NEW"
    assert one(spark, codes.relationship(F.col("v")), v="Cousin") == "Cousin"
    assert one(spark, codes.persona(F.lit("low"), F.lit("2 or less"), F.col("v"), F.lit("well")), v=None) == "Youth Side Hustle"


def test_places(spark):
    assert one(spark, places.point_part(F.col("w"), 0), w="POINT(36.5 -1.25)") == 36.5
    assert one(spark, places.point_part(F.col("w"), 1), w="POINT(36.5)") is None
    ring = one(spark, places.circle(F.lit(0.0), F.lit(36.0), 11.1), w="")
    assert len(ring) == 37 and abs(ring[0]["lon"] - 36.1) < 1e-9 and abs(ring[-1]["lon"] - ring[0]["lon"]) < 1e-9


def test_hull_holds_its_points():
    points = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (1.0, 1.0), (1.0, 0.0), (1.0, 1.0)]
    ring = geo.hull_of(points)
    assert set(ring) == {(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)}
    assert geo.hull_of([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]) == []
