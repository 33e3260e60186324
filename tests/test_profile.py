from conftest import rows

from goldkeep.operators import profile


def test_entity_profile_formats_counts(spark):
    got = profile.entity_profile(
        {"facts": ("transactional", spark.range(1234567)), "m": ("master", spark.range(3))}
    )
    assert rows(got) == [("facts", "transactional", 1234567, "1,234,567"), ("m", "master", 3, "3")]


def test_schema_profile(spark, stops):
    got = profile.schema_profile({"stops": stops, "none": stops.where("false").select("stop")})
    assert [tuple(r) for r in got.select("table_name", "position", "column_name", "column_type", "n_rows").collect()] == [
        ("stops", 0, "stop_id", "bigint", 12),
        ("stops", 1, "district", "string", 12),
        ("stops", 2, "stop", "string", 12),
        ("stops", 3, "tier", "string", 12),
        ("none", 0, "stop", "string", 0),
    ]


def test_reference_values_sorted_numbers_and_nulls(spark):
    df = spark.createDataFrame(
        [(10, 1.0, "b"), (9, None, "a"), (10, 99.0, None)], "vendor int, rate double, flag string"
    )
    got = profile.reference_values(df, ["vendor", "rate", "flag"], drop_nulls=["rate"])
    assert [tuple(r) for r in got.collect()] == [
        ("flag", "a", 1), ("flag", "b", 1), ("flag", None, 1),
        ("rate", "1.0", 1), ("rate", "99.0", 1),
        ("vendor", "9", 1), ("vendor", "10", 2),
    ]
