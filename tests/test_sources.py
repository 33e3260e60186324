import json

import pytest
from conftest import SMALL, rows

from goldkeep import shared
from goldkeep.functions.missing import normalise_missing
from goldkeep.sources import files, layout

STOP = "stop_id bigint, district string, stop string, tier string"


def test_missing_tokens(spark):
    values = ["N/A", "NA", "null", "", "Unknown", "-", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r.s for r in normalise_missing(df, ["s"]).collect()] == [None] * 4 + ["Unknown", "-", None]
    assert [r.s for r in normalise_missing(df, ["s"], ("-",)).collect()] == values[:5] + [None, None]


def test_csv_reads_quotes_crlf_and_missing(spark, tmp_path):
    path = tmp_path / "stops.csv"
    path.write_bytes(
        b'"stop_id","district","stop","tier"\r\n3,"Harbour","Pier, ""north""","coast"\r\n'
        b'70,"Unmapped","N/A","N/A"\r\n71,"N/A","Beyond the ring",""\r\n'
    )
    df = files.read_csv(spark, str(path), STOP)
    assert df.dtypes[0] == ("stop_id", "bigint")
    assert [tuple(r) for r in df.collect()] == [
        (3, "Harbour", 'Pier, "north"', "coast"),
        (70, "Unmapped", None, None),
        (71, None, "Beyond the ring", None),
    ]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("stop,tier,more,stop_id,district\nPier,coast,x,3,Harbour\n")
    df = files.read_csv(spark, str(tmp_path), STOP)
    assert df.columns == ["stop_id", "district", "stop", "tier"]
    assert rows(df) == [(3, "Harbour", "Pier", "coast")]
    (tmp_path / "b.csv").write_text("tier,stop,more,stop_id,district\nring,Weir,x,4,Old Town\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path), STOP).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.csv").write_text("stop_id,district,stop\n3,a,b\n")
    with pytest.raises(ValueError, match="no column tier"):
        files.read_csv(spark, str(tmp_path / "c"), STOP)


def test_csv_sink_has_header_no_index_and_empty_nulls(spark, stops, tmp_path):
    path = str(tmp_path / "out")
    files.write_csv(stops.coalesce(1), path)
    written = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert written[0] == "stop_id,district,stop,tier"
    assert written[-2:] == ["70,Unmapped,,", "71,,Beyond the ring,"]
    assert rows(files.read_csv(spark, path, STOP)) == rows(stops)


def test_bad_number_is_not_swallowed(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("stop_id,district,stop,tier\nabc,a,b,c\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), STOP).collect()


def test_json_documents(spark, stops, tmp_path):
    files.write_json(stops, str(tmp_path / "docs"))
    assert rows(files.read_json(spark, str(tmp_path / "docs"), STOP)) == rows(stops)
    texts = [r.body for r in files.documents(stops.where("stop_id = 70")).collect()]
    assert json.loads(texts[0]) == {
        "stop_id": 70, "district": "Unmapped", "stop": None, "tier": None
    }
    one = spark.createDataFrame([('{"riders": 812, "line": "blue"}',)], "body string")
    parsed = files.parse_documents(one, "body", "riders bigint, line string")
    assert parsed.columns == ["body", "riders", "line"]
    assert parsed.first()[1:] == (812, "blue")


def test_parquet_columns_are_pruned(spark):
    df = files.read_parquet(spark, f"{SMALL}/lineitem.parquet", ["l_partkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint>" in plan


def test_prefix_layout_prunes_folders(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").selectExpr(
        "event_id", "event_type", "date_format(ts, 'yyyy-MM-dd') as day"
    )
    layout.write_by_prefix(events, str(tmp_path / "e"), ["event_type", "day"])
    assert (tmp_path / "e" / "event_type=error" / "day=2024-01-05").is_dir()
    back = spark.read.parquet(str(tmp_path / "e"))
    one = back.where("event_type = 'error' and day = '2024-01-05'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "event_type" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert one.count() == events.where("event_type = 'error' and day = '2024-01-05'").count() > 0
    assert back.count() == events.count()


def test_scratch_is_removed_on_demand(spark):
    path = shared.scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    assert shared.path_exists(spark, path) and shared.clear_scratch(spark) >= 1
    assert not shared.path_exists(spark, path) and shared.clear_scratch(spark) == 0


DOCUMENTS = [
    (1, '{"k": 3, "s": "x"}'), (2, '{"k": 3'), (3, None), (4, '[1]'), (5, '{"k": "many"}'), (6, '{"k": null}'), (7, "{}"),
    (8, '7'), (9, ""), (10, '{"k": {"deep": 1}, "s": "y"}'), (11, '{"s": 5}'),
]


def test_documents_that_do_not_fit_are_kept_apart(spark):
    df = spark.createDataFrame(DOCUMENTS, "id int, body string")
    read = files.parse_or_reject(df, "body", {"k": "bigint", "s": "string"})
    assert read.columns == ["id", "body", "k", "s", "rejected"]
    assert {r.id: (r.k, r.s, r.rejected) for r in read.collect()} == {
        1: (3, "x", None), 2: (None, None, "malformed"), 3: (None, None, None), 4: (None, None, "not an object"),
        5: (None, None, "field k"), 6: (None, None, None), 7: (None, None, None), 8: (None, None, "not an object"),
        9: (None, None, "malformed"), 10: (None, None, "field k"), 11: (None, "5", None),
    }
    shapes = {r.shape: r.n_documents for r in files.document_shapes(df, "body").collect()}
    assert shapes[None] == 2 and shapes["OBJECT<k: BIGINT, s: STRING>"] == 1 and sum(shapes.values()) == 10
    objects = df.where("id in (1, 6, 7)")
    assert files.common_shape(objects, "body").first().shape == "OBJECT<k: BIGINT, s: STRING>"


def test_inventory_opens_no_file(spark, tmp_path):
    (tmp_path / "store" / "a b").mkdir(parents=True)
    (tmp_path / "store" / "a b" / "one.txt").write_text("12345")
    (tmp_path / "store" / "two.bin").write_bytes(b"12")
    found = files.inventory(spark, str(tmp_path / "store"))
    assert sorted((r.key, r["size"]) for r in found.collect()) == [("a b/one.txt", 5), ("two.bin", 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
