"""The reference-shaped JSON documents drive an import end to end."""

import json

from chronoweave.plans.cli import main
from chronoweave.sources.store import DatasetStore
from chronoweave.specs import sources_from_json_fields


def write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_sources_json():
    doc = json.dumps([{"dataSource": "CSV", "dataSourceRule": json.dumps({"csvAddress": "/x/a.csv"}),
                       "tagInf": json.dumps([{"tagOrder": "2", "tagID": "p.t", "tagDesc": "temp", "tagType": "DoubleType"}])}])
    (s,) = sources_from_json_fields(doc)
    assert s.kind == "CSV" and s.options["path"] == "/x/a.csv"
    assert (s.tags[0].order, s.tags[0].id, s.tags[0].name) == (2, "p.t", "temp")


def test_cli_import_and_read(spark, scratch, capsys):
    a, b, store_root = scratch("cli_a"), scratch("cli_b"), scratch("cli_store")
    write_text(spark, a, ["time,p.x", "1970/01/01 00:00:00,1", "1970/01/01 00:10:00,3"])
    write_text(spark, b, ["time,q.y", "1970/01/01 00:00:00,5", "1970/01/01 00:20:00,7"])
    sources = [
        {"dataSource": "CSV", "dataSourceRule": {"csvAddress": a},
         "tagInf": [{"tagOrder": "2", "tagID": "p.x", "tagDesc": "x", "tagType": "DoubleType"}]},
        {"dataSource": "CSV", "dataSourceRule": {"csvAddress": b},
         "tagInf": [{"tagOrder": "1", "tagID": "q.y", "tagDesc": "y", "tagType": "DoubleType"}]},
    ]
    rule = {"newDatasetID": "cli_ds", "startTime": "0", "finishTime": "1200000", "resampleMode": "",
            "timeInterval": "600", "typesOfException": "0"}
    assert main(["import", json.dumps(sources), json.dumps(rule), "--store", store_root], spark=spark) == 0
    assert main(["read", "cli_ds", "--store", store_root], spark=spark) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert out[0] == {"dataset": "cli_ds", "version": 1}
    assert out[1]["columns"] == ["timestamp", "y", "x"]
    got = sorted(tuple(r) for r in DatasetStore(spark, store_root).load("cli_ds").collect())
    assert got == [(0, 5.0, 1.0), (600, 5.0, 3.0), (1200, 7.0, 0.0)]
