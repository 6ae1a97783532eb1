import json

import pytest
from test_mart import Feed, customer, event, item, order

from cdcmart.__main__ import build_parser, main
from cdcmart.plans import catalog
from cdcmart.sinks.mart import Mart


def run(root, *words):
    return main([words[0], "--root", root, *words[1:]])


def test_a_day_with_the_command_line(spark, root, tmp_path, capsys):
    for source, values in {
        "customers": [event("c", customer(1, "ann"))],
        "products": [event("c", {"product_id": 5, "product_name": "bolt"})],
        "orders": [event("c", order(10)), event("c", order(11, "COMPLETED"))],
        "order_items": [event("c", item(1, 10))],
    }.items():
        Feed(spark, tmp_path / source).send(*values)
    run(root, "init")
    run(root, "validate")
    run(root, "stream", "--format", "parquet", "--path", str(tmp_path), "--once", "--audit", "--after-batch", "sync", "refresh")
    capsys.readouterr()
    run(root, "audit", "--table", "orders")
    assert json.loads(capsys.readouterr().out.splitlines()[0]) == {"table": "fact_orders", "lost offsets": 0}
    run(root, "report", "--name", "top_customers", "pending_items_by_product")
    places = {x["report"]: x["path"] for x in map(json.loads, capsys.readouterr().out.splitlines())}
    assert spark.read.parquet(places["top_customers"]).first().customer_name == "ann"
    assert spark.read.parquet(places["pending_items_by_product"]).first().product_name == "bolt"
    run(root, "report", "--name", "top_customers", "--show", "5", "--output", str(tmp_path / "out"))
    assert "ann" in capsys.readouterr().out
    run(root, "refresh", "--name", "top_customers")
    assert "ann" in (said := capsys.readouterr().out) and json.loads(said.splitlines()[0]) == {"refreshed": False, "whole": False}
    with pytest.raises(RuntimeError, match="does not stand|missing"):
        spark.sql("drop database if exists cli_mart cascade")
        spark.sql("create database cli_mart")
        catalog.validate(Mart(spark, root), "cli_mart")
    run(root, "catalog", "--database", "cli_mart", "--fold")
    assert spark.table("cli_mart.fact_orders").count() == 2
    capsys.readouterr()
    run(root, "sync")
    run(root, "merge")
    run(root, "compact")
    run(root, "vacuum")
    capsys.readouterr()
    run(root, "status", "--table", "orders")
    line = json.loads(capsys.readouterr().out)
    assert (line["rows"], line["generation"], line["checkpoint"]["exists"]) == (2, 0, True)

    source = tmp_path / "source"
    spark.sql(
        "select 12L order_id, 'PENDING' status, timestamp'2024-05-01 10:00:00' created_at,"
        " timestamp'2024-05-01 10:00:00' updated_at"
    ).write.parquet(str(source))
    arguments = ("backfill", "--table", "orders", "--from-date", "2024-05-01", "--source", str(source))
    run(root, *arguments, "--dry-run")
    assert "Physical Plan" in capsys.readouterr().out
    run(root, *arguments)
    assert json.loads(capsys.readouterr().out)["net_change"] == 1

    run(root, "reset", "--table", "orders", "--replay")
    assert json.loads(capsys.readouterr().out)["rows_before"] == 3
    run(root, "stream", "--format", "parquet", "--path", str(tmp_path), "--once", "--table", "orders")
    with pytest.raises(SystemExit, match="no effect"):
        run(root, "stream", "--format", "parquet", "--path", str(tmp_path), "--once", "--table", "orders", "--offset", "1")
    run(root, "replay", "--table", "all")
    assert "generation=2" in capsys.readouterr().out
    run(root, "reset", "--table", "orders")
    run(root, "stream", "--format", "parquet", "--path", str(tmp_path), "--once", "--table", "orders", "--offset", "1")
    capsys.readouterr()
    run(root, "status", "--table", "orders")
    assert json.loads(capsys.readouterr().out)["rows"] == 1


def test_wrong_arguments_are_refused(root):
    parser = build_parser()
    for words in (
        ["stream", "--root", root, "--offset", "soon"],
        ["backfill", "--root", root, "--table", "orders"],
        ["report", "--root", root, "--name", "other"],
    ):
        with pytest.raises(SystemExit):
            parser.parse_args(words)
    with pytest.raises(ValueError):
        main(["reset", "--root", root, "--table", "nothing"])
