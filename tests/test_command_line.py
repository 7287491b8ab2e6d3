from __future__ import annotations

import pytest
from helpers import activity, messages, raw_messages

from tidemill.__main__ import main
from tidemill.sources import append_messages
from tidemill.topics import TOPICS


def test_layer_by_layer(spark, root, database, capsys):
    events = activity(spark, [("a", "payment", "00:05", 1.0), ("b", "payment", "05:00", 1.0)])
    append_messages(messages(spark, events), f"{root}/topics/user_activity")
    for places in (["--root", root], ["--root", f"{root}/marks", "--catalog", database]):
        source = ["--topics", f"{root}/topics"]
        assert main(["bronze", "user_activity", *places, *source], spark) == 2
        assert main(["silver", "user_activity", *places], spark) == 2
        counts = {"funnel_metrics_hourly": 1, "revenue_hourly": 1}
        assert main(["gold", "user_activity", *places, "--concurrent"], spark) == counts
    assert '"revenue_hourly": 1' in capsys.readouterr().out


@pytest.mark.parametrize(
    "arguments",
    [
        ["gold", "--root", "/x"],
        ["all", "user_activity", "--root", "/x"],
        ["bronze", "nope", "--root", "/x"],
        ["bronze", "user_activity", "--root", "/x"],
    ],
)
def test_wrong_arguments(spark, arguments, capsys):
    with pytest.raises(SystemExit):
        main(arguments, spark)
    assert "error" in capsys.readouterr().err


@pytest.mark.parametrize("layer", [["bronze", "order_events"], ["all"]])
def test_kafka_is_a_source_of_every_layer_that_reads_messages(spark, tmp_path, monkeypatch, layer):
    """Without the Kafka package Spark says so; the options get that far."""
    monkeypatch.setenv("TIDEMILL_KAFKA_USERNAME", "me")
    monkeypatch.setenv("TIDEMILL_KAFKA_PASSWORD", "word")
    arguments = [*layer, "--root", str(tmp_path), "--kafka", "host:1", "--max-offsets", "10"]
    with pytest.raises(Exception, match="(?i)kafka"):
        main(arguments, spark)


def test_messages_that_do_not_decode_can_be_set_aside(spark, tmp_path, capsys):
    events = activity(spark, [("a", "login", "00:05", None)])
    good = bytes(messages(spark, events).first()["value"])
    for name in TOPICS:
        append_messages(raw_messages(spark, [good[:-3]]), f"{tmp_path}/topics/{name}")
    arguments = ["all", "--root", f"{tmp_path}/lake", "--topics", f"{tmp_path}/topics"]
    counts = main([*arguments, "--on-error", "quarantine"], spark)
    assert {n for step, n in counts.items() if step.startswith(("bronze", "silver"))} == {0}
    assert spark.read.parquet(f"{tmp_path}/lake/quarantine/user_activity").count() == 1
