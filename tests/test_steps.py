"""Steps of a run: retry of a failed one, and going on where a run was broken off."""

from __future__ import annotations

import pytest
from helpers import activity, messages

from tidemill import StepLog, read_steps, run_pipeline, topics_at
from tidemill.__main__ import main
from tidemill.sources import append_messages, scan_table, stream_topic_files


def attempts(spark, folder, run):
    rows = read_steps(spark, folder).filter(f"run = '{run}'").orderBy("recorded_at").collect()
    return [(r["step"], r["attempt"], r["error"] is None) for r in rows]


def test_a_step_is_tried_again_and_done_once(spark, tmp_path):
    folder, calls = str(tmp_path / "steps"), []

    def second_time():
        calls.append("a")
        if len(calls) == 1:
            raise OSError("not yet")
        return {"t": 3, "uncounted": None}

    log = StepLog(spark, folder, "monday")
    assert log.do("a", second_time) == log.do("a", second_time) == {"t": 3, "uncounted": None}
    again = StepLog(spark, folder, "monday")
    assert again.do("a", second_time) == {"t": 3, "uncounted": None}
    assert calls == ["a", "a"]
    assert attempts(spark, folder, "monday") == [("a", 1, False), ("a", 2, True)]
    assert "OSError: not yet" in [r["error"] for r in read_steps(spark, folder).collect()]
    assert StepLog(spark, folder, "tuesday").do("a", second_time) and len(calls) == 3


def test_the_last_error_is_raised(spark, tmp_path):
    def never():
        raise OSError("down")

    with pytest.raises(OSError, match="down"):
        StepLog(spark, str(tmp_path / "s"), "x", retries=2).do("a", never)
    assert [a for _, a, _ in attempts(spark, str(tmp_path / "s"), "x")] == [1, 2, 3]
    with pytest.raises(ValueError, match="negative"):
        StepLog(spark, str(tmp_path / "s"), "x", retries=-1)


@pytest.mark.parametrize("concurrent", [False, True])
def test_a_chain_goes_on_at_the_failing_job(spark, root, concurrent):
    topics = {"user_activity": topics_at(root)["user_activity"]}
    config, folder, opened = topics["user_activity"], f"{root}/steps", []
    events = activity(spark, [("a", "payment", "00:05", 1.0), ("b", "payment", "05:00", 1.0)])
    append_messages(messages(spark, events), f"{root}/topic")

    def source(topic):
        opened.append(topic.name)
        return stream_topic_files(spark, f"{root}/topic")

    def run(**options):
        steps = StepLog(spark, folder, "daily")
        return run_pipeline(spark, topics, source, concurrent, steps=steps, **options)

    with pytest.raises(Exception, match="(?i)nonsense|interval"):
        run(gold_options={"watermark": "nonsense"})
    counts = run()
    assert counts == run()
    assert opened == ["user_activity"]
    assert counts["bronze.user_activity"] == counts["silver.user_activity"] == 2
    assert counts["gold.revenue_hourly"] == 1
    assert scan_table(spark, config.bronze_table).count() == 2
    steps = [(f"{layer}.user_activity", n, good) for layer, n, good in (
        ("bronze", 1, True), ("silver", 1, True), ("gold", 1, False), ("gold", 2, False), ("gold", 1, True)
    )]
    assert attempts(spark, folder, "daily") == steps


def test_a_named_run_on_the_command_line(spark, tmp_path):
    events = activity(spark, [("a", "login", "00:05", None)])
    append_messages(messages(spark, events), f"{tmp_path}/topics/user_activity")
    arguments = ["all", "--root", f"{tmp_path}/lake", "--topics", f"{tmp_path}/topics", "--run", "r"]
    with pytest.raises(Exception, match="(?i)product_events"):
        main(arguments, spark)
    ended = attempts(spark, f"{tmp_path}/lake/_steps", "r")
    assert ended[:3] == [(f"{layer}.user_activity", 1, True) for layer in ("bronze", "silver", "gold")]
    assert ended[3:] == [("bronze.product_events", n, False) for n in (1, 2)]
