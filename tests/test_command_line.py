"""The jobs from landed documents to a trained model, by their command line."""

import json
import os

import pytest

from pedalflow.__main__ import main
from pedalflow.operators import decode_messages
from pedalflow.plans.forecast import load_model
from pedalflow.schemas import STATION_INFO
from pedalflow.session import state_partitions
from pedalflow.sources import file_channel, read_messages, read_summary
from pedalflow.streaming import read_scores


def land(folder, documents):
    """Documents as files that landed at the given epoch seconds."""
    os.makedirs(folder)
    for at, document in documents.items():
        path = f"{folder}/{at}.json"
        with open(path, "w") as f:
            json.dump(document, f)
        os.utime(path, (at, at))


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    home = str(tmp_path_factory.mktemp("landed"))
    start = 1704067200
    half_hours = [start + 1800 * i for i in range(40)]
    stations = [{"station_id": str(i), "capacity": 10, "lat": 25.0, "lon": 55.0} for i in range(3)]
    land(f"{home}/stations", {start: {"data": {"stations": [*stations, {"station_id": "x"}]}}})
    land(
        f"{home}/status",
        {
            at: {"data": {"stations": [{"station_id": str(i), "num_bikes_available": (at // 1800 + i) % 7,
                                        "num_docks_available": 3 + i} for i in range(3)]}}
            for at in half_hours
        },
    )
    land(
        f"{home}/weather",
        {
            at: {"dt": at, "main": {"temp": 20 + (at // 1800) % 9}, "wind": {"speed": 2}, "clouds": {"all": 10}}
            for at in half_hours
        },
    )
    return home


def test_from_documents_to_forecast(spark, landed, scratch, capfd):
    messages = f"{scratch}/messages"
    main(["publish-stations", "--documents", f"{landed}/stations", "--messages", messages])
    for feed in ("status", "weather"):
        main(
            [f"publish-{feed}", "--documents", f"{landed}/{feed}", "--messages", messages, "--once", "--city", "Rome"]
            + ["--checkpoint", f"{scratch}/publish-{feed}"]
        )
    info = decode_messages(read_messages(spark, file_channel(f"{messages}/station_info")), STATION_INFO)
    assert sorted((r.station_id, r.name) for r in info.collect()) == [(str(i), "Unknown") for i in range(3)]

    with state_partitions(spark, 2):
        main(
            ["usage-30m", "--messages", messages, "--out", f"{scratch}/usage", "--once", "--show", "--monitor"]
            + ["--checkpoint", f"{scratch}/usage-progress"]
        )
    summary = read_summary(spark, f"{scratch}/usage", grain="30 minutes")
    # The last event is at the start of the 40th window; windows ending later than half an hour before it stay open.
    assert summary.count() == 38 and {r.city for r in summary.collect()} == {"Rome"}
    printed = capfd.readouterr().out
    assert "usage summary: batch" in printed and "utilization: batch" in printed

    main(
        ["enrich", "--messages", messages, "--out", f"{scratch}/enriched", "--once"]
        + ["--checkpoint", f"{scratch}/enrich-progress"]
    )
    assert spark.read.parquet(f"{scratch}/enriched").where("capacity = 10").count() == 120
    main(["weather", "--messages", messages, "--once"])

    main(["train", "--summary", f"{scratch}/usage", "--grain", "30 minutes", "--model", f"{scratch}/model"])
    printed = capfd.readouterr().out
    assert "rmse" in printed and "temp_t1h" in printed and "Rome" in printed
    assert load_model(f"{scratch}/model").stages[-1].getNumTrees == 120

    main(["train", "--summary", f"{scratch}/usage", "--grain", "30 minutes", "--models", f"{scratch}/models"])
    main(
        ["score", "--summary", f"{scratch}/usage", "--models", f"{scratch}/models", "--out", f"{scratch}/scores"]
        + ["--once", "--checkpoint", f"{scratch}/score-progress"]
    )
    assert [(r.city, r.model_version) for r in read_scores(spark, f"{scratch}/scores").collect()] == [("Rome", 1)]
    before = summary.count()
    main(["compact", "--summary", f"{scratch}/usage", "--grain", "30 minutes", "--expire", "3600"])
    assert read_summary(spark, f"{scratch}/usage", grain="30 minutes").count() == before
