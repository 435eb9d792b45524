import json

from pyspark.sql import functions as F

from helpers import bag, epoch, rows
from pedalflow import operators as op
from pedalflow.operators.decode import CORRUPT
from pedalflow.plans.publish import info_messages, status_messages, weather_messages
from pedalflow.schemas import STATION_INFO, STATION_STATE, STATION_STATUS, WEATHER


def messages(spark, *texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    return frame.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def test_well_formed_status(spark):
    text = json.dumps(
        {
            "station_id": "7",
            "num_bikes_available": 3,
            "num_docks_available": 9,
            "is_installed": True,
            "is_renting": False,
            "is_returning": True,
            "last_reported": 1700000000,
            "city": "Dubai",
            "event_timestamp": 1700000060,
        }
    )
    decoded = op.decode_messages(messages(spark, text), STATION_STATUS)
    assert decoded.schema == STATION_STATUS
    assert rows(decoded) == [("7", 3, 9, True, False, True, 1700000000, "Dubai", 1700000060)]


def test_odd_field_types(spark):
    text = '{"station_id":12,"num_bikes_available":"5","num_docks_available":3.5,"is_installed":1,"is_renting":"x",'
    text += '"event_timestamp":99999999999}'
    decoded = op.decode_messages(messages(spark, text), STATION_STATUS)
    assert rows(decoded) == [("12", 5, None, True, None, None, None, None, 99999999999)]


def test_broken_values_give_null_rows(spark):
    broken = ["not json", '{"station_id":"1","city":"a"', "[1,2]", "", "17", '{"station_id":"1",}']
    decoded = op.decode_messages(messages(spark, *broken, None), STATION_INFO, keep_corrupt=True)
    assert bag(decoded.drop(CORRUPT)) == {(None,) * 5: 7}
    assert {r[CORRUPT] for r in decoded.collect()} == {*broken, None}


def test_text_needs_no_ascii_and_keeps_escapes(spark):
    name = 'Al "Marsa" \\ دبي \n☂'
    text = json.dumps({"station_id": "1", "name": name, "lat": 25.25, "lon": -5e-3, "capacity": 0})
    decoded = op.decode_messages(messages(spark, text), STATION_INFO)
    assert rows(decoded) == [("1", name, 25.25, -0.005, 0)]


def test_some_columns_and_envelope(spark):
    frame = messages(spark, '{"city":"a","temperature":1.5}').withColumn("offset", F.lit(4))
    decoded = op.decode_messages(frame, WEATHER, columns=["temperature", "city"], keep=["offset"])
    assert decoded.columns == ["offset", "temperature", "city"]
    assert rows(decoded) == [(4, 1.5, "a")]


def test_encode_writes_nulls_and_skips_rows_without_key(spark):
    frame = spark.createDataFrame([(1, None), (None, "x")], "station_id int, name string")
    encoded = op.encode_messages(frame, "station_id")
    assert [(bytes(r.key), bytes(r.value)) for r in encoded.collect()] == [(b"1", b'{"station_id":1,"name":null}')]
    empty = spark.createDataFrame([("", "x")], "station_id string, name string")
    assert op.encode_messages(empty, "station_id").isEmpty()


def test_encode_then_decode(spark):
    data = [("a", "n\"1", 1.25, None, 5), ("b", None, None, 0.1, None)]
    frame = spark.createDataFrame(data, STATION_INFO)
    assert bag(op.decode_messages(op.encode_messages(frame, "station_id"), STATION_INFO)) == bag(frame)


def test_station_documents(spark):
    full = {"data": {"stations": [{"station_id": "1", "capacity": 5}, {"station_id": 2, "capacity": "7", "name": "B"}]}}
    odd = ['{"data":{"stations":[]}}', '{"data":{}}', "{}", "nope", None, '{"data":[1]}']
    frame = spark.createDataFrame([(json.dumps(full),), *[(t,) for t in odd]], "value string")
    stations = op.explode_stations(frame, STATION_INFO)
    assert rows(stations) == [("1", None, None, None, 5), ("2", "B", None, None, 7)]


def test_station_list_rules(spark):
    data = [("", "a", 1), (None, "b", 1), ("3", "c", None), ("4", None, 0), ("5", "e", 9)]
    frame = spark.createDataFrame(data, "station_id string, name string, capacity int")
    assert rows(op.clean_station_info(frame)) == [("4", "Unknown", 0), ("5", "e", 9)]
    counts = op.audit_counts(frame, op.station_info_rules())
    assert rows(counts) == [("loaded", 2), ("no_capacity", 1), ("no_station_id", 2)]


def test_status_defaults(spark):
    data = [("1", None, 4, None, False, True, 5), ("", 1, 1, True, True, True, 5), (None, 1, 1, True, True, True, 5)]
    cleaned = op.clean_station_status(spark.createDataFrame(data, STATION_STATE))
    assert rows(cleaned) == [("1", 0, 4, True, False, True, 5)]
    assert rows(op.with_utilization(cleaned), "utilization") == [(0.0,)]


def test_message_audit(spark):
    frame = messages(spark, "bad", '{"station_id":"1"}', '{"station_id":""}', '{"city":"x"}')
    decoded = op.decode_messages(frame, STATION_STATUS, keep_corrupt=True)
    counts = op.audit_counts(decoded, op.message_rules())
    assert rows(counts) == [("corrupt", 1), ("loaded", 1), ("no_key", 2)]


def test_weather_documents(spark):
    documents = {
        "full": '{"dt":100,"main":{"temp":20.5},"wind":{"speed":3.1},"clouds":{"all":40},"rain":{"1h":0.7}}',
        "dry": '{"dt":100,"main":{"temp":20.5},"wind":{"speed":3.1},"clouds":{"all":40}}',
        "no hour": '{"dt":100,"main":{"temp":20.5},"rain":{"3h":1}}',
        "no time": '{"main":{"temp":20.5}}',
        "other": '{"cod":401}',
        "empty": "{}",
        "broken": '{"dt":100,"main":{"temp":20.5}',
        "missing": None,
    }
    frame = spark.createDataFrame(list(documents.items()), "id string, value string")
    frame = frame.withColumn("at", F.timestamp_seconds(F.lit(777)))
    flat = {r.id: tuple(r)[1:] for r in op.flatten_weather(frame, "at", keep=["id"]).collect()}
    assert flat == {
        "full": (100, 20.5, 3.1, 40, 0.7),
        "dry": (100, 20.5, 3.1, 40, 0.0),
        "no hour": (100, 20.5, None, None, 0.0),
        "no time": (777, 20.5, None, None, 0.0),
        "other": (777, None, None, None, 0.0),
        "empty": (777, None, None, None, None),
        "broken": (777, None, None, None, None),
        "missing": (777, None, None, None, None),
    }


def test_stamp(spark):
    frame = spark.range(1).withColumn("at", F.expr("timestamp'2024-01-01 00:00:07.9'"))
    assert rows(op.stamp(frame, "Paris", "at"), "city", "event_timestamp") == [("Paris", epoch("2024-01-01 00:00:07"))]
    assert rows(op.stamp(frame, ingest_col="at"), "city") == [("Dubai",)]
    now = op.stamp(frame).select((F.unix_timestamp() - F.col("event_timestamp")).between(0, 5)).first()[0]
    assert now


def test_documents_to_messages(spark):
    stations = '{"data":{"stations":[{"station_id":"1","num_bikes_available":2,"capacity":4},{"station_id":""}]}}'
    air = '{"dt":50,"main":{"temp":30}}'
    at = F.timestamp_seconds(F.lit(60)).alias("landed_at")
    frame = spark.createDataFrame([(stations,)], "value string").select("value", at)
    sent = op.decode_messages(status_messages(frame, "Rome"), STATION_STATUS)
    assert rows(sent) == [("1", 2, 0, True, True, True, None, "Rome", 60)]
    sent = op.decode_messages(info_messages(frame), STATION_INFO)
    assert rows(sent) == [("1", "Unknown", None, None, 4)]
    weather = weather_messages(spark.createDataFrame([(air,), (None,)], "value string").select("value", at), "Rome")
    assert {bytes(r.key) for r in weather.collect()} == {b"Rome"}
    sent = op.decode_messages(weather, WEATHER)
    assert rows(sent) == [(50, 30.0, None, None, 0.0, "Rome", 60), (60, None, None, None, None, "Rome", 60)]


def test_a_kept_column_may_have_the_name_of_a_field(spark):
    frame = spark.createDataFrame([('{"timestamp":5,"city":"x"}', 7)], "value string, timestamp int")
    decoded = op.decode_messages(frame, WEATHER, columns=["timestamp", "city"], keep=["timestamp"])
    assert [tuple(r) for r in decoded.select("message_timestamp", "timestamp", "city").collect()] == [(7, 5, "x")]
