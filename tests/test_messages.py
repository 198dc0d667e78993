import json

from riverglass.operators import devices as D, stations as St


def messages(spark, values):
    return spark.createDataFrame(
        [(None, None if v is None else (v if isinstance(v, str) else json.dumps(v)).encode()) for v in values],
        "key binary, value binary")


STATION = {"station_id": "s1", "call_out": "o", "call_in": "i", "status": "success",
           "call_time": "2024-01-01 00:00:00", "duration": 5}


def test_station_rule(spark):
    bad = [{**STATION, "station_id": None}, {k: v for k, v in STATION.items() if k != "station_id"},
           {**STATION, "call_out": " "}, {**STATION, "status": "lost"},
           {**STATION, "call_time": "yesterday"}, {**STATION, "duration": -1},
           {**STATION, "duration": "long"}, "not json", None]
    good = [STATION, {**STATION, "status": " Busy ", "duration": "0"}]
    kept = St.clean(St.station_rows(messages(spark, bad + good))).collect()
    assert sorted((r.status, r.duration) for r in kept) == [("busy", 0), ("success", 5)]


def device(name, kind, signal, **more):
    return {"device": name, "device_type": kind, "signal": signal, "time": 1704067200123, **more}


DEVICES = [device("d1", "route", 30.0), device("d1", "route", 30.01), device("d2", "route", "89"),
           device("d3", "bigdata", 2), device("d4", "db", "x"),
           {"device": "d5", "device_type": "db", "time": 1}, {"device": "d6", "signal": 50},
           {**device("d7", "db", "NaN"), "time": 2**62}, "not json", None]


def test_device_rows(spark, rows):
    dsl = D.device_rows(messages(spark, DEVICES))
    assert rows(dsl.select("device", "device_type", "signal")) == [
        ("d1", "route", 30.0), ("d1", "route", 30.01), ("d2", "route", 89.0),
        ("d3", "bigdata", 2.0), ("d4", "db", None), ("d5", "db", None), ("d7", "db", None)]
    assert rows(dsl) == rows(D.device_rows_sql(messages(spark, DEVICES)))


def test_device_statistics(spark, rows):
    df = D.device_rows(messages(spark, DEVICES))
    assert rows(D.strong_signals(df).select("device", "signal")) == [("d1", 30.01), ("d2", 89.0)]
    assert rows(D.strong_signals(df)) == rows(D.strong_signals_sql(df))
    assert rows(D.devices_by_type(df)) == [("bigdata", 1), ("db", 3), ("route", 3)]
    assert rows(D.devices_by_type(df, distinct=True)) == [("bigdata", 1), ("db", 3), ("route", 2)]
    assert rows(D.mean_signal_by_type(df))[:2] == [("bigdata", 2.0), ("db", None)]
    # A type without a strong signal is absent.
    assert [r[:2] for r in rows(D.device_stats(df))] == [("route", 2)]
    assert rows(D.device_stats(df)) == rows(D.device_stats_sql(df))
