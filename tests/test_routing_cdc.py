"""Routing and change records on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from millrace import constants as C
from millrace.operators import cdc, parse, routing

PLAY = {"event_type": C.PLAY_EVENT, "event_content": {"uid": 7, "songid": "s1"}, "mid": "3"}
LOGIN = {"event_type": C.LOGIN_EVENT, "uid": "7", "mid": "m9", "lng": "1.5", "gone": None, "n": 2, "list": [1, {"a": "b"}]}


def texts(rows, *values):
    return rows([(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False),) for v in values], "value string")


def routed(rows, value, routes=routing.THREE_WAY):
    return routing.route_events(texts(rows, value), routes).first()


def test_play_forwards_its_body(rows):
    r = routed(rows, PLAY)
    assert (r["route"], r["topic"], r["key"], json.loads(r["value"])) == ("play", C.DWD_PLAY, "7", {"uid": 7, "songid": "s1"})


def test_play_with_text_body(rows):
    r = routed(rows, {"event_type": C.PLAY_EVENT, "event_content": '{"uid":8}'})
    assert (r["route"], r["key"], r["value"]) == ("play", "8", '{"uid":8}')


def test_play_without_key_or_body(rows):
    assert routed(rows, {"event_type": C.PLAY_EVENT, "event_content": {"songid": "x"}})["key"] is None
    r = routed(rows, {"event_type": C.PLAY_EVENT})
    assert (r["route"], r["key"], r["value"]) == ("play", None, None)


def test_login_loses_its_type_and_null_fields_only(rows):
    r = routed(rows, LOGIN)
    want = {k: v for k, v in LOGIN.items() if k not in ("event_type", "gone")}
    assert (r["route"], r["key"], json.loads(r["value"])) == ("login", "m9", want)


@pytest.mark.parametrize("value", [{"event_type": "X"}, {"event_type": None, "a": 1}, {"a": 1}, {}])
def test_unknown_and_missing_types_are_other_and_stay_raw(rows, value):
    r = routed(rows, value)
    assert (r["route"], r["topic"], r["key"], r["value"]) == ("other", C.DWD_OTHER, None, json.dumps(value))


@pytest.mark.parametrize("value", ["no json", '{"a":', "[1]", "", None])
def test_text_that_is_no_object_is_malformed(rows, value):
    r = routed(rows, value)
    assert (r["route"], r["key"], r["value"]) == ("malformed", None, value)


def test_two_way_routes(rows):
    assert routed(rows, LOGIN, routing.TWO_WAY)["route"] == "other"
    assert routed(rows, {**PLAY, "event_content": {"mid": 4}}, routing.TWO_WAY)["key"] == "4"


def test_every_row_takes_one_route(rows):
    df = routing.route_events(texts(rows, PLAY, LOGIN, {"a": 1}, "bad", None, PLAY))
    counts = {r["route"]: r["count"] for r in df.groupBy("route").count().collect()}
    assert counts == {"play": 2, "login": 1, "other": 1, "malformed": 2}


def test_a_filter_does_not_parse_twice(rows):
    plan = routing.only(routing.route_events(texts(rows, PLAY)), "play")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == 1


def test_missing_numbers(rows):
    row = parse.parse_json(texts(rows, {"songid": "a", "dur_time": None}), C.PLAY_SCHEMA).first()
    assert (row["songid"], row["time"], row["dur_time"], row["uid"]) == ("a", 0, 0, None)
    assert parse.parse_json(texts(rows, {}), C.PLAY_SCHEMA, number_default=None).first()["time"] is None


def test_records_leave_out_nulls(rows):
    df = rows([("k", 1, None)], "a string, b int, c string")
    row = parse.to_records(df, key="a", topic="t").first()
    assert (row["key"], row["topic"], json.loads(row["value"])) == ("k", "t", {"a": "k", "b": 1})


# ---------------------------------------------------------------- changes

CONFIG = [
    ("orders", "db", "fact", "id", "id", "", "T_FACT"),
    ("song", "db", "dim", "source_id", "source_id,name,album", C.DIM_SONG, "T_DIM"),
    ("odd", "db", "anything", "id", "id", "", "T_ODD"),
]


def change(table, kind, data, ts=1, xid=1, xoffset=0, database="db"):
    return {"database": database, "table": table, "type": kind, "ts": ts, "xid": xid, "xoffset": xoffset, "commit": True, "data": data}


@pytest.fixture
def classified(rows, spark):
    def build(*changes):
        return cdc.classify(cdc.parse_changes(texts(rows, *changes)), rows(CONFIG, C.CONFIG_SCHEMA))

    return build


def test_only_configured_tables_pass(classified):
    df = classified(
        change("orders", "insert", {"id": 1}), change("song", "insert", {"source_id": "s"}), change("odd", "insert", {"id": 1}),
        change("other", "insert", {}), change("orders", "insert", {}, database="elsewhere"), "no json", None,
    )
    assert sorted((r["table"], r["kind"]) for r in df.collect()) == [("odd", "fact"), ("orders", "fact"), ("song", "dim")]


def test_config_rows_of_one_table_do_not_double_changes(rows, classified):
    df = cdc.classify(
        cdc.parse_changes(texts(rows, change("song", "insert", {}))), rows([*CONFIG, *CONFIG], C.CONFIG_SCHEMA)
    )
    assert df.count() == 1


def test_fact_record_is_the_data_with_its_time(classified):
    row = cdc.fact_records(classified(change("orders", "delete", {"id": 1, "x": 1.5, "n": None, "o": {"a": [1]}}, ts=99))).first()
    assert (row["key"], row["topic"]) == (None, "T_FACT")
    assert json.loads(row["value"]) == {"id": 1, "x": 1.5, "o": {"a": [1]}, "ts": "99"}


def test_time_in_the_data_is_overwritten(classified):
    row = cdc.fact_records(classified(change("orders", "insert", {"ts": "old", "id": 1}, ts=5))).first()
    assert json.loads(row["value"]) == {"id": 1, "ts": "5"}


def test_fact_ops_are_optional(classified):
    df = classified(change("orders", "delete", {"id": 1}), change("orders", "insert", {"id": 2}))
    assert cdc.fact_changes(df).count() == 2
    assert cdc.fact_changes(df, ["insert", "update"]).count() == 1


def test_dim_record_is_the_envelope_with_its_configuration(classified):
    source = change("song", "delete", {"source_id": "s"})
    row = cdc.dim_records(classified(source)).first()
    assert (row["key"], row["topic"]) == ("dbsong", "T_DIM")
    assert json.loads(row["value"]) == {
        **source, "pk_col": "source_id", "cols": "source_id,name,album", "phoenix_tbl_name": C.DIM_SONG, "sink_topic": "T_DIM",
    }


def test_flat_record(classified):
    row = cdc.flat_records(classified(change("song", "insert", {"source_id": "s"}, ts=3))).first()
    assert json.loads(row["value"]) == {
        "source_id": "s", "ts": "3", "type": "insert", "pk_col": "source_id", "cols": "source_id,name,album",
        "phoenix_table_name": C.DIM_SONG, "sink_topic": "T_DIM",
    }


def test_latest_dim_rows(classified):
    def song(key, name, kind, ts, xid, xoffset=0):
        return change("song", kind, {"source_id": key, "name": name, "album": "《x》", "unused": 1}, ts, xid, xoffset)

    df = classified(
        song("a", "first", "insert", 1, 1), song("a", "last", "update", 2, 5, 1), song("a", "before", "update", 2, 5, 0),
        song("a", "deleted", "delete", 9, 9), song("b", "boot", "bootstrap-insert", 0, 0), song("c", "no", "table-create", 1, 1),
        song(None, "no key", "insert", 1, 1),
    )
    got = cdc.latest_dim_rows(df, C.DIM_SONG, "source_id", "source_id,name,album")
    assert got.columns == ["source_id", "name", "album"]
    assert {r["source_id"]: (r["name"], r["album"]) for r in got.collect()} == {"a": ("last", "《x》"), "b": ("boot", "《x》")}


def test_key_that_is_not_among_the_columns_comes_first():
    assert cdc.column_names("id", "a,b") == ["id", "a", "b"]
    assert cdc.column_names("a", "b, a,") == ["a", "b"]


def test_config_is_broadcast(classified):
    plan = classified(change("song", "insert", {}))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_column_types_survive(rows):
    df = rows([("1",)], "value string").select(F.lit('{"a":12345678901234567890,"b":1e-3,"c":true}').alias("value"))
    back = df.select(F.to_json(parse.json_fields(F.col("value")))).first()[0]
    assert json.loads(back) == {"a": 12345678901234567890, "b": 0.001, "c": True}


@pytest.mark.parametrize("value", [
    '{"id":1}', ' {"id":1}\n', "{}", "{ \n}", '{"ts":"old","id":1}', '{"id":null}', '{"\\u0074s":"old","id":1}',
    '{"id":"a\\"b, \\\\ null"}', '{"o":{"ts":1}}', '{"id":"}"}', "[1]", '"text"', "none", None,
])
@pytest.mark.parametrize("new", ['say "hi"\\', None])
def test_put_fields(rows, value, new):
    df = rows([(value, new)], "v string, n string")
    got = df.select(parse.put_fields(F.col("v"), ts=F.col("n"), x=F.lit("1"))).first()[0]
    if value is None or not value.strip().startswith("{"):
        assert got is None
        return
    want = {k: v for k, v in json.loads(value).items() if k != "ts" and v is not None}
    assert json.loads(got) == {**want, "x": "1", **({"ts": new} if new else {})}


def test_the_last_change_of_a_transaction_wins(spark, rows):
    """Records of a transaction count up; the one that commits it carries no offset. Equal records go by arrival."""
    def record(name, xoffset=None, commit=None, offset=0, ts=1):
        return (json.dumps({"source_id": "a", "name": name}), "update", C.DIM_SONG, ts, 1, xoffset, commit, offset)

    schema = "data string, type string, phoenix_tbl_name string, ts long, xid long, xoffset long, commit boolean, offset long"
    for changes, last in (
        ([record("first", 0), record("second", 1), record("last", None, True)], "last"),
        ([record("z", offset=1), record("a", offset=2)], "a"),
        ([record("z", None, True, ts=1), record("a", 0, ts=2)], "a"),
    ):
        for order in (changes, changes[::-1]):
            got = cdc.latest_dim_rows(rows(order, schema), C.DIM_SONG, "source_id", "source_id,name").collect()
            assert [r["name"] for r in got] == [last]


def test_put_fields_on_odd_texts(rows):
    cases = {
        '{"a":1,"a":2,"ts":3}': {"a": 2, "ts": "9"}, '{"a":1.50}': {"a": 1.5, "ts": "9"}, '{"a":1e3}': {"a": 1000, "ts": "9"},
        '{"a":null,"b":1.50}': {"b": 1.5, "ts": "9"}, '{"a":{"x":1},"b":{"x":1}}': {"a": {"x": 1}, "b": {"x": 1}, "ts": "9"}, "[1]": None,
        '{"a":"q\\"ts\\":","b":1}': {"a": 'q"ts":', "b": 1, "ts": "9"},
    }
    got = rows([(t,) for t in cases], "t string").select("t", parse.put_fields(F.col("t"), ts=F.lit("9")).alias("v")).collect()
    assert {r["t"]: r["v"] and json.loads(r["v"]) for r in got} == cases
    # What only gets fields appended keeps its spelling.
    kept = ['{"a":1.50}', '{"a":-0.0,"b":1e3,"c":"1-05"}', '{"a":{"ts":null}, "b":[1.10]}', '{"a":"null"}', '{"a":"\\u00e9"}', "{ }"]
    got = rows([(t,) for t in kept], "t string").select(parse.put_fields(F.col("t"), ts=F.lit("9"), x=F.lit(None)).alias("v")).collect()
    assert [r["v"] for r in got][:2] == [t[:-1] + ',"ts":"9"}' for t in kept[:2]]
    assert [r["v"] for r in got][3:] == ['{"a":"null","ts":"9"}', '{"a":"\\u00e9","ts":"9"}', '{ "ts":"9"}']
    assert [json.loads(r["v"]) for r in got] == [{**json.loads(t), "ts": "9"} for t in kept]


def test_numbers_as_the_getters_read_them(rows):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DoubleType())])
    texts = ['{"n":"1620985690304","d":"2.5"}', '{"n":3.9,"d":3}', '{"n":-3.9}', '{"n":1e3,"d":"x"}', '{"n":"x","d":{"y":1}}', '{"n":99999999999999999999}']
    got = parse.parse_json(rows([(t,) for t in texts], "value string"), schema).collect()
    assert [tuple(r) for r in got] == [(1620985690304, 2.5), (3, 3.0), (-3, 0.0), (1000, 0.0), (0, 0.0), (0, 0.0)]
