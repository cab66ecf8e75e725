import json

import pytest
from pyspark.sql import functions as F

from spindle.functions.timefmt import strict_iso_timestamp
from spindle.operators import envelope
from tests.helpers import messages_df

BASE = {
    "event_id": "ride-0042",
    "timestamp": "2024-06-09T08:12:59-05:00",
    "data": {"colour": "dark red", "grade": "b2"},
    "metadata": {"source": "meter-7", "version": "1.0"},
}


def with_(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


def meta(**kw):
    m = dict(BASE["metadata"])
    for k, v in kw.items():
        if v is KeyError:
            m.pop(k)
        else:
            m[k] = v
    return with_(metadata=m)


B = json.dumps(BASE)
# Truth table of envelope cases: (name, payload, expected reason or None = valid).
CASES = [
    ("ok", B, None),
    ("ws", "  \n" + B + " \t", None),
    ("extra", B[:-1] + ', "foo": 1}', None),
    ("dup", '{"event_id": "first", ' + B[1:], None),
    ("null_eid", with_(event_id=None), "required_null"),
    ("null_data", with_(data=None), "required_null"),
    ("eid_num", with_(event_id=7), None),
    ("data_str", with_(data="text"), None),
    ("data_arr", with_(data=[1, 2]), None),
    ("meta_nullver", meta(version=None), "required_null"),
    ("nan", B[:-1] + ', "x": NaN}', "json_syntax"),
    ("bad", "invalid json", "json_syntax"),
    ("empty", "", "json_syntax"),
    ("trail", B + " x", "json_syntax"),
    ("twodocs", B + B, "json_syntax"),
    ("single", B.replace('"', "'"), "json_syntax"),
    ("ctrl", B.replace("dark red", "dark\nred"), "json_syntax"),
    ("bom", "﻿" + B, "json_syntax"),
    ("utf8bad", b"\xff\xfe" + B.encode(), "invalid_utf8"),
    ("arr", "[1]", "not_object"),
    ("str", '"x"', "not_object"),
    ("num", "3", "not_object"),
    ("null", "null", "not_object"),
    ("emptyobj", "{}", "missing_fields"),
    ("no_eid", with_(event_id=KeyError), "missing_fields"),
    ("no_ts", with_(timestamp=KeyError), "missing_fields"),
    ("no_data", with_(data=KeyError), "missing_fields"),
    ("no_meta", with_(metadata=KeyError), "missing_fields"),
    ("ts_num", with_(timestamp=5), "bad_timestamp"),
    ("ts_null", with_(timestamp=None), "bad_timestamp"),
    ("ts_bad", with_(timestamp="yesterday"), "bad_timestamp"),
    ("two_faults", with_(timestamp="yesterday", metadata=[]), "bad_timestamp"),
    ("meta_null", with_(metadata=None), "metadata_not_object"),
    ("meta_list", with_(metadata=["source", "version"]), "metadata_not_object"),
    ("meta_str", with_(metadata="source"), "metadata_not_object"),
    ("meta_nosrc", meta(source=KeyError), "metadata_missing_fields"),
    ("meta_nover", meta(version=KeyError), "metadata_missing_fields"),
    ("stray_close", B + "}", "json_syntax"),
    ("stray_bracket", B + "]", "json_syntax"),
]


def test_truth_table(spark):
    df = messages_df(spark, [c[1] for c in CASES])
    got = {r.message_id: r.reject_reason
           for r in envelope.outcomes(df).select("message_id", "reject_reason").collect()}
    for i, (name, _, expected) in enumerate(CASES):
        assert got[f"m{i}"] == expected, name


def test_duplicate_key_last_wins(spark):
    df = messages_df(spark, ['{"event_id": "first", ' + B[1:]])
    row = envelope.landed(envelope.outcomes(df)).collect()[0]
    assert row.event_id == "ride-0042"


ACCEPT = ["2024-06-09T08:12:59-05:00", "2024-06-09T08:12:59Z", "2025-02-01", "2024-06-09 08:12:59",
          "2025-02-01T18:47", "2025-02-01T18", "2024-06-09T08:12:59.5", "2024-06-09T08:12:59+0500",
          "9999-12-31T23:59:59.999999"]
REJECT = ["", " 2025-02-01", "2025-2-1", "2025", "2025-02", "T12:00", "2025-02-30",
          "2025-02-01T24:00:00", "2025-02-01T12:00:60", "2025-02-01T12:00:00 UTC", "12025-01-01",
          "2025-02-01T", "0000-01-01", "2025-02-01T12:00:00+25:00"]


def test_timestamp_grammar(spark):
    df = spark.createDataFrame([(t,) for t in ACCEPT + REJECT], "t string")
    got = dict(df.select("t", strict_iso_timestamp(F.col("t")).isNotNull().alias("ok")).collect())
    for t in ACCEPT:
        assert got[t], t
    for t in REJECT:
        assert not got[t], t


def test_offset_and_naive_are_utc_instants(spark):
    df = spark.createDataFrame([("2024-06-09T08:12:59-05:00",), ("2024-06-09T13:12:59",)], "t string")
    vals = {r[0] for r in df.select(strict_iso_timestamp(F.col("t")).cast("timestamp_ntz")).collect()}
    assert len(vals) == 1


def test_acceptance_case(spark):
    """Valid, invalid JSON, missing fields: exactly one row out."""
    df = messages_df(spark, [B, "invalid json", '{"invalid": "message"}'])
    out = envelope.apply_transforms(df)
    assert out.count() == 1


def test_duplicates_are_kept(spark):
    df = messages_df(spark, [B, B])
    assert envelope.landed(envelope.outcomes(df)).count() == 2


def test_processing_timestamp_is_publish_time(spark):
    df = messages_df(spark, [B])
    row = envelope.outcomes(df).select("processing_timestamp", "publish_time").collect()[0]
    assert row.processing_timestamp == row.publish_time


def test_fields_preserved(spark):
    df = messages_df(spark, [B])
    ld = envelope.landed(envelope.outcomes(df))
    r = envelope.data_struct(ld, {"colour": "string", "grade": "string"}).collect()[0]
    assert (r.event_id, r.data.colour, r.data.grade, r.metadata.source, r.metadata.version) == (
        "ride-0042", "dark red", "b2", "meter-7", "1.0")


def test_flat_form(spark):
    df = messages_df(spark, [B])
    r = envelope.conform_flat(envelope.landed(envelope.outcomes(df))).collect()[0]
    assert json.loads(r.data) == BASE["data"]


def test_recovery_case_follows_validator(spark):
    """Metadata without version is rejected, whatever the old test claimed."""
    msg = json.dumps({"event_id": "r1", "timestamp": "2025-02-01T18:30:00Z", "data": {},
                      "metadata": {"source": "test"}})
    out = envelope.outcomes(messages_df(spark, [msg])).collect()[0]
    assert out.reject_reason == "metadata_missing_fields"


def test_extra_rule_hook(spark):
    df = messages_df(spark, [B, with_(event_id="blocked")])
    rule = ("blocked_id", envelope.doc_get("event_id", "string") == "blocked")
    got = [r.reject_reason for r in envelope.outcomes(df, [rule]).orderBy("message_id").collect()]
    assert got == [None, "blocked_id"]


@pytest.mark.parametrize("ok", [True, False])
def test_parse_is_evaluated_once(spark, ok):
    df = messages_df(spark, [B if ok else "x"])
    plan = envelope.landed(envelope.outcomes(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_log_fields_override_fixed_fields(spark):
    from spindle.operators import audit

    out = envelope.outcomes(messages_df(spark, ["x"]))
    rows = audit.log_rows(envelope.rejects(out), fields={"severity": "WARNING", "stage": "parsing"}).collect()
    r = rows[0]
    assert (r.severity, r.level, r.reason) == ("WARNING", "warning", "json_syntax")
    assert json.loads(r.log)["stage"] == "parsing" and json.loads(r.log)["severity"] == "WARNING"


def test_perf_payload_shape(spark):
    """Load-generator payload: numeric, category, priority and a list of tags in data."""
    msg = json.dumps({"event_id": "perf-1", "timestamp": "2025-02-01T18:30:00",
                      "data": {"value": 12.5, "category": "B", "priority": 3, "tags": ["t1", "t2"]},
                      "metadata": {"source": "load", "version": "1.0", "test_type": "constant"}})
    ld = envelope.landed(envelope.outcomes(messages_df(spark, [msg])))
    r = envelope.data_struct(ld, {"value": "double", "category": "string", "priority": "int",
                                  "tags": "array<string>"}).collect()[0]
    assert (r.data.value, r.data.category, r.data.priority, r.data.tags) == (12.5, "B", 3, ["t1", "t2"])


def test_whole_text_must_be_one_value(spark):
    inner = json.dumps({k: v for k, v in BASE.items()})
    cases = [(B, None), (inner + ',"\\u0002":0} junk', "json_syntax"), (inner + ',"q":1', "json_syntax"),
             (inner + ',"0"', "json_syntax"), (inner + "],[1", "json_syntax"), (inner + "]", "json_syntax"),
             ("  " + B + "\n", None), ('"x"', "not_object"), ("[1]", "not_object"), ("", "json_syntax")]
    df = messages_df(spark, [c[0] for c in cases])
    got = {r.message_id: r.reject_reason for r in envelope.outcomes(df).collect()}
    for i, (_, expected) in enumerate(cases):
        assert got[f"m{i}"] == expected, cases[i][0]
