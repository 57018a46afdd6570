from datetime import datetime

import pytest
from pyspark.sql import functions as F

from platterwatch import schema
from platterwatch.operators.parse import (
    not_header,
    parse_telemetry,
    rejected_rows,
    to_lines,
    valid_rows,
)
from platterwatch.operators.replay import flush_line
from platterwatch.sources.lines import dataset_lines, read_dataset, read_lines

GOOD = "2023-04-01T12:34:56.123456"


def lines_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_good_line(spark, line):
    df = valid_rows(parse_telemetry(lines_of(spark, [line(GOOD, model="HGST HUH7", failure="1")])))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schema.TELEMETRY
    ]
    (row,) = df.collect()
    assert row.event_ts == datetime(2023, 4, 1, 12, 34, 56, 123456)
    assert (row.model, row.failure, row.vault_id) == ("HGST HUH7", 1, 1000)
    assert row.s194_temperature_celsius == 20.5 and row.ingest_ts is not None


def bad_lines(line):
    return {
        "date,serial_number,model,failure,vault_id" + "," * 34: "header",
        line(GOOD, temp=""): "s194_temperature_celsius",
        ",".join(line(GOOD).split(",")[:20]): "s194_temperature_celsius",
        line(GOOD, vault="x"): "vault_id",
        line(GOOD, vault="1.5"): "vault_id",
        line(GOOD, failure=""): "failure",
        line("2023-04-01"): "event_ts",
        line("2023-04-01T12:34:56.12345"): "event_ts",
        line("2023-13-01T12:34:56.123456"): "event_ts",
        line("2023-04-01T12:34:56.12345Z"): "event_ts",
        line("2023-02-30T12:34:56.123456"): "event_ts",
        "": "all",
    }


def test_bad_lines_are_kept_aside_with_reasons(spark, line):
    bad = bad_lines(line)
    parsed = parse_telemetry(lines_of(spark, [*bad, line(GOOD)]))
    assert valid_rows(parsed).count() == 1
    rejected = {r.value: r.unreadable for r in rejected_rows(parsed).collect()}
    assert rejected.keys() == bad.keys()
    for text, reason in bad.items():
        if reason not in ("header", "all"):
            assert rejected[text] == reason


def test_null_line_is_rejected(spark):
    parsed = parse_telemetry(spark.createDataFrame([(None,)], "value string"))
    assert (valid_rows(parsed).count(), rejected_rows(parsed).count()) == (0, 1)


def test_header_filter(spark, line):
    df = lines_of(spark, ["date,serial_number", line(GOOD)])
    assert df.filter(not_header()).count() == 1


def test_day_precision(spark, line):
    parsed = parse_telemetry(lines_of(spark, [line(GOOD)]), day_precision=True)
    assert valid_rows(parsed).first().event_ts == datetime(2023, 4, 1)


def test_source_timestamp_is_the_ingest_time(spark, line):
    lines = lines_of(spark, [line(GOOD)]).withColumn(
        "timestamp", F.lit("2024-05-06 07:08:09").cast("timestamp")
    )
    assert valid_rows(parse_telemetry(lines)).first().ingest_ts == datetime(2024, 5, 6, 7, 8, 9)


def test_lines_round_trip(spark, line):
    texts = [line(GOOD, serial=f"s{i}", vault=str(i)) for i in range(5)]
    again = to_lines(valid_rows(parse_telemetry(lines_of(spark, texts)))).collect()
    assert sorted(r.value for r in again) == sorted(texts)
    assert all(len(t.split(",")) == schema.LINE_FIELDS for t in texts)


def test_flush_line_is_valid(spark):
    # Fixed value: the closing line of the wire format.
    text = "2023-04-26T00:00:00.000000,UNKNOWN,UNKNOWN,0,0" + "," * 21 + "0.0" + "," * 13
    assert flush_line() == text
    assert valid_rows(parse_telemetry(lines_of(spark, [text]))).count() == 1


def test_dataset_scan(spark, line, tmp_path):
    names = ["date", "serial_number", "model", "failure", "vault_id"]
    header = ",".join(names + [f"attribute {i}" for i in range(5, schema.LINE_FIELDS)])
    quoted = line(GOOD, serial="s2").replace("s2", '"s2"')
    (tmp_path / "a.csv").write_text("\n".join([header, line(GOOD), quoted]) + "\n")
    lines = dataset_lines(read_dataset(spark, str(tmp_path / "a.csv")))
    assert sorted(r.value for r in lines.collect()) == [line(GOOD), line(GOOD, serial="s2")]
    assert read_lines(spark, str(tmp_path)).count() == 2


@pytest.mark.parametrize("value", ["NaN", "1e3", "-4.5"])
def test_numbers_as_text(spark, line, value):
    assert valid_rows(parse_telemetry(lines_of(spark, [line(GOOD, temp=value)]))).count() == 1


def test_filters_do_not_repeat_the_split(spark, line):
    df = valid_rows(parse_telemetry(lines_of(spark, [line(GOOD)])))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
