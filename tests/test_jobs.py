import glob

import pytest

from platterwatch.__main__ import arguments, main
from platterwatch.operators.parse import line_of
from platterwatch.operators.replay import flush_line, write_replay
from platterwatch.streaming.ranking import latest_rankings
from platterwatch.streaming.sinks import read_lines_written


@pytest.fixture
def lines(telemetry, tmp_path):
    rows = telemetry(
        [
            (f"2023-04-{1 + i % 23:02d}T{i % 24:02d}:00:00", 995 + i % 30, i % 4 == 0, i / 9, "M", f"s{i}")
            for i in range(600)
        ]
    )
    path = str(tmp_path / "in")
    write_replay(rows.select("event_ts", line_of(rows).alias("value")), path, flush=flush_line())
    return path


@pytest.mark.parametrize("number", ["1", "2"])
def test_stream_and_batch_write_the_same_lines(spark, lines, tmp_path, number):
    batch, stream = str(tmp_path / "batch"), str(tmp_path / "stream")
    main([number, "--input", lines, "--output", batch])
    check = str(tmp_path / "check")
    main(
        [number, "--input", lines, "--output", stream, "--stream", "--once", "--checkpoint", check]
        + ["--days", "1", "3", "23", "--max-files", "20"]
    )
    for days in (1, 3, 23):
        got = sorted(r.line for r in read_lines_written(spark, f"{stream}/query_{days}_{number}").collect())
        want = sorted(r.line for r in read_lines_written(spark, f"{batch}/query_{days}_{number}").collect())
        assert got == want and got
        measured = spark.read.json(f"{stream}/query_{days}_{number}_metrics")
        assert measured.agg({"n_tuples": "sum"}).first()[0] > 0


def test_stream_into_one_file_per_window(spark, lines, tmp_path):
    """One growing file, in the order of the windows, with what the batch writes; a second start adds nothing."""
    batch, stream, check = (str(tmp_path / x) for x in ("batch", "stream", "check"))
    main(["1", "--input", lines, "--output", batch, "--days", "3"])
    for _ in range(2):
        main(
            ["1", "--input", lines, "--output", stream, "--stream", "--once", "--checkpoint", check]
            + ["--days", "3", "--max-files", "12", "--sink", "file"]
        )
    got = open(f"{stream}/query_3_1.csv").read().splitlines()
    want = [r.line for r in read_lines_written(spark, f"{batch}/query_3_1").collect()]
    assert sorted(got) == sorted(want) and [x[:10] for x in got] == sorted(x[:10] for x in got)


def test_forms(spark, lines, tmp_path):
    for form in ("documents", "wide"):
        out = str(tmp_path / form)
        main(["2", "--input", lines, "--output", out, "--form", form, "--days", "23"])
        assert glob.glob(f"{out}/query_23_2/*.json")
    wide = spark.read.json(str(tmp_path / "wide" / "query_23_2"))
    assert wide.count() == 1 and "vault_id_10" in wide.columns


def test_live_job_ends_with_the_batch_ranking(spark, lines, tmp_path):
    live, batch = str(tmp_path / "live"), str(tmp_path / "batch")
    common = ["--input", lines, "--form", "documents", "--days", "3"]
    check = str(tmp_path / "check")
    main(["2", *common, "--output", live, "--stream", "--once", "--live", "--checkpoint", check])
    main(["2", *common, "--output", batch])
    want = spark.read.json(f"{batch}/query_3_2")
    got = latest_rankings(spark.read.json(f"{live}/query_3_2"))
    columns = [c for c in want.columns if c != "max_ingest_ts"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, want.select(columns).collect())
    )


def test_rejected_lines_are_written(spark, line, tmp_path):
    at = "2023-04-01T00:00:00.000000"
    source = tmp_path / "in"
    source.mkdir()
    texts = [line(at), line(at, temp=""), line(at, vault="x")]
    (source / "a.txt").write_text("\n".join(texts) + "\n")
    common = ["1", "--input", str(source), "--days", "1"]
    batch, stream = str(tmp_path / "rb"), str(tmp_path / "rs")
    main([*common, "--output", str(tmp_path / "b"), "--rejects", batch])
    main(
        [*common, "--output", str(tmp_path / "s"), "--rejects", stream, "--stream", "--once"]
        + ["--checkpoint", str(tmp_path / "check")]
    )
    for path in (batch, stream):
        got = {r.value: r.unreadable for r in spark.read.json(path).collect()}
        assert got == {texts[1]: "s194_temperature_celsius", texts[2]: "vault_id"}


def test_dataset_replay_feeds_both_queries(spark, line, tmp_path):
    """A dataset stamped at midnight is replayed, streamed and ranked."""
    days = ["2023-04-01", "2023-04-02"]
    rows = [
        line(f"{d}T00:00:00.000000", serial=f"s{i}", vault=str(1000 + i % 3), failure=str(i % 2))
        for d in days
        for i in range(8)
    ]
    source = tmp_path / "dataset.csv"
    source.write_text("\n".join(["date" + "," * 38, *rows]) + "\n")
    replayed = str(tmp_path / "replayed")
    main(["replay", "--input", str(source), "--output", replayed])
    lines = sorted(r.value for r in spark.read.text(replayed).select("value").collect())
    assert [t[:26] for t in lines[:-1]] == [f"{d}T{3 * i:02d}:00:00.000000" for d in days for i in range(8)]
    assert [t[26:] for t in lines[:-1]] == [t[26:] for t in rows]
    for number, want in {"1": 6, "2": 2}.items():
        out, check = str(tmp_path / f"out{number}"), str(tmp_path / f"check{number}")
        args = ["--input", replayed, "--output", out, "--checkpoint", check, "--days", "1"]
        main([number, *args, "--stream", "--once", "--max-files", "1"])
        got = [r.line for r in read_lines_written(spark, f"{out}/query_1_{number}").collect()]
        assert len(got) == want and all(t[:10] in days for t in got)
    assert sum(t.count(",2,(") for t in got) == 2  # one vault a day with two of the four failures


def test_overall_job_ends_with_the_best_of_all_windows(spark, lines, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    common = ["--input", lines, "--form", "documents", "--days", "1", "--top", "4"]
    main(["2", *common, "--output", out, "--stream", "--once", "--overall", "--checkpoint", check])
    got = spark.read.json(f"{out}/query_1_2")
    last = got.agg({"batch_id": "max"}).first()[0]
    ranks = {r["rank"] for r in got.filter(got.batch_id == last).collect()}
    assert ranks == {1, 2, 3, 4}


def test_arguments_are_checked():
    io = ["--input", "i", "--output", "o"]
    for bad in (
        ["1", "--output", "o"], ["1", *io, "--stream"], ["3"], ["1", "--input", "i"],
        ["replay", *io, "--kafka", "h"], ["replay", "--input", "i"], ["2", *io, "--live"],
        ["2", *io, "--stream", "--checkpoint", "c", "--live", "--overall"],
        ["1", *io, "--stream", "--checkpoint", "c", "--overall"],
        ["1", *io, "--stream", "--checkpoint", "c", "--sink", "collection"],
    ):
        with pytest.raises(SystemExit):
            arguments(bad)


def test_kafka_arguments():
    args = arguments(["replay", "--input", "i", "--kafka", "h:1", "--kafka-option", "a", "b"])
    assert dict(args.kafka_option) == {"a": "b"} and args.output is None


def test_day_precision_and_batch_metrics(spark, lines, tmp_path):
    plain, cut = str(tmp_path / "plain"), str(tmp_path / "cut")
    for out, more in ((plain, []), (cut, ["--day-precision"])):
        main(["1", "--input", lines, "--output", out, "--days", "1", *more])
        assert spark.read.json(f"{out}/query_1_1_metrics").count() > 0
    read = lambda out: sorted(r.line for r in read_lines_written(spark, f"{out}/query_1_1").collect())
    assert read(plain) == read(cut)
