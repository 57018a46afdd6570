import pytest
from pyspark.sql import functions as F

from platterwatch.operators.ranking import (
    device_failures,
    device_lists,
    global_top_k,
    group_totals,
    rank_globally,
    rank_groups,
    top_k,
    window_top_k,
)
from platterwatch.operators.rollup import rollup_failures
from platterwatch.operators.shape import rank_lines, rank_wide
from platterwatch.operators.windows import DayWindow, reference_windows
from platterwatch.plans.query2 import query2, query2_rollup

DAY = DayWindow(1)
AT = "2023-04-01T10:00:00"


def failures(counts, at=AT):
    return [
        (at, vault, 1, 20, "M", f"{vault}-{i}") for vault, n in counts.items() for i in range(n)
    ]


def listed(rows):
    return sorted({(r["rank"], r.vault_id, r.group_failures) for r in rows})


def test_rows_without_failure_do_not_count(telemetry):
    df = telemetry([(AT, 1, 0, 20, "M", "a"), (AT, 2, 1, 20, "M", "b")])
    assert listed(window_top_k(df, DAY).collect()) == [(1, 2, 1)]


def test_window_without_failures_has_no_row(telemetry):
    df = telemetry([(AT, 1, 1, 20, "M", "a"), ("2023-04-02T10:00:00", 1, 0, 20, "M", "a")])
    assert [r.window_start.day for r in window_top_k(df, DAY).collect()] == [1]


def test_same_disk_twice_is_listed_once(telemetry):
    df = telemetry([(AT, 7, 1, 20, "M", "a"), ("2023-04-01T11:00:00", 7, 1, 20, "M", "a")])
    (row,) = window_top_k(df, DAY).collect()
    assert (row.group_failures, row.failures, row.n_tuples, row.group_devices) == (2, 2, 2, 1)
    assert row.max_ingest_ts.hour == 11


def test_commas_in_names_do_not_collide(telemetry):
    df = telemetry([(AT, 7, 1, 20, "a,b", "c"), (AT, 7, 1, 20, "a", "b,c")])
    ranked = window_top_k(df, DAY)
    (row,) = device_lists(ranked, 1).collect()
    assert [tuple(h) for h in row.hdds] == [("a", "b,c"), ("a,b", "c")]
    assert ranked.count() == 2


def test_ties_at_the_last_rank_go_to_the_lower_keys(telemetry):
    df = telemetry(failures({v: 1 for v in range(112, 100, -1)}))
    rows = window_top_k(df, DAY).collect()
    assert listed(rows) == [(i + 1, 101 + i, 1) for i in range(10)]


def test_a_null_key_keeps_its_devices(telemetry):
    df = telemetry([(AT, None, 1, 20, "M", "a"), (AT, 3, 1, 20, "M", "b")])
    rows = window_top_k(df, DAY).collect()
    assert {r.vault_id: r.group_devices for r in rows} == {None: 1, 3: 1}
    assert rank_lines(window_top_k(df, DAY), parts=1).first().line == "2023-04-01,,1,(M,a),3,1,(M,b)"


def test_rank_is_per_window_and_global_is_over_all(telemetry):
    df = telemetry(
        failures({1: 3, 2: 2}) + failures({2: 5, 3: 1}, "2023-04-02T00:00:00")
    )
    devices = device_failures(df, DAY)
    rows = rank_groups(devices, k=1).collect()
    assert {(r.window_start.day, r.vault_id, r.group_failures) for r in rows} == {(1, 1, 3), (2, 2, 5)}
    best = rank_globally(devices, k=2).collect()
    assert {(r.group_failures, r.window_start.day, r.vault_id) for r in best} == {(3, 1, 1), (5, 2, 2)}
    assert [r.failures for r in global_top_k(group_totals(devices), 3).collect()] == [5, 3, 2]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_parts_hold_every_device_of_a_hot_group_once(telemetry, parts):
    ranked = window_top_k(telemetry(failures({1: 120, 2: 3})), DAY)
    assert ranked.count() == 123
    hot = [r for r in device_lists(ranked, parts).collect() if r.vault_id == 1]
    serials = [h.serial_number for r in hot for h in r.hdds]
    assert sorted(serials) == sorted(f"1-{i}" for i in range(120))
    assert sum(r.n_tuples for r in hot) == 120
    assert {r.group_failures for r in hot} == {120} and {r["rank"] for r in hot} == {1}
    assert {r.part for r in hot} == set(range(parts))
    lines = rank_lines(ranked, parts).collect()
    assert sum(line.n_tuples for line in lines) == 123
    if parts > 1:
        assert all(line.line.startswith(f"2023-04-01,{line.part},1,1,120,(") for line in lines)


def test_wide_columns_are_those_of_the_rank(telemetry):
    """A group without a device in a part leaves its own columns empty, and no others move."""
    ranked = window_top_k(telemetry(failures({1: 40, 2: 6, 3: 1})), DAY)
    found = {1: [], 2: [], 3: []}
    for row in rank_wide(ranked, parts=8).collect():
        for rank in found:
            assert row[f"vault_id_{rank}"] in ("", str(rank))
            assert (row[f"vault_id_{rank}"] == "") == (row[f"hdds_{rank}"] == [])
            found[rank] += row[f"hdds_{rank}"]
    assert [len(x) for x in found.values()] == [40, 6, 1]


def test_rollup_equals_direct(telemetry):
    rows = []
    for d in range(1, 24):
        rows += failures({v: 1 + (v * d) % 4 for v in range(1, 15)}, f"2023-04-{d:02d}T05:00:00")
    df = telemetry(rows)
    windows = reference_windows()
    together = query2_rollup(df, windows).collect()
    for window in windows:
        want = sorted(map(str, window_top_k(df, window).collect()))
        got = [r.asDict() for r in together if r.window_days == window.days]
        lone = window_top_k(df, window, staged=False).collect()
        assert sorted(map(str, lone)) == want
        assert len(got) == len(want)
        days = device_failures(df, DAY)
        rolled = rollup_failures(days, [window], "vault_id", ["model", "serial_number"])
        again = rank_groups(rolled).drop("window_days").collect()
        assert sorted(map(str, again)) == want


def test_query2_has_a_result_per_window(telemetry):
    assert list(query2(telemetry(failures({1: 1})))) == ["1d", "3d", "23d"]


# One published ranking; its ties are in no order.
LINE = (
    "2023-04-04,1113,3,(HGST HUH721212ALN604,8HK22LZH,HGST HUH721212ALN604,8HK2WZKH,"
    "HGST HUH721212ALN604,8HK68T1H),1066,2,(TOSHIBA MG07ACA14TA,88S0A02AF97G,"
    "TOSHIBA MG07ACA14TA,98B0A00EF97G),1024,1,(HGST HMS5C4040BLE640,PL1331LAH27JDH),"
    "1035,1,(ST8000DM002,ZA12PTHD),1042,1,(ST8000NM0055,ZA139G0S),"
    "1044,1,(ST8000NM0055,ZA15VJHH),1090,1,(ST8000NM0055,ZA1819D6)"
)
DISKS = [
    (1090, "ST8000NM0055", "ZA1819D6"),
    (1113, "HGST HUH721212ALN604", "8HK22LZH"),
    (1066, "TOSHIBA MG07ACA14TA", "88S0A02AF97G"),
    (1024, "HGST HMS5C4040BLE640", "PL1331LAH27JDH"),
    (1113, "HGST HUH721212ALN604", "8HK68T1H"),
    (1042, "ST8000NM0055", "ZA139G0S"),
    (1066, "TOSHIBA MG07ACA14TA", "98B0A00EF97G"),
    (1035, "ST8000DM002", "ZA12PTHD"),
    (1044, "ST8000NM0055", "ZA15VJHH"),
    (1113, "HGST HUH721212ALN604", "8HK2WZKH"),
]


def test_published_line(telemetry):
    df = telemetry([("2023-04-04T01:00:00", v, 1, 20, m, s) for v, m, s in DISKS])
    (row,) = rank_lines(window_top_k(df, DAY), parts=1).collect()
    assert row.line == LINE
    assert row.n_tuples == len(DISKS)


def test_wide_form_is_padded(telemetry):
    df = telemetry(failures({5: 2, 6: 1}))
    (row,) = rank_wide(window_top_k(df, DAY), parts=1).collect()
    assert row.ts == "2023-04-01T00:00:00.000000"
    assert (row.vault_id_1, row.group_failures_1, row.hdds_1) == ("5", 2, ["M,5-0", "M,5-1"])
    assert (row.vault_id_3, row.group_failures_3, row.hdds_3) == ("", 0, [])
    assert len(row) == 2 + 3 * 10


def test_top_k_counts_only_k_rows_per_window(telemetry):
    totals = group_totals(device_failures(telemetry(failures({v: v for v in range(1, 30)})), DAY))
    assert top_k(totals, 4).orderBy("rank").select("vault_id").collect() == [
        (29,), (28,), (27,), (26,)
    ]
    assert top_k(totals, 4).filter(F.col("rank") > 4).count() == 0
