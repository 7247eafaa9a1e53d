from pyspark.sql import functions as F

from tests.conftest import HOUR, rows_of
from tidemark.functions import constants as K
from tidemark.operators import ports, tracks

SCHEMA = "imo long, mmsi long, dt_pos_utc timestamp, Name string, sog double"
DAY = 24 * HOUR


def tagged(frame, rows):
    return tracks.with_identity(frame(SCHEMA, rows))


def port(t, name="MIT", imo=1):
    return (imo, 7, t, name, 0.5)


def drift(t, imo=1):
    return (imo, 7, t, None, 2.0)


def test_port_gap_of_a_day_merges_and_one_second_more_splits(frame):
    rows = [port(0), port(DAY), port(2 * DAY + 1), port(2 * DAY + 1 + HOUR)]
    got = ports.port_events(tagged(frame, rows))
    assert rows_of(got, "port_group_id", "port_start", "port_end") == [
        (1, 0, DAY), (2, 2 * DAY + 1, 2 * DAY + 1 + HOUR)]


def test_first_group_of_one_row_keeps_its_number(frame):
    rows = [port(0), port(60, "CCT"), port(60 + HOUR, "CCT")]
    groups = ports.port_groups(tagged(frame, rows))
    assert rows_of(groups, "dt_pos_utc", "group_id") == [(0, 1), (60, 2), (60 + HOUR, 2)]
    assert rows_of(ports.port_events(tagged(frame, rows)), "port_group_id", "port_name") == [(2, "CCT")]


def test_anchorage_gap_of_an_hour_merges(frame):
    got = ports.anchorage_events(tagged(frame, [drift(0), drift(HOUR), drift(2 * HOUR + 1)]))
    assert rows_of(got, "anchorage_group_id", "anch_start", "anch_end") == [(1, 0, HOUR), (2, 2 * HOUR + 1, 2 * HOUR + 1)]


def test_link_needs_an_anchorage_right_before_within_an_hour(frame):
    for wait, linked in ((HOUR, True), (HOUR + 1, False)):
        rows = [drift(0), drift(100), port(100 + wait), port(100 + wait + HOUR)]
        for imo in (1, None):
            df = tagged(frame, [(imo, *r[1:]) for r in rows])
            got = ports.port_calls(df)
            want = (1, 0, 100) if linked else (None, None, None)
            assert rows_of(got, "anchorage_group_id", "anch_start", "anch_end") == [want]
            links = ports.anch_port_links(ports.event_sequence(ports.stay_events(df)))
            assert links.count() == int(linked)


def test_visits_start_after_a_long_gap_or_when_an_anchorage_follows_a_port(frame):
    a, p = "Atlantic Anchorage", "MIT"
    rows = [(1, 7, t, n, 0.5) for t, n in (
        (0, a), (HOUR, p), (2 * HOUR, a), (2 * HOUR + 72 * HOUR - 1, p), (2 * HOUR + 144 * HOUR - 1, p))]
    got = ports.number_visits(frame(SCHEMA, rows))
    assert [r[1] for r in rows_of(got, "dt_pos_utc", "flag")] == [0, 0, 1, 1, 2]
    kept = ports.port_stops_cutoff(frame(SCHEMA, rows))
    assert [r[1] for r in rows_of(kept, "dt_pos_utc", "flag")] == [0, 0, 1, 1]


STOP = "mmsi long, flag long, dt_pos_utc timestamp, segr long, op_phase string, Name string"


def test_segment_merge_boundary_row_and_whole_run(frame):
    rows = [(7, 0, t, s, K.ANCHORAGE, "A") for t, s in ((0, 1), (60, 1), (120, 2), (180, 2), (240, 3), (300, 3))]
    df = frame(STOP, rows)
    assert [r[1] for r in rows_of(ports.merge_stop_segments(df, K.ANCHORAGE, K.BERTH), "dt_pos_utc", "segr")] == [1, 1, 1, 2, 2, 3]
    assert [r[1] for r in rows_of(ports.merge_stop_islands(df, K.ANCHORAGE, K.BERTH), "dt_pos_utc", "segr")] == [1] * 6


def test_berths_list_all_waits_or_the_nearest(frame):
    a, b = K.ANCHORAGE, K.BERTH
    rows = [(7, 0, t, s, ph, n) for t, s, ph, n in (
        (0, 1, a, "A"), (10, 1, a, "A"), (20, 2, b, "MIT"), (30, 3, a, "A"), (40, 3, a, "A"), (50, 4, b, "CCT"), (60, 4, b, "CCT"))]
    df = frame(STOP, rows)
    every = ports.berth_anchorage(df)
    cols = ("berth_min_dt_pos_utc", "anchorage_min_dt_pos_utc", "anchorage_max_dt_pos_utc")
    assert rows_of(every, *cols) == [(20, 0, 10), (20, 30, 30), (50, 0, 10), (50, 30, 30)]
    assert rows_of(ports.berth_anchorage_nearest(df), *cols) == [(20, 0, 10), (50, 30, 40)]
    assert rows_of(ports.visit_name(df), "mode_name") == [("MIT",)]
    assert rows_of(ports.visit_name(df, mode=True), "mode_name") == [("CCT",)]


def test_null_speed_is_in_no_class(frame):
    df = tagged(frame, [(1, 7, 0, "MIT", None), (1, 7, 5, None, None)])
    assert ports.slow_rows(df).filter(F.lit(True)).count() == 0
