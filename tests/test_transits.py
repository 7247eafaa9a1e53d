import pytest

from tests.conftest import HOUR, rows_of
from tidemark.operators import tracks, transits

SCHEMA = "imo long, mmsi long, dt_pos_utc timestamp, Name string, sog double, draught double"
P, A = "Pacific Anchorage", "Atlantic Anchorage"
NORTH = [(P, 0), ("Pacific Access", 2), ("Miraflores Locks Original", 4), ("Gatun Locks Original", 8),
         ("Atlantic Access", 10), (A, 12)]


def rows(stops, imo=1, mmsi=9, start=0, draught=5.0):
    return [(imo, mmsi, start + int(h * HOUR), n, 1.0, draught) for n, h in stops]


def tagged(frame, data):
    return tracks.with_ship(frame(SCHEMA, data))


def table(frame, data, **kw):
    visits = transits.transit_visits(transits.segments(tagged(frame, data)), kw.pop("strict_locks", False))
    return transits.transits(visits, **kw)


@pytest.mark.parametrize("imo", [1, None])
def test_northbound_transit(frame, imo):
    got = table(frame, rows(NORTH, imo))
    assert rows_of(got, "imo", "mmsi", "flag", "lock_in", "lock_out", "anchoring_in", "direction", "neo_transit",
                   "direct_transit", "draught") == [
        (imo, 9, 1, 4 * HOUR, 8 * HOUR, 0, "North", 0, 1, 5.0),
        (imo, 9, 1, 4 * HOUR, 8 * HOUR, 12 * HOUR, "North", 0, 1, 5.0),
    ]
    assert table(frame, rows(NORTH, imo), one_row=True).count() == 1


def test_segment_breaks_at_exactly_72_hours(frame):
    data = rows([(P, 0), (P, 72), (P, 72 + 72 - 1 / 3600)])
    assert [r[1] for r in rows_of(transits.transit_segments(tagged(frame, data)), "dt_pos_utc", "segr")] == [0, 1, 1]


def test_only_the_first_row_of_the_closing_anchorage_belongs(frame):
    data = rows([*NORTH, (A, 13), (A, 14)])
    got = transits.transit_candidates(tagged(frame, data))
    assert max(r[0] for r in rows_of(got, "dt_pos_utc")) == 12 * HOUR


def test_a_port_between_equal_anchorages_removes_the_first(frame):
    data = rows([(P, 0), ("MIT", 1), (P, 2), ("Pacific Access", 3), (A, 4)])
    left = transits.transit_port_filter(transits.segments(tagged(frame, data)))
    assert rows_of(left, "seg_start") == [(2 * HOUR,), (4 * HOUR,)]
    # A port before the first anchor counts too, as the count starts at the track's beginning.
    early = rows([("MIT", 0), (P, 1), ("Pacific Access", 2), (P, 3), (A, 4)])
    left = transits.transit_port_filter(transits.segments(tagged(frame, early)))
    assert rows_of(left, "seg_start") == [(3 * HOUR,), (4 * HOUR,)]


def pair_starts(frame, stops):
    pairs = transits.transit_pairs(transits.segments(tagged(frame, rows(stops))))
    return [r[0] // HOUR for r in rows_of(pairs, "seg_start")]


def test_runs_longer_than_two_need_a_wait_over_96_hours(frame):
    other = ("Pacific Access", 0)

    def run(*hours):
        stops = []
        for i, h in enumerate(hours):
            stops += [((P, A)[i % 2], h), (other[0], h + 0.5)]
        return stops

    assert pair_starts(frame, run(0, 10)) == [0, 10]
    assert pair_starts(frame, run(0)) == []
    assert pair_starts(frame, run(0, 10, 20)) == []
    assert pair_starts(frame, run(0, 106, 116)) == [106, 116]  # 106 h > 96 h: the first goes
    assert pair_starts(frame, run(0, 97, 110)) == [97, 110]
    assert pair_starts(frame, run(0, 96, 110)) == []


def test_two_pairs_after_a_72_hour_break(frame):
    stops = [(P, 0), ("Pacific Access", 1), (A, 5), (A, 5 + 72), ("Atlantic Access", 80), (P, 90)]
    flags = transits.transit_flags(transits.segments(tagged(frame, rows(stops))))
    assert rows_of(flags, "flag", "open_zone") == [(1, P), (3, A)]


def test_one_lock_counts_unless_strict(frame):
    one = [(n, h) for n, h in NORTH if n != "Gatun Locks Original"]
    assert table(frame, rows(one)).count() == 2
    assert table(frame, rows(one), strict_locks=True).count() == 0
    neo = [(P, 0), ("Pacific Access", 1), ("Cocoli Locks", 2), (A, 5)]
    assert {r[0] for r in rows_of(table(frame, rows(neo)), "neo_transit")} == {1}


def test_access_is_required(frame):
    assert table(frame, rows([(n, h) for n, h in NORTH if "Access" not in n])).count() == 0


def test_stop_makes_a_transit_indirect_without_imo_too(frame):
    for imo in (1, None):
        got = table(frame, rows(sorted([*NORTH, ("Gatun Anchorage", 6)], key=lambda s: s[1]), imo))
        assert {r[0] for r in rows_of(got, "direct_transit")} == {0}


def test_draught_ties_and_nulls(frame):
    locks = [("Miraflores Locks Original", 4 + i / 10) for i in range(4)]
    base = [(n, h) for n, h in NORTH if "Miraflores" not in n and "Gatun" not in n]
    data = rows(base) + [
        (1, 9, int(h * HOUR), n, 1.0, d) for (n, h), d in zip(locks, (7.0, 6.0, None, None))]
    assert {r[0] for r in rows_of(table(frame, data), "draught")} == {6.0}


def test_mmsi_change_splits_the_identity_but_not_the_track(frame):
    data = rows(NORTH[:3], mmsi=9) + rows(NORTH[3:], mmsi=10)
    got = table(frame, data)
    assert rows_of(got, "mmsi", "flag", "lock_in") == [(9, 1, 4 * HOUR), (10, 1, 8 * HOUR)]
    mid = rows([(P, 0), ("Pacific Access", 1), ("Cocoli Locks", 2)], mmsi=9) + rows([("Cocoli Locks", 3), (A, 5)], mmsi=10)
    got = table(frame, mid)
    assert rows_of(got, "mmsi", "lock_in", "lock_out") == [(9, 2 * HOUR, 2 * HOUR), (10, 3 * HOUR, 3 * HOUR)]
