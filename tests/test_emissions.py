import pytest
from pyspark.sql import functions as F

from checks import fixture_view as fx
from tidemark.functions import constants as K
from tidemark.operators import emissions as em
from tidemark.operators import phase, specs, zones
from tidemark.sources import results

PHASE = "id long, sog double, load double, StandardVesselType string, coast5 boolean, port1 boolean, port5 boolean"


def test_phase_edges(frame):
    cases = [
        (1.0, 0.5, "Cruise", False, False, True, K.BERTH), (1.0, 0.5, "Cruise", False, False, False, K.ANCHORAGE),
        (1.01, 0.5, "Cruise", False, False, True, K.ANCHORAGE), (3.0, 0.5, "Cruise", True, True, True, K.ANCHORAGE),
        (5.0, 0.5, "Cruise", True, False, False, K.MANOEUVRING), (5.0, 0.5, "Cruise", False, False, True, K.MANOEUVRING),
        (5.0, 0.65, "Cruise", False, False, False, K.SLOW_TRANSIT), (5.0, None, "Cruise", False, False, False, K.NORMAL_CRUISING),
        (5.01, 0.66, "Cruise", False, False, True, K.NORMAL_CRUISING), (9.0, 0.5, "Cruise", False, True, True, K.MANOEUVRING),
        (9.0, 0.5, "Oil tanker", False, True, True, K.SLOW_TRANSIT), (9.0, 0.5, "Oil tanker", False, True, False, K.MANOEUVRING),
        (9.0, 0.5, None, False, True, True, K.MANOEUVRING), (None, 0.5, "Cruise", True, True, True, None),
    ]
    df = frame(PHASE, [(i, *c[:6]) for i, c in enumerate(cases)])
    got = [r["op_phase"] for r in phase.op_phase(df).orderBy("id").collect()]
    assert got == [c[6] for c in cases]


def test_zero_service_speed_gives_no_load(frame):
    df = phase.with_load(frame("sog double, Speed double", [(5.0, 0.0), (5.0, 10.0)]))
    assert sorted(r["load"] or -1 for r in df.collect()) == [-1, 0.5]


@pytest.mark.parametrize("power, ae, ab", [(150.0, 0.0, 0.0), (150.5, 4.0, 8.0), (151.0, 15.1, 8.0), (500.0, 50.0, 8.0), (501.0, 4.0, 8.0)])
def test_auxiliary_power_bands(frame, power, ae, ab):
    names = [f"{p}_{s}" for p in ("ae", "ab") for s in ("sea", "berth", "man", "anch")]
    df = frame("Powerkwmax double, freq double, op_phase string" + "".join(f", {n} double" for n in names),
               [(power, 2.0, K.ANCHORAGE, 9.0, 9.0, 9.0, 2.0, 9.0, 9.0, 9.0, 4.0)])
    row = em.aux_energy(df).first()
    assert (row["ae_ene"], row["ab_ene"]) == (pytest.approx(ae), ab)


@pytest.mark.parametrize("load, ch4", [
    (0.0199, 21.18), (0.02, 2.18), (0.1, 2.18), (0.10005, 0.5), (0.1001, 1.0), (0.2, 1.0), (0.21, 0.5)])
def test_low_load_numbers_replace_or_scale(frame, load, ch4):
    cols = ["load", "me_ene", "ae_ene", "ab_ene", "ef_ch4", "ef_ch4_ae", "ef_ch4_ab", "ef_n2o", "ef_n2o_ae", "ef_n2o_ab"]
    df = frame(", ".join(f"{c} double" for c in cols), [(load, 1.0, 0.0, 0.0, 0.5, 0.0, 0.0, 0.5, 0.0, 0.0)])
    assert em.ch4_n2o(df).first()["ch4_g"] == pytest.approx(ch4)
    scaled = ch4 if ch4 == 0.5 else ch4 * 0.5
    assert em.ch4_n2o(df, multiply=True).first()["ch4_g"] == pytest.approx(scaled)


def test_build_year_of_bad_text_is_null(frame):
    df = frame("DateOfBuild string", [("1984-05",), ("n/a",), (None,)])
    assert sorted(str(r[0]) for r in df.select(em.build_year()).collect()) == ["1984", "None", "None"]


def test_layers_with_several_ids_do_not_multiply(spark, frame):
    df = frame("id long, mmsi long, dt_pos_utc timestamp, H3_int_4 long, H3_int_8 long",
               [(1, 1, 0, fx.ZONE_NUMBER["MIT"], 100 * fx.ZONE_NUMBER["MIT"])])
    row = zones.near_coast_port(df, *fx.layers(spark)).collect()
    assert len(row) == 1 and row[0]["port5"] and row[0]["port1"]


def test_unpivot_keeps_the_sum_and_merge_adds(frame):
    wide = frame("year int, month int, StandardVesselType string, h3resolution int, resolution_id long, co2_t double, ch4_t double, n2o_t double",
                 [(2024, 1, None, 6, 1, 1.0, 2.0, 3.0), (2024, 1, "Cruise", 6, 1, 4.0, 5.0, 6.0)])
    long = em.unpivot_emissions(wide, ["year", "month", "StandardVesselType", "h3resolution", "resolution_id"])
    assert long.agg(F.sum("emission_value")).first()[0] == 21.0
    merged = results.merge_emissions(long, long)
    assert merged.count() == 6 and merged.agg(F.sum("emission_value")).first()[0] == 42.0


def test_version_join_edges(spark, frame):
    day = 86400
    df = frame("mmsi long, dt_pos_utc timestamp", [(1, 31 * day - 1), (1, 31 * day), (1, 400 * day)])
    got = specs.version_join(df, fx.versions(spark)).orderBy("dt_pos_utc").collect()
    assert [r["version"] for r in got] == ["2024A", "2024B", None]


def test_missing_columns_are_named(frame):
    with pytest.raises(specs.MissingColumns, match="length"):
        specs.distinct_ships(frame("imo long, mmsi long", [(1, 2)]))
