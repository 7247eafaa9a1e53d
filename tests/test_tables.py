"""Reference tables from CSV."""

import pytest

from checks import fixture_view as fx
from tests.conftest import rows_of
from tidemark.sources import tables
from tidemark.sources.durable import scratch_path

DECLARED = tables.Declared("meType string, fuel string, ef double", ("meType", "fuel"))


def written(tmp_path, text):
    path = tmp_path / "table.csv"
    path.write_text(text)
    return str(path)


def test_a_good_table(spark, tmp_path):
    path = written(tmp_path, 'meType,fuel,ef\nSSD,HFO,3.1\n"MS,D",HFO,\n')
    assert rows_of(tables.read_csv_table(spark, path, DECLARED), "meType", "fuel", "ef") == [("MS,D", "HFO", None), ("SSD", "HFO", 3.1)]
    path = written(tmp_path, "meType;fuel;ef\nSSD;HFO;3.1\n")
    assert tables.read_csv_table(spark, path, DECLARED, ";").count() == 1
    assert tables.read_csv_table(spark, written(tmp_path, "meType,fuel,ef\n"), DECLARED).count() == 0


@pytest.mark.parametrize("text, message", [
    ("meType,fuel,ef\nSSD,HFO,much\nMSD,HFO,1\n", "do not fit: SSD,HFO,much"),
    ("meType,fuel,ef\nSSD,HFO,1,2\n", "do not fit"),
    ("meType,fuel,ef\nSSD\n", "do not fit"),
    ("fuel,meType,ef\nHFO,SSD,1\n", "header names fuel, meType, ef, not meType, fuel, ef"),
    ("meType,fuel,ef\nSSD,HFO,1\nMSD,HFO,1\nSSD,HFO,2\n", "more than one row for SSD, HFO"),
    ("meType,fuel,ef\nSSD,,1\n", "without meType or fuel"),
])
def test_what_is_refused(spark, tmp_path, text, message):
    with pytest.raises(tables.TableError, match=message):
        tables.read_csv_table(spark, written(tmp_path, text), DECLARED)


def test_declared_tables_are_those_that_the_model_takes(spark):
    factors = fx.factors(spark)
    for name, declared in tables.FACTORS.items():
        table = getattr(factors, name)
        path = f"{scratch_path(spark, 'factors')}/{name}.csv"
        table.coalesce(1).write.option("header", True).csv(path)
        assert sorted(map(repr, tables.read_csv_table(spark, path, declared).collect())) == sorted(map(repr, table.collect()))
