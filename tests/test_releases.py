"""Tables that change over together, whatever step fails."""

import datetime as dt
import os

import pytest
from conftest import rows

from refinery.schemas import INT, STRING, table
from refinery.sinks import releases, tables

SCHEMAS = {"one": table(id=INT, t=STRING), "two": table(id=INT, year=INT, month=INT)}
NOW = dt.timedelta(0)


def write(spark, root, run, value):
    tables.write_files(spark.createDataFrame([(value, str(value))], SCHEMAS["one"]), releases.folder(root, "one", run))
    months = [(value, 2020, 1), (value, 2021, 2), (value, None, None)]
    tables.write_by_month(spark.createDataFrame(months, SCHEMAS["two"]), releases.folder(root, "two", run))


def publish(spark, database, root, run, **settings):
    releases.publish(spark, database, root, run, SCHEMAS, {"two": ["year", "month"]}, **settings)


@pytest.fixture
def place(spark, tmp_path):
    database = f"releases_{tmp_path.name}"
    yield database, f"{tmp_path}/db"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def ids(spark, database):
    return [{row.id for row in spark.table(f"{database}.{name}").collect()} for name in SCHEMAS]


def test_all_tables_change_over_together(spark, place):
    for value in (1, 2, 3):
        run = releases.new_run()
        write(spark, place[1], run, value)
        publish(spark, *place, run)
        assert ids(spark, place[0]) == [{value}, {value}] and releases.current(spark, place[0]) == run
    two = spark.table(f"{place[0]}.two")
    assert two.schema.simpleString() == SCHEMAS["two"].simpleString()
    assert rows(two) == [(3, 2020, 1), (3, 2021, 2), (3, None, None)] or two.count() == 3


@pytest.mark.parametrize("step", ["_register", "_read_by_name", "_log"])
@pytest.mark.parametrize("calls", [0, 1])
def test_a_failure_between_any_two_steps_leaves_the_run_before(spark, place, monkeypatch, step, calls):
    first, second = releases.new_run(), releases.new_run()
    write(spark, place[1], first, 1)
    publish(spark, *place, first)
    write(spark, place[1], second, 2)
    done, real = [], getattr(releases, step)

    def fails(*args):
        if len(done) == (calls if step != "_log" else 0):
            raise OSError("lost")
        done.append(args)
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(releases, step, fails)
        with pytest.raises(OSError, match="lost"):
            publish(spark, *place, second)
    assert ids(spark, place[0]) == [{1}, {1}]
    publish(spark, *place, second)
    assert ids(spark, place[0]) == [{2}, {2}]


def test_a_missing_table_is_not_published(spark, place):
    first, second = releases.new_run(), releases.new_run()
    write(spark, place[1], first, 1)
    publish(spark, *place, first)
    tables.write_files(spark.createDataFrame([(2, "2")], SCHEMAS["one"]), releases.folder(place[1], "one", second))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        publish(spark, *place, second)
    assert ids(spark, place[0]) == [{1}, {1}]


def test_other_columns_or_files_are_an_error(spark, place, tmp_path):
    run = releases.new_run()
    write(spark, place[1], run, 1)
    publish(spark, *place, run)
    with pytest.raises(ValueError, match="another schema"):
        releases.publish(spark, *place, run, {"one": table(id=INT, u=INT)})
    write(spark, f"{tmp_path}/else", run, 1)
    with pytest.raises(ValueError, match="over other files"):
        publish(spark, place[0], f"{tmp_path}/else", run)


def test_old_runs_are_removed_by_the_rule(spark, place):
    runs = [releases.new_run() for _ in range(4)]
    for value, run in enumerate(runs[:3]):
        write(spark, place[1], run, value)
        publish(spark, *place, run, keep=2, grace=dt.timedelta(days=1))
    write(spark, place[1], runs[3], 9)  # never published
    folders = lambda: {name.removeprefix("run=") for name in os.listdir(f"{place[1]}/one")}
    assert folders() == set(runs)
    assert releases.reclaim(spark, *place, SCHEMAS, keep=2, grace=NOW) == sorted([runs[0], runs[3]])
    assert folders() == set(runs[1:3]) and ids(spark, place[0]) == [{2}, {2}]
    assert releases.reclaim(spark, *place, SCHEMAS, keep=0, grace=NOW) == [runs[1]]
    assert ids(spark, place[0]) == [{2}, {2}]


def test_only_the_run_that_is_read_is_scanned(spark, place):
    for value in (1, 2):
        run = releases.new_run()
        write(spark, place[1], run, value)
        publish(spark, *place, run)
    one = spark.table(f"{place[0]}.one")
    assert rows(one) == [(2, "2")]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in scan
