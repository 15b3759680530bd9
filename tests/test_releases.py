"""Tables that several places show together."""

from dataclasses import replace

import pytest
from pyspark.errors import PySparkException

from feedmill.sources import releases
from feedmill.sources.releases import (
    Place, attempt, point, pointers, publish_together, published, read_published, sweep_releases, write_release,
)
from feedmill.sources.scratch import children


@pytest.fixture
def places(tmp_path):
    return [Place(str(tmp_path / "a")), Place(str(tmp_path / "b"), "json")]


def tables(spark, count):
    return {"x": spark.range(count), "y": spark.range(count * 2)}


def shown(spark, places):
    return [read_published(spark, place, name, "id bigint").count() for place in places for name in ("x", "y")]


def test_nothing_is_shown_before_the_first_release(spark, places):
    assert published(spark, places[0]) is None
    with pytest.raises(ValueError):
        read_published(spark, places[0], "x")
    assert sweep_releases(spark, places[0]) == 0


def test_a_failing_place_leaves_the_old_release_everywhere(spark, places):
    publish_together(tables(spark, 3), places)
    broken = [places[0], replace(places[1], options={"compression": "unknown"})]
    with pytest.raises(PySparkException):
        publish_together(tables(spark, 5), broken, attempts=2)
    assert shown(spark, places) == [3, 6, 3, 6]
    publish_together(tables(spark, 5), places)
    assert shown(spark, places) == [5, 10, 5, 10]
    assert sweep_releases(spark, places[0], kept=1) == 2  # the first one, and what the failure left
    assert shown(spark, places) == [5, 10, 5, 10]


def test_a_crash_between_pointers_is_made_good(spark, places, monkeypatch):
    publish_together(tables(spark, 3), places)
    release = write_release(tables(spark, 4), places)
    assert shown(spark, places) == [3, 6, 3, 6]
    point(spark, places[:1], release)  # here the job ended
    point(spark, places, release)
    assert shown(spark, places) == [4, 8, 4, 8]
    assert [len(pointers(spark, place)) for place in places] == [2, 2]  # none was written twice


def test_an_unfinished_pointer_is_passed_over(spark, places):
    release = publish_together(tables(spark, 3), places)
    (spark.range(1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{places[0].root}/pointer-2")
    assert published(spark, places[0]) == release
    newer = publish_together(tables(spark, 4), places)
    assert published(spark, places[0]) == newer
    assert "pointer-3" in children(spark, places[0].root)


def test_readers_keep_their_release(spark, places):
    publish_together(tables(spark, 3), places)
    before = read_published(spark, places[0], "x")
    publish_together(tables(spark, 4), places)
    assert before.count() == 3
    with pytest.raises(ValueError):
        sweep_releases(spark, places[0], kept=0)


def test_attempts():
    calls = []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise OSError

    attempt(3, action)
    assert len(calls) == 3
    with pytest.raises(OSError):
        calls.clear()
        attempt(2, action)


def test_tables_are_computed_once(spark, places):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 10, 1, 2).rdd.map(lambda row: (seen.add(1), row)[1]).toDF("id bigint")
    releases.publish_together({"x": rows}, places)
    assert seen.value == 10
