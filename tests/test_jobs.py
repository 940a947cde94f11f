"""Jobs side by side."""

import threading

import pytest

from ledgerweb.functions.jobs import at_once


def test_steps_run_at_once(spark):
    """Each step waits for the other, so one after the other they would never end; results keep the steps' order."""
    meet = threading.Barrier(2, timeout=60)

    def step(n):
        meet.wait()
        return spark.range(n).count()

    assert at_once(spark, lambda: step(3), lambda: step(5)) == [3, 5]


def test_local_properties_go_along(spark):
    spark.sparkContext.setLocalProperty("ledgerweb.test", "own")
    try:
        assert at_once(spark, lambda: spark.sparkContext.getLocalProperty("ledgerweb.test"), lambda: 1) == ["own", 1]
    finally:
        spark.sparkContext.setLocalProperty("ledgerweb.test", None)


def test_errors_come_through(spark):
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: spark.range(2).count(), lambda: 1 // 0)
