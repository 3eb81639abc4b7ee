"""Scoped session settings."""

from __future__ import annotations

from tablekeep.session import scoped_conf

KEY = "spark.sql.files.maxPartitionBytes"


def test_overlapping_blocks_restore_the_value_from_before(spark):
    before = spark.conf.get(KEY)
    first, second = scoped_conf(spark, {KEY: "1000"}), scoped_conf(spark, {KEY: "2000"})
    first.__enter__()
    second.__enter__()
    assert spark.conf.get(KEY) == "2000"
    first.__exit__(None, None, None)  # ends before the block that began later
    assert spark.conf.get(KEY) == "2000"
    second.__exit__(None, None, None)
    assert spark.conf.get(KEY) == before


def test_nested_blocks_and_unset_values(spark):
    key = "tablekeep.test.unset"
    with scoped_conf(spark, {KEY: "1000", key: "a"}):
        with scoped_conf(spark, {KEY: "2000"}):
            assert spark.conf.get(KEY) == "2000"
        assert (spark.conf.get(KEY), spark.conf.get(key)) == ("1000", "a")
    assert spark.conf.get(key, None) is None
