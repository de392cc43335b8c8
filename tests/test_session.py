from weir.session import (
    ADAPTIVE_SETTINGS,
    INITIAL_PARTITIONS,
    SIZED_BY_US,
    apply_runtime_settings,
    size_shuffles,
)


def test_settings_keep_what_the_user_chose(spark, settings):
    settings(spark__sql__adaptive__skewJoin__enabled="false", spark__sql__session__timeZone="Asia/Tokyo")
    apply_runtime_settings(spark)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    for key in ADAPTIVE_SETTINGS:
        assert key in spark.conf.getAll


def test_shuffles_grow_with_the_input(spark, settings):
    settings(spark__sql__shuffle__partitions=4)
    assert size_shuffles(spark, 10_000_000) == 4
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    try:
        assert size_shuffles(spark, 2**40) == 4096
        assert size_shuffles(spark, 10_000_000) == 4096
        assert size_shuffles(spark, 100 * 2**40) == 409_600  # no ceiling
        spark.conf.set(INITIAL_PARTITIONS, "77")
        assert size_shuffles(spark, 2**50) == 77
    finally:
        spark.conf.unset(INITIAL_PARTITIONS)
        spark.conf.unset(SIZED_BY_US)
