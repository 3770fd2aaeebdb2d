"""Session helpers (pure Python)."""

from textprice.session import SESSION_DEFAULTS, cluster_settings


def test_cluster_settings_scale_with_input():
    tb = 1024 ** 4
    big = cluster_settings(100 * tb, cores=8000)
    small = cluster_settings(10 * 1024 ** 3, cores=64)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600          # 100 TB / 256 MiB
    assert int(small["spark.sql.shuffle.partitions"]) == 128           # at least 2x cores
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "RocksDB" in big["spark.sql.streaming.stateStore.providerClass"]
    assert set(SESSION_DEFAULTS) <= set(big)
