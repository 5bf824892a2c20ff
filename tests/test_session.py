from tarmac.session import MB, shuffle_settings


def test_shuffle_partitions_follow_the_input():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(10 * MB, cores=8)[key] == "16"
    assert shuffle_settings(100 << 40, cores=8000)[key] == str(100 * (1 << 40) // (128 * MB))
