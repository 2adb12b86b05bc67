import time

from ledgerfold.llm.store import CLEANUP, COALESCE, spread, stored


def shuffled(spark):
    """Names of the shuffle blocks on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).toString()).startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffled(spark)
    table = stored(spark.range(1000).repartition(3, "id"))
    for _ in range(20):  # Spark deletes them beside other work
        if not (left := shuffled(spark) - before):
            break
        time.sleep(0.5)
    assert not left and table.count() == 1000


def test_the_setting_of_the_session_stays(spark):
    for value in ("true", "false"):
        spark.conf.set(CLEANUP, value)
        stored(spark.range(3))
        assert spark.conf.get(CLEANUP) == value


def test_costly_rows_keep_their_partitions(spark):
    rows = lambda: spark.range(400).groupBy("id").count()
    files = lambda table: len(table.inputFiles())
    before = spark.conf.get(COALESCE)
    with spread(spark):
        assert files(stored(rows())) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(COALESCE) == before
