import os

import pytest

from kinfold import session
from kinfold.plans.state import State


def test_materialized_tables_are_released_when_consumed(spark):
    kept = session.materialize(spark.range(5), "kept")
    gone = session.materialize(spark.range(7), "gone")
    path = gone._kinfold_path.removeprefix("file://")
    assert gone.count() == 7 and os.path.isdir(path)
    session.release(gone, gone, spark.range(1))
    assert not os.path.isdir(path) and kept.count() == 5


def test_a_cluster_must_name_the_shared_folder():
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


@pytest.mark.parametrize(("total", "calls"), [(400, 1), (300, 0)])
def test_a_driver_whose_heap_has_grown_is_tidied(total, calls):
    class Heap:
        totalMemory, maxMemory = staticmethod(lambda: total), staticmethod(lambda: 750)

    called = []
    lang = type("lang", (), {"Runtime": type("Runtime", (), {"getRuntime": Heap}), "System": type("System", (), {"gc": lambda: called.append(1)})})
    spark = type("Spark", (), {"sparkContext": type("Context", (), {"_jvm": type("JVM", (), {"java": type("java", (), {"lang": lang})})})})
    session.tidy(spark)
    assert len(called) == calls


@pytest.fixture
def block_size(spark):
    """The setting as a session made elsewhere has it: none."""
    conf, name = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.broadcast.blockSize"
    before = conf.get(name, "")
    conf.remove(name)
    yield conf
    conf.set(name, before) if before else conf.remove(name)


def test_a_small_broadcast_takes_little_of_the_drivers_heap(spark, block_size):
    jvm = spark.sparkContext._jvm
    threads, me = jvm.java.lang.management.ManagementFactory.getThreadMXBean(), jvm.java.lang.Thread.currentThread().getId()

    def taken():
        spark.sparkContext._jsc.broadcast(1)  # loads what it needs
        began = threads.getThreadAllocatedBytes(me)
        spark.sparkContext._jsc.broadcast(1)
        return threads.getThreadAllocatedBytes(me) - began

    assert taken() > 4 << 20
    State(spark, "/root/testdata/sf0.001")
    assert taken() < 1 << 20


def test_blocks_that_a_session_sets_are_kept(spark, block_size):
    block_size.set("spark.broadcast.blockSize", "1m")
    session.small_blocks(spark)
    assert block_size.get("spark.broadcast.blockSize") == "1m"
