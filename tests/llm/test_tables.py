import random
import time

from pyspark.sql import functions as F

from tablepull.llm import tables
from tablepull.llm.tables import components, repeated


def test_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {i for i in root if all(a == b for a, b in edges if i in (a, b))}
    assert got == {i: find(i) for i in root if i not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated(spark):
    rows = spark.createDataFrame([("x", 1), ("y", 25_001)], "name string, copies long")
    out = repeated(rows, "copies", "number")
    assert out.columns == ["name", "number"]
    assert out.where("name = 'y'").distinct().count() == 25_001 and out.where("name = 'x'").count() == 1


def test_stored_leaves_no_shuffle_files(spark):
    """Else they stay until the driver collects its garbage, and a job of many tables needs the disk for all of them."""

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(tables._CLEANUP, None)
    kept = tables.stored(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count(), "test")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 10
    assert spark.conf.get(tables._CLEANUP, None) == setting
    tables.drop_stored(kept)
