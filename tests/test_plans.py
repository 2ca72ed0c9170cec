"""Physical-plan properties the design relies on."""

import numpy as np
from pyspark import StorageLevel

import __spark_entry__ as ent
from riskspark.operators.encode import assemble
from riskspark.operators.moments import PARTIAL_SCHEMA, pack_blocks
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_scan_is_pruned_and_jvm_only(spark):
    import re
    df = ent.queries()["null_profile"](spark, SF_SMALL)
    phys = _plan(df)
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", phys)
    assert schemas and all("l_shipdate" not in s and "l_returnflag" not in s and "l_partkey" not in s
                           for s in schemas)
    assert "Python" not in phys and "ArrowEval" not in phys


def test_gradient_pass_reads_blocks_without_shuffle(spark):
    rows = spark.range(2000).selectExpr("cast(id % 2 * 2 - 1 as double) as y", "cast(id % 5 as int) as fold",
                                        "cast(id as double) / 2000 as a")
    data = rows.select("y", "fold", assemble(["a"]))
    blocks = pack_blocks(data, "x", 1).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()

    def kernel(batches):
        from riskspark.operators.moments import partial_batch
        for _ in batches:
            pass
        yield partial_batch({(0, 0): np.zeros(1)})
    plan = _plan(blocks.mapInArrow(kernel, PARTIAL_SCHEMA))
    assert "Exchange" not in plan and "InMemoryTableScan" in plan
    blocks.unpersist()
