"""Session helpers shared by the operators."""

from __future__ import annotations

import contextlib
import getpass
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the session names it.

    Only where it is unset in a local session (tests, a laptop) a folder under /tmp is set
    instead; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file:///tmp/checkpoints/termloom-{getpass.getuser()}"
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/termloom/{name}-{uuid.uuid4().hex}"


def give_back(spark: SparkSession) -> None:
    """Give what the driver's JVM has freed outside its heap back to the system, as release() does in a worker.

    Plans are compiled, and results unpacked, in memory that the C library keeps once it is freed:
    hundreds of MB in a long session. A JVM that has no such command keeps them.
    """
    jvm, new = spark._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    with contextlib.suppress(Py4JError):
        kinds, args = new(jvm.java.lang.Class, 4), new(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # through the interface, as the server's own class is closed to reflection
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder now and go on from there: survives lost executors."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    give_back(df.sparkSession)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark writes to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def integer_id(df: DataFrame, name: str) -> Column:
    """The id column as a long; ids of another than an integer type are refused."""
    kind = df.select(name).schema[0].dataType
    if not isinstance(kind, (Ty.ByteType, Ty.ShortType, Ty.IntegerType, Ty.LongType)):
        raise TypeError(f"the ids in {name} must be integers, not {kind.simpleString()}")
    return F.col(name).cast("long")


def first_by_hash(df: DataFrame, key: str, n: int, *then: str) -> list:
    """The at most n rows of df that come first in the order of a column of 64-bit hashes (then of others).

    Only about n rows pass a bound on the hash and are ordered, so what reaches the driver grows
    neither with the rows nor with the partitions; the bound is raised where repeated hashes
    leave too few.
    """
    unit = F.shiftrightunsigned(key, 11).cast("double") * 2.0**-53
    total = df.count()
    share = (n + 10 * n**0.5 + 100) / max(1, total)
    while True:
        rows = (df.where(unit < share) if share < 1 else df).orderBy(unit, *then).limit(n).collect()
        if len(rows) >= n or share >= 1:
            return rows
        share *= 4
