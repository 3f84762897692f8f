"""Keyed state whose logic runs in the JVM. A processor in Python costs some seven socket round trips per key; a function in Java
beside this module costs none. Its source is compiled with Janino, the compiler of Spark's own generated code, once per
SparkContext, and goes to the executors as a jar of the context."""

from __future__ import annotations

import os
import pkgutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOADED: dict = {}


def _loader(spark: SparkSession, name: str):
    """The driver's class loader of the class in ``name``.java."""
    sc = spark.sparkContext
    held = _LOADED.get(name)
    if held is None or held[0] is not sc:
        parent = spark._jsparkSession.getClass().getClassLoader()
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(parent)
        compiler.cook(pkgutil.get_data(__package__, f"{name}.java").decode())
        fd, jar = tempfile.mkstemp(".jar", f"fleetlens-{name}-", os.environ.get("FLEETLENS_SCRATCH", "/tmp"))
        with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
            for cls, code in compiler.getBytecodes().items():
                z.writestr(f"{cls.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(jar)
        urls = sc._gateway.new_array(sc._jvm.java.net.URL, 1)
        urls[0] = sc._jvm.java.io.File(jar).toURI().toURL()
        held = _LOADED[name] = (sc, sc._jvm.java.net.URLClassLoader(urls, parent))
    return held[1]


def flat_map_groups_with_state(df: DataFrame, key: str, name: str, state: str, out: str) -> DataFrame:
    """``df`` grouped by ``key``, a long column, through the ``FlatMapGroupsWithStateFunction`` of ``name``.java, in update mode and with
    timeouts in event time. The function sees ``df``'s columns in their order; ``state`` and ``out`` are its schemas in DDL."""
    sc = df.sparkSession.sparkContext
    jvm, new_array = sc._jvm, sc._gateway.new_array
    sql = jvm.org.apache.spark.sql
    rows = lambda ddl: sql.Encoders.row(sql.types.StructType.fromDDL(ddl))
    function = _loader(df.sparkSession, name).loadClass(f"{__package__}.{name}").getConstructor(new_array(jvm.java.lang.Class, 0)).newInstance(new_array(jvm.java.lang.Object, 0))
    groups = getattr(df._jdf.groupBy(key, new_array(jvm.java.lang.String, 0)), "as")(sql.Encoders.LONG(), sql.Encoders.row(df._jdf.schema()))
    done = groups.flatMapGroupsWithState(function, sql.streaming.OutputMode.Update(), rows(state), rows(out), sql.streaming.GroupStateTimeout.EventTimeTimeout())
    return DataFrame(done.toDF(), df.sparkSession)
