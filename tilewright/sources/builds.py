"""Publication of several tables as one build: written, audited as written, and made current by one rename.

A published folder holds ``builds/<id>/<table>``, ``problems/<id>`` and a file ``CURRENT`` that names a build. Tables of a new build are written beside
the old ones; the rules run over what has been written; only a build without violations gets its name into ``CURRENT``, which one
atomic rename replaces. Readers see all tables of the old build or all of the new one, whatever fails or is killed in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Refused(ValueError):
    """A build with violations; ``problems`` is the written table of them."""

    def __init__(self, n: int, problems: DataFrame) -> None:
        super().__init__(f"the build has {n} violations; the published one stays")
        self.problems = problems


def _hadoop(spark: SparkSession, path: str):
    """(Hadoop's file classes, the folder, its file system, its context)."""
    fs, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    top = fs.Path(path)
    files = top.getFileSystem(conf)
    top = files.makeQualified(top)
    return fs, top, files, fs.FileContext.getFileContext(top.toUri(), conf)


def _point(spark: SparkSession, path: str, build: str) -> None:
    fs, top, files, context = _hadoop(spark, path)
    new = fs.Path(top, f"CURRENT.{build}")
    out = files.create(new, True)
    out.write(bytearray(build.encode()))
    out.close()
    rename = getattr(fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(new, fs.Path(top, "CURRENT"), how)


def current(spark: SparkSession, path: str) -> str | None:
    """The name of the published build."""
    fs, top, _, context = _hadoop(spark, path)
    if not context.util().exists(fs.Path(top, "CURRENT")):
        return None
    return spark.read.text(f"{path}/CURRENT").first()[0]


def published(spark: SparkSession, path: str, name: str, build: str | None = None) -> DataFrame:
    """A table of the published build, or of the one named; a reader of several tables names the build once for all of them."""
    build = build or current(spark, path)
    if build is None:
        raise FileNotFoundError(f"nothing is published in {path}")
    return spark.read.parquet(f"{path}/builds/{build}/{name}")


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], rules: Callable[[dict[str, DataFrame]], DataFrame], keep: int = 2) -> str:
    """Publishes ``tables`` as one build, unless ``rules``, given the tables as written, return violations; returns its name.

    The violations of a refused build are written to ``problems/<id>``, and it is never current. Of builds that were current before, the ``keep``
    latest stay for readers that have begun; tables of no rows are published like others.
    """
    path = path.rstrip("/")
    build = uuid.uuid4().hex
    there = f"{path}/builds/{build}"
    for name, df in tables.items():
        df.write.parquet(f"{there}/{name}")
    written = {name: spark.read.schema(df.schema).parquet(f"{there}/{name}") for name, df in tables.items()}
    rules(written).write.parquet(f"{path}/problems/{build}")
    problems = spark.read.parquet(f"{path}/problems/{build}")
    if n := problems.count():
        raise Refused(n, problems)
    _point(spark, path, build)
    _trim(spark, path, build, keep)
    return build


def _trim(spark: SparkSession, path: str, now: str, keep: int) -> None:
    """Removes builds but the current one and the ``keep`` latest before it."""
    fs, top, files, _ = _hadoop(spark, path)
    found = sorted(((x.getModificationTime(), x.getPath()) for x in files.listStatus(fs.Path(top, "builds"))), key=lambda x: -x[0])
    for _, old in [x for x in found if x[1].getName() != now][keep:]:
        files.delete(old, True)
