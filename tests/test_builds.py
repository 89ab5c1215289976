"""Publication: readers see the old build or the new one."""

import os

import pytest
from pyspark.sql import functions as F

from tilewright.operators import contract
from tilewright.sources import builds


def test_publication(spark, tmp_path):
    path = str(tmp_path / "site")
    rows = lambda n, v: spark.range(n).withColumn("v", F.lit(v))
    rules = lambda t: contract.problems(spark, contract.duplicates(t["a"], "twice", "id"), contract.missing(t["a"], t["b"], "lost", "id"))
    seen = lambda name: {(r["id"], r["v"]) for r in builds.published(spark, path, name).collect()}
    with pytest.raises(FileNotFoundError):
        builds.published(spark, path, "a")
    first = builds.publish(spark, path, {"a": rows(3, "x"), "b": rows(3, "x")}, rules)
    assert builds.current(spark, path) == first
    # a rule fails
    with pytest.raises(builds.Refused) as e:
        builds.publish(spark, path, {"a": rows(3, "y").union(rows(1, "y")), "b": rows(2, "y")}, rules)
    assert sorted((r["rule_id"], r["object_id"]) for r in e.value.problems.collect()) == [("lost", "2"), ("twice", "0")]
    # a job dies when one table is written and the other is not
    with pytest.raises(Exception, match="killed"):
        builds.publish(spark, path, {"a": rows(3, "z"), "b": rows(3, "z").withColumn("v", F.raise_error(F.lit("killed")).cast("string"))}, rules)
    assert builds.current(spark, path) == first and seen("a") == seen("b") == {(i, "x") for i in range(3)}
    # readers that have begun keep their build
    old = builds.published(spark, path, "a", first)
    for v in "pqr":
        last = builds.publish(spark, path, {"a": rows(4, v), "b": rows(5, v)}, rules, keep=6)
        assert builds.current(spark, path) == last and seen("a") == {(i, v) for i in range(4)} and seen("b") == {(i, v) for i in range(5)}
    assert old.count() == 3
    builds.publish(spark, path, {"a": rows(0, "e"), "b": rows(0, "e")}, rules, keep=1)
    assert seen("a") == set() and len(os.listdir(tmp_path / "site" / "builds")) == 2
    assert not [x for x in os.listdir(tmp_path / "site") if x.startswith("CURRENT.")]


def test_inventory_of_large_files(spark, tmp_path):
    """A file of more than two gigabytes, mostly a hole, is hashed by a task without being a value."""
    import hashlib

    from tilewright.sources import collections as src

    size = (1 << 31) + 12345
    with open(tmp_path / "large.bin", "wb") as f:
        f.seek(size - 3)
        f.write(b"end")
    (tmp_path / "small.bin").write_bytes(b"abc")
    digest, zeros, left = hashlib.sha256(), bytes(1 << 22), size - 3
    while left:
        digest.update(zeros[: min(left, len(zeros))])
        left -= min(left, len(zeros))
    digest.update(b"end")
    got = {r["path"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in src.inventory(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": (size, digest.hexdigest()), "small.bin": (3, hashlib.sha256(b"abc").hexdigest())}
