"""Commits: crashes at every step, changes by others, provenance without rewriting, and layouts without exchanges."""

import json

import pytest
from pyspark.sql import functions as F

from staygrid.operators import compare
from staygrid.session import use_clusters
from staygrid.sources import commits, sinks
from staygrid.sources.place import Place

CHANGES = ("rename", "delete", "write_text", "replace_text", "make_folder")


class Killed(BaseException):
    """Nothing in the code at hand catches it."""


def _table(spark, n, by=1.0):
    return spark.range(n, numPartitions=3).select((F.col("id") % 5).alias("stay_id"), F.col("id").alias("time"), (F.col("id") * by).alias("hr"))


def _total(df):
    return df.agg(F.count("*"), F.sum("hr")).first()[:]


def _killed_at(monkeypatch, step):
    """Let the run die at its `step`-th change of the store; half of them once the change is made."""
    seen = []

    def wrap(method):
        def run(self, *args):
            seen.append(method.__name__)
            own = len(seen)
            if own == step and step % 2:
                raise Killed
            out = method(self, *args)
            if own == step:
                raise Killed
            return out

        return run

    for name in CHANGES:
        monkeypatch.setattr(Place, name, wrap(getattr(Place, name)))
    return seen


@pytest.mark.parametrize("plain", [False, True])
def test_a_crash_at_any_step_leaves_one_whole_table(spark, tmp_path, monkeypatch, plain):
    old, new = _table(spark, 20), _table(spark, 50, 2.0)
    step, died = 0, 0
    while True:
        step += 1
        path = tmp_path / f"w{step}.parquet"
        if plain:
            old.write.parquet(str(path))
        else:
            sinks.write_table(old, path, {"told": "old"})
        with monkeypatch.context() as patched:
            _killed_at(patched, step)
            try:
                sinks.write_table(new, path, {"told": "new"})
                break
            except Killed:
                died += 1
        found, notes = _total(commits.read_table(spark, path)), sinks.read_provenance(spark, path)
        assert (found, (notes or {}).get("told")) in [(_total(old), None if plain else "old"), (_total(new), "new")], step
        again = _table(spark, 7, 3.0)
        sinks.write_table(again, path, {"told": "again"})
        assert _total(spark.read.parquet(str(path))) == _total(commits.read_table(spark, path)) == _total(again)
        assert sinks.read_provenance(spark, path)["told"] == "again" and not [p for p in Place(path).folders() if p.name.startswith("_staged")]
    assert died > 10


def test_a_crash_while_provenance_is_attached_leaves_the_data(spark, tmp_path, monkeypatch):
    step = 0
    while True:
        step += 1
        path = tmp_path / f"a{step}.parquet"
        _table(spark, 20).write.parquet(str(path))
        before = {p.name for p in path.glob("part-*")}
        with monkeypatch.context() as patched:
            _killed_at(patched, step)
            try:
                sinks.attach_provenance(spark, path, {"told": "x"})
                break
            except Killed:
                pass
        assert {p.name for p in path.glob("part-*")} == before and (sinks.read_provenance(spark, path) or {"told": "x"})["told"] == "x"
    assert {p.name for p in path.glob("part-*")} == before and step > 2  # not one file was rewritten
    assert json.loads((tmp_path / f"a{step}.provenance.json").read_text())["told"] == "x"


def test_a_failed_job_leaves_the_table(spark, tmp_path):
    path = tmp_path / "w.parquet"
    sinks.write_table(_table(spark, 20), path, {"told": "old"})
    with pytest.raises(Exception, match="boom"):
        sinks.write_table(_table(spark, 20).withColumn("hr", F.when(F.col("time") == 19, F.raise_error(F.lit("boom"))).otherwise(1.0)), path, {"told": "new"})
    assert _total(commits.read_table(spark, path)) == _total(_table(spark, 20)) == _total(spark.read.parquet(str(path)))
    assert sinks.read_provenance(spark, path)["told"] == "old" and commits.recover(path) != [] and commits.recover(path) == []


def test_changes_by_others_are_told(spark, tmp_path):
    path = tmp_path / "w.parquet"
    sinks.write_table(_table(spark, 20), path, {"told": "x"})
    assert commits.verify(spark, path).where("not intact").count() == 0 and commits.manifest_of(path).rows == 20
    _table(spark, 3).write.mode("append").parquet(str(path))
    assert commits.verify(spark, path).where("not intact").count() > 0
    for read in (commits.read_table, sinks.read_provenance):
        with pytest.raises(ValueError, match="changed since"):
            read(spark, path)
    sinks.attach_provenance(spark, path, {"told": "y"})
    assert commits.read_table(spark, path).count() == 23 and sinks.read_provenance(spark, path)["told"] == "y" and commits.manifest_of(path).rows == 23
    sinks.write_table(commits.read_table(spark, path).where("time < 5"), path, None)  # reads what it replaces
    assert spark.read.parquet(str(path)).count() == 8 and sinks.read_provenance(spark, path) is None
    one, other = commits.Commit(spark, path), commits.Commit(spark, path)
    for commit in (one, other):
        commit.stage(_table(spark, 2))
        commit.move()
    one.swap(None)
    with pytest.raises(commits.ConcurrentCommitError):
        other.swap(None)
    assert commits.read_table(spark, path).count() == 2
    with pytest.raises(commits.StaleTableError):
        commits.verify(spark, tmp_path)
    sinks.write_table(_table(spark, 0), path, {"told": "empty"})
    assert commits.read_table(spark, path).columns == ["stay_id", "time", "hr"] and commits.read_table(spark, path).count() == 0


def test_many_files(spark, tmp_path):
    path = tmp_path / "w.parquet"
    for n in (200, 90):
        sinks.write_table(spark.range(n, numPartitions=60).select((F.col("id") % 5).alias("stay_id"), F.col("id").alias("time"), F.col("id").alias("hr")), path, {"told": n})
        assert commits.read_table(spark, path).count() == n == spark.read.parquet(str(path)).count()
        assert len(commits.manifest_of(path).files) == len([p for p in path.iterdir() if p.name.endswith(".parquet")]) == 60
    assert commits.verify(spark, path).where("not intact").count() == 0 and commits.recover(path) == []


def _exchanges_below_joins(df):
    """Exchanges in the plan under any join."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [len(line) - len(line.lstrip(" :+-*0123456789()")) for line in lines]
    return sum("Exchange" in lines[k] for i, line in enumerate(lines) if "Join" in line for k in range(i + 1, len(lines)) if all(a > at[i] for a in at[i + 1 : k + 1]))


def test_tables_in_buckets_join_without_an_exchange(spark, tmp_path):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")
    before = {n: spark.conf.get(n) for n in names}
    a, b = _table(spark, 200), _table(spark, 150, 2.0)
    for name, df in (("a", a), ("b", b)):
        sinks.write_table(df, tmp_path / f"{name}.parquet", {"told": name}, buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        use_clusters(spark)
        x, y = (commits.read_table(spark, tmp_path / f"{n}.parquet") for n in "ab")
        for make in (compare.on_common_keys, compare.missingness, compare.key_overlap, compare.values_only_in, compare.per_stay_reproduction):
            assert _exchanges_below_joins(make(a, b)) > 0, make
            assert _exchanges_below_joins(make(x, y)) == 0, make
            assert sorted(map(repr, make(x, y).collect())) == sorted(map(repr, make(a, b).collect())), make
        sinks.write_table(b, tmp_path / "a.parquet", None, buckets=4)
        assert _total(commits.read_table(spark, tmp_path / "a.parquet")) == _total(b)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
