"""Profiles kept file by file equal those that read the whole table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.streaming import profiles

SCHEMA = (
    "a int, b string, c double, d timestamp, e date, f decimal(20,3), g array<int>, h boolean, i binary, `odd name` string"
)
SHOWN = [c for c in profile.RESULT_COLUMNS if c != "profile_timestamp"]


def rows(spark, low, high):
    return spark.range(low, high).selectExpr(
        "cast(if(id % 5 = 0, null, id % 7) as int) as a",
        "case when id % 4 = 0 then '  ' when id % 4 = 1 then null else concat('v', id % 11) end as b",
        "if(id % 9 = 0, -0.0D, if(id % 9 = 1, double('NaN'), id / 4)) as c",
        "timestamp_micros(id * 1000001) as d",
        "date_add(date'2020-01-01', cast(id % 13 as int)) as e",
        "cast(id as decimal(20,3)) / 8 as f",
        "if(id % 3 = 0, null, array(cast(id % 2 as int))) as g",
        "id % 2 = 0 as h",
        "cast(concat('x', id % 6) as binary) as i",
        "concat('odd ', id) as `odd name`",
    ).select(F.col("*")).to(spark.createDataFrame([], SCHEMA).schema)


def shown(frame):
    return sorted(map(str, frame.select(*SHOWN).collect()))


def test_files_come_change_and_go(spark, tmp_path):
    root, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema
    source = profiles.StoredProfile(spark, root, schema, str(tmp_path / "state"))
    plain = profiles.StoredProfile(spark, root, schema, str(tmp_path / "strict"), blanks_are_null=False)

    def whole(**options):
        table = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
        return shown(profile.profile_tables({"t": table, "again": table}, run_id="r", **options))

    def kept(sources=(source, source)):
        return shown(profile.profile_states({n: s.state() for n, s in zip(("t", "again"), sources)}, run_id="r"))

    none = rows(spark, 0, 0)
    assert kept() == shown(profile.profile_tables({"t": none, "again": none}, run_id="r"))  # before any file
    rows(spark, 0, 40).coalesce(1).write.parquet(f"{root}/one")
    rows(spark, 0, 0).coalesce(1).write.parquet(f"{root}/empty")
    assert source.update() == 2 and kept() == whole()
    assert source.update() == 0
    rows(spark, 30, 90).coalesce(1).write.parquet(f"{root}/two")
    assert source._work(source._stored()).count() == 1  # only the new file
    assert source.update() == 1 and kept() == whole()
    rows(spark, 200, 210).coalesce(1).write.mode("overwrite").parquet(f"{root}/one")  # one goes, one comes
    assert source.update() == 2 and kept() == whole()
    plain.update()
    assert kept((plain, plain)) == whole(blanks_are_null=False)


def test_values_are_kept_in_arrays(spark, tmp_path):
    """What is kept of a file's column takes some rows, not one for each of its values, and holds each value once."""
    root, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema
    source = profiles.StoredProfile(spark, root, schema, str(tmp_path / "state"))
    rows(spark, 0, 3000).unionAll(rows(spark, 0, 2000)).coalesce(1).write.parquet(f"{root}/one")
    rows(spark, 1000, 5000).coalesce(1).write.parquet(f"{root}/two + %")
    source.update()
    kept = source._stored().where("slot is not null")
    assert kept.groupBy("source_file", "slot").count().agg(F.max("count")).first()[0] <= 8  # the session's shuffle partitions
    assert {r.source_file.rsplit("/", 2)[-2] for r in kept.select("source_file").distinct().collect()} == {"one", "two%20+%20%25"}
    found = source.state()[2]
    assert found.columns == ["slot", *profile.VALUE] and found.where("slot = 3").count() == 3000 + 4000
    table = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    whole = profile.profile_tables({"t": table}, run_id="r")
    assert shown(profile.profile_states({"t": source.state()}, run_id="r")) == shown(whole)


def test_sketches_merge(spark, tmp_path):
    root, schema, state = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "state")
    source = profiles.StoredProfile(spark, root, schema, state, sketches=True)

    def compare():
        table = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
        whole = {r.column_name: r for r in profile.profile_tables({"t": table}, run_id="r").collect()}
        mine = profile.profile_states({"t": source.state()}, run_id="r").collect()
        assert {r.column_name for r in mine} == set(whole)
        for r in mine:
            want = whole[r.column_name].asDict()
            for c in set(SHOWN) - {"distinct_count", "distinct_percentage"}:
                assert r[c] == want[c]
            # few values are counted exactly
            assert r.distinct_count == pytest.approx(want["distinct_count"], rel=0.04 if want["distinct_count"] > 200 else 0)

    rows(spark, 0, 4000).coalesce(1).write.parquet(f"{root}/one")
    rows(spark, 0, 0).coalesce(1).write.parquet(f"{root}/empty")
    assert source.update() == 2
    compare()
    rows(spark, 3000, 9000).coalesce(2).write.parquet(f"{root}/two")  # a part of its values is known
    source.update()
    compare()
    kept = source._stored().where("slot is not null")
    assert kept.groupBy("source_file", "slot").count().where("count > 1").isEmpty()  # one row, however many values
    assert kept.agg(F.max(F.octet_length("sketch"))).first()[0] < 40_000
    rows(spark, 0, 10).coalesce(1).write.mode("overwrite").parquet(f"{root}/two")  # files that are gone leave it
    source.update()
    compare()
    with pytest.raises(ValueError):
        profiles.StoredProfile(spark, root, schema, state).update()


def test_kept_values_and_sketches_in_one_run(spark, tmp_path):
    root, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema
    rows(spark, 0, 60).coalesce(1).write.parquet(f"{root}/one")
    exact = profiles.StoredProfile(spark, root, schema, str(tmp_path / "a"))
    sketched = profiles.StoredProfile(spark, root, schema, str(tmp_path / "b"), sketches=True)
    table = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    mine = profiles.profile_run({"a": exact, "b": sketched}, run_id="r")
    assert shown(mine) == shown(profile.profile_tables({"a": table, "b": table}, run_id="r"))


def test_a_run_that_died_is_taken_up(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema
    rows(spark, 0, 20).coalesce(1).write.parquet(f"{root}/one")
    source = profiles.StoredProfile(spark, root, schema, str(tmp_path / "state"))
    for place in ("replace", "finish"):
        rows(spark, 20, 30).coalesce(1).write.parquet(f"{root}/{place}")

        def die(*_):
            raise RuntimeError("lost")

        owner = source.table if place == "replace" else source.pending
        with monkeypatch.context() as patch:
            patch.setattr(owner, place, die)
            with pytest.raises(RuntimeError):
                source.update()
        source.update()
        source.update()
        table = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
        mine = profile.profile_states({"t": source.state()}, run_id="r")
        assert shown(mine) == shown(profile.profile_tables({"t": table}, run_id="r"))


def test_reserved_column(spark, tmp_path):
    with pytest.raises(ValueError):
        profiles.StoredProfile(spark, str(tmp_path), spark.createDataFrame([], "source_file string").schema, str(tmp_path / "s"))
