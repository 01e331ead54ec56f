"""Files and tables: provenance, damaged lines, replacement, streaming restarts."""

from __future__ import annotations

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.operators import versions
from millrace.plans import archive, extract, feedback
from millrace.sources import delimited, generations, keyed, ndjson, newest, tables
from millrace.streaming import incremental, partials


@pytest.fixture
def small_blocks(spark):
    """Files are read in blocks of two thousand bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_line_numbers_across_blocks(spark, tmp_path, small_blocks):
    folder = tmp_path / "in" / "Exp 1+1" / "d"
    folder.mkdir(parents=True)
    lines = ["{bad" if i % 100 == 7 else json.dumps({"id": str(i), "resourceType": "P", "line": i + 1}) for i in range(1000)]
    (folder / "x.ndjson").write_text("\n".join(lines) + "\n")
    (folder / "skipped.json").write_text('{"line": 1}\n')
    (folder / "empty.ndjson").write_text("")
    raw = ndjson.ingest(spark, str(tmp_path / "in"))
    wrong = raw.where("cast(get_json_object(file_content_raw, '$.line') as bigint) <> file_row_number")
    assert raw.count() == 990 and wrong.count() == 0
    assert raw.select("file_name").distinct().collect()[0][0] == "Exp 1+1/d/x.ndjson"


def test_missing_fields_become_blank(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"id":"1"}\n\n{"resourceType":"R","id":null}\nnot json\n')
    rows = ndjson.ingest(spark, str(tmp_path)).select("file_resource_type", "file_record_id").collect()
    assert sorted(map(tuple, rows)) == [(" ", "1"), ("R", " ")]


def test_content_key_is_of_the_content(spark, tmp_path):
    def keys():
        rows = ndjson.ingest(spark, str(tmp_path), line_numbers=False).select("file_name", "file_content_key")
        return {r[0]: r[1] for r in rows.collect()}

    (tmp_path / "a.ndjson").write_text('{"id":"1"}\n{"id":"2"}\n')
    (tmp_path / "b.ndjson").write_text('{"id":"1"}\n{"id":"2"}\n')
    before = keys()
    assert before["a.ndjson"] == before["b.ndjson"]
    date = (tmp_path / "b.ndjson").stat().st_mtime
    (tmp_path / "b.ndjson").write_text('{"id":"1"}\n{"id":"3"}\n')
    os.utime(tmp_path / "b.ndjson", (date, date))
    after = keys()
    assert after["a.ndjson"] == before["a.ndjson"] != after["b.ndjson"]


def test_content_key_knows_the_order_of_lines(spark, tmp_path, small_blocks):
    """Swapped lines, also in different blocks, change the key; copies keep it, however the scan cuts the files."""
    lines = [json.dumps({"id": str(i), "pad": "x" * (i % 37)}) for i in range(600)]
    swapped, turned = list(lines), lines[1:] + lines[:1]
    swapped[3], swapped[570] = swapped[570], swapped[3]
    near = [lines[1], lines[0], *lines[2:]]
    for name, some in (("a", lines), ("b", lines), ("c", swapped), ("d", turned), ("e", near), ("f", lines[:-1])):
        (tmp_path / f"{name}.ndjson").write_text("\n".join(some) + "\n")

    def keys():
        rows = ndjson.ingest(spark, str(tmp_path)).select("file_name", "file_content_key").distinct().collect()
        return {r[0][0]: r[1] for r in rows}

    cut = keys()
    assert cut["a"] == cut["b"] and len(set(cut.values())) == 5
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    assert keys() == cut
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert keys() == cut


def test_empty_staged_files_are_reported_once(spark, tmp_path):
    source, target, control = tmp_path / "in", str(tmp_path / "target"), str(tmp_path / "control")
    (source / "x y").mkdir(parents=True)
    (source / "a.txt").write_text("1,b\n2,c\n")
    (source / "x y" / "none.txt").write_text("")
    files = delimited.StagedFiles(str(source), "*.txt", T.StructType.fromDDL("k int, v string"), {"sep": ","})
    result = feedback.load_files(spark, files, {"k": F.col("k")}, target, control, table="t").first()
    assert (result["files"], result["rows_loaded"], result["outcome"]) == (2, 2, "loaded")
    status = {r["file"]: (r["status"], r["rows_parsed"]) for r in feedback.read_control(spark, control, "status").collect()}
    assert status == {"a.txt": ("LOADED", 2), "x y/none.txt": ("LOADED", 0)}
    again = feedback.load_files(spark, files, {"k": F.col("k")}, target, control, table="t").first()
    assert again["outcome"] == "no files processed"
    (source / "only.txt").write_text("")
    assert feedback.load_files(spark, files, {"k": F.col("k")}, target, control, table="t").first()["files"] == 1
    assert tables.read_runs(spark, target).count() == 2


PARTIALS = "s string, g int, v decimal(10,2)"


def partial_sums(spark, base):
    measures = {"n": ("sum", F.lit(1)), "total": ("sum", F.col("v")), "top": ("max", F.col("v"))}
    return partials.PartialSums(spark, f"{base}/in", T.StructType.fromDDL(PARTIALS), f"{base}/state", "s", ["s", "g"], measures, buckets=2)


def test_partial_sums_equal_a_full_computation(spark, tmp_path):
    """Files arrive, change, are emptied and go: the mart is that of the files that are there; read files are not opened again."""
    rnd = random.Random(3)

    def put(name, size):
        rows = [(rnd.choice(["a", "b c", None, "d"]), rnd.randrange(3), rnd.randrange(1000)) for _ in range(size)]
        frame = spark.createDataFrame(rows, "s string, g int, v int").selectExpr("s", "g", "cast(v as decimal(10,2)) as v")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/in/{name}")

    def check():
        source = partial_sums(spark, tmp_path)
        partials.refresh(spark, {"rows": source}, f"{tmp_path}/mart", "s", lambda rows: rows)
        whole = spark.read.schema(PARTIALS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        want = whole.groupBy("s", "g").agg(F.count("*"), F.sum("v"), F.max("v")).collect()
        got = spark.read.parquet(f"{tmp_path}/mart").select("s", "g", "n", "total", "top").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want)))

    put("one", 30)
    put("two", 5)
    check()
    put("three", 4)
    check()
    put("two", 3)  # other rows, partly in other slices
    put("one", 0)
    check()


@pytest.mark.parametrize("lost", ["sums", "mart", "end"])
def test_a_refresh_that_died_is_repeated(spark, tmp_path, monkeypatch, lost):
    spark.createDataFrame([("a", 1, 5), ("b", 1, 7)], "s string, g int, v int").write.parquet(f"{tmp_path}/in/one")
    source = partial_sums(spark, tmp_path)
    source.schema = T.StructType.fromDDL("s string, g int, v int")
    with monkeypatch.context() as broken:
        if lost == "sums":
            broken.setattr(keyed.KeyedTable, "_store", lambda *args: 1 / 0)
        elif lost == "mart":
            broken.setattr(tables, "replace_slices", lambda *args: 1 / 0)
        else:
            broken.setattr(partials.PartialSums, "finish", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            partials.refresh(spark, {"rows": source}, f"{tmp_path}/mart", "s", lambda rows: rows)
    partials.refresh(spark, {"rows": source}, f"{tmp_path}/mart", "s", lambda rows: rows)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/mart").select("s", "n", "total").collect())) == [("a", 1, 5), ("b", 1, 7)]
    assert source.update() is None


def test_line_numbers_need_no_exchange_of_lines(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"id":"1"}\n' * 100)
    plan = ndjson.ingest(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan


def test_old_files_that_arrive_late_are_loaded(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    source.mkdir()
    (source / "new.ndjson").write_text('{"id":"1"}\n')
    incremental.ingest_new_files(spark, str(source), target, state)
    (source / "old.ndjson").write_text('{"id":"2"}\n')
    month_ago = time.time() - 30 * 86400
    os.utime(source / "old.ndjson", (month_ago, month_ago))
    incremental.ingest_new_files(spark, str(source), target, state)
    assert sorted(r["file_record_id"] for r in incremental.read_ingested(spark, target).collect()) == ["1", "2"]


def test_loaded_files_can_be_moved_away(spark, tmp_path):
    source, target, state, done = (tmp_path / x for x in ("in", "raw", "state", "done"))
    source.mkdir()
    for n in range(3):
        (source / f"{n}.ndjson").write_text(f'{{"id":"{n}"}}\n')
        incremental.ingest_new_files(spark, str(source), str(target), str(state), archive=str(done))
    assert incremental.read_ingested(spark, str(target)).count() == 3
    assert len(list(source.glob("*.ndjson"))) < 3


def test_files_load_once_and_restart(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.ndjson").write_text('{"id":"1"}\n')
    for _ in range(2):
        incremental.ingest_new_files(spark, str(source), target, state)
    (source / "b.ndjson").write_text('{"id":"2"}\n{"id":"3"}\n')
    incremental.ingest_new_files(spark, str(source), target, state)
    raw = incremental.read_ingested(spark, target)
    assert sorted(r["file_record_id"] for r in raw.collect()) == ["1", "2", "3"]


STAGED = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())]
)


def test_damaged_lines_are_reported(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.csv").write_text("k,name,n\n1,a,1\n2,b,2\n")
    (source / "mixed.csv").write_text('k,name,n\n3,c,3\n4,d\n5,e,5,5\n6,f,x\n7,"g,h",7\n7,"g,h",x\n')
    (source / "bad.csv").write_text("k,name,n\nx,y,z\n")
    (source / "empty.csv").write_text("")
    (source / "other.txt").write_text("1,a,1\n")
    files = delimited.StagedFiles(str(source), "*.csv", STAGED, {"header": "true"})
    target = str(tmp_path / "target")
    control = str(tmp_path / "control")
    fields = {"k": F.col("k"), "label": F.upper("name")}
    result = feedback.load_files(spark, files, fields, target, control, table="t")
    stored = feedback.read_control(spark, control, "status").collect()
    status = {r["file"]: (r["status"], r["rows_parsed"], r["row_loaded"], r["errors_seen"]) for r in stored}
    first = {r["file"]: (r["first_error"], r["first_error_line"], r["first_error_column_name"]) for r in stored}
    assert first["mixed.csv"] == ("expected 3 values, found 2", 3, None) and first["good.csv"] == (None, None, None)
    assert first["bad.csv"] == ("a value does not fit its column type", 2, "k")
    assert status == {
        "good.csv": ("LOADED", 2, 2, 0),
        "mixed.csv": ("PARTIALLY_LOADED", 6, 2, 4),
        "bad.csv": ("LOAD_FAILED", 1, 0, 1),
        "empty.csv": ("LOADED", 0, 0, 0),
    }
    rejected = feedback.read_control(spark, control, "rejects").collect()
    rejects = {(r["file"], r["rejected_record"]): (r["category"], r["error"]) for r in rejected}
    places = {r["rejected_record"]: (r["line"], r["character"], r["column_name"]) for r in rejected}
    assert places["6,f,x"] == (5, 5, "n") and places['7,"g,h",x'] == (7, 9, "n") and places["x,y,z"] == (2, 1, "k")
    assert rejects[("mixed.csv", '7,"g,h",x')][0] == "conversion"
    assert rejects[("mixed.csv", "4,d")] == ("parsing", "expected 3 values, found 2")
    assert rejects[("mixed.csv", "6,f,x")][0] == "conversion"
    assert result.first()["outcome"] == "not all rows loaded"

    def loaded():
        return sorted(map(tuple, tables.read_runs(spark, target).collect()))

    assert loaded() == [(1, "A"), (2, "B"), (3, "C"), (7, "G,H")]
    again = feedback.load_files(spark, files, fields, target, control, table="t").first()
    assert again["outcome"] == "no files processed" and len(loaded()) == 4
    (source / "later.csv").write_text("k,name,n\n8,i,8\n")
    assert feedback.load_files(spark, files, fields, target, control, table="t").first()["outcome"] == "loaded"
    assert loaded()[-1] == (8, "I") and len(loaded()) == 5


def test_a_load_that_died_is_repeated_without_doubling(spark, tmp_path, monkeypatch):
    source, target, control = tmp_path / "in", str(tmp_path / "target"), str(tmp_path / "control")
    source.mkdir()
    (source / "a.csv").write_text("1,a,1\n")
    files = delimited.StagedFiles(str(source), "*.csv", STAGED, {})
    with monkeypatch.context() as broken:
        broken.setattr(delimited, "load_status", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feedback.load_files(spark, files, {"k": F.col("k")}, target, control, table="t")
    assert tables.read_runs(spark, target).count() == 1  # the rows were added, the files not logged
    (source / "b.csv").write_text("2,b,2\n")
    for outcome in ("loaded", "loaded", "no files processed"):
        assert feedback.load_files(spark, files, {"k": F.col("k")}, target, control, table="t").first()["outcome"] == outcome
    assert sorted(r["k"] for r in tables.read_runs(spark, target).collect()) == [1, 2]


def test_replace_is_idempotent(spark):
    old = spark.createDataFrame([("a ", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    new = spark.createDataFrame([("a", 10), ("c", 11)], "k string, v int")
    target, staging = session.scratch_path(spark, "t"), session.scratch_path(spark, "s")
    keyed.replace_keys(old, target, ["k"], session.scratch_path(spark, "s"), buckets=4)
    for _ in range(3):
        keyed.replace_keys(new, target, ["k"], staging, buckets=4)
    rows = sorted(map(tuple, keyed.read_keyed(spark, target).collect()), key=str)
    assert rows == sorted([("a", 10), ("c", 11), ("b", 3), (None, 4)], key=str)


STEPS = ["_write", "_store", "_fold"]


@pytest.mark.parametrize("markers", ["true", "false"])
@pytest.mark.parametrize("moment", ["before", "after"])
@pytest.mark.parametrize("step", STEPS)
def test_a_replacement_that_died_is_all_or_nothing(spark, monkeypatch, step, moment, markers):
    """Death before or after each step, with and without success markers: old rows or new ones, never a part."""
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", markers)
    try:
        target = session.scratch_path(spark, "t")
        old = spark.createDataFrame([(str(i), i) for i in range(20)], "k string, v int")
        new = spark.createDataFrame([("3", 103), ("30", 130)], "k string, v int")
        keyed.replace_keys(old, target, ["k"], "one", buckets=4)
        real = getattr(keyed.KeyedTable, step)

        def die(self, *args, **options):
            if moment == "after":
                real(self, *args, **options)
            raise RuntimeError("lost")

        before = sorted(map(tuple, old.collect()))
        after = sorted([r for r in before if r[0] != "3"] + [("3", 103), ("30", 130)])
        with monkeypatch.context() as broken:
            broken.setattr(keyed.KeyedTable, step, die)
            with pytest.raises(RuntimeError):
                keyed.replace_keys(new, target, ["k"], "two")
        assert sorted(map(tuple, keyed.read_keyed(spark, target).collect())) in (before, after)
        for _ in range(2):
            keyed.replace_keys(new, target, ["k"], "two")
            assert sorted(map(tuple, keyed.read_keyed(spark, target).collect())) == after
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_tables_without_success_markers_lose_nothing(spark):
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        target = session.scratch_path(spark, "t")
        keyed.replace_keys(spark.createDataFrame([(str(i), i) for i in range(20)], "k string, v int"), target, ["k"], "a", buckets=2)
        keyed.replace_keys(spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int"), target, ["k"], "b")
        assert keyed.read_keyed(spark, target).count() == 22
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_batch_writes_itself_alone(spark, tmp_path):
    target = str(tmp_path / "t")
    keyed.replace_keys(spark.range(20_000).selectExpr("cast(id as string) as k", "id as v"), target, ["k"], "base", buckets=16)

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("*.parquet")}

    before = files()
    keyed.replace_keys(spark.range(300).selectExpr("cast(id as string) as k", "-id as v"), target, ["k"], "few")
    after = files()
    assert before.items() <= after.items()
    added = spark.read.parquet(*[str(f) for f in after.keys() - before.keys()])
    assert added.count() == 300
    assert keyed.read_keyed(spark, target).agg(F.sum("v")).first()[0] == sum(range(300, 20_000)) - sum(range(300))


def test_folding_keeps_the_rows_and_bounds_the_batches(spark, tmp_path):
    rnd = random.Random(5)
    target, want = str(tmp_path / "t"), {}
    for n in range(14):
        size = 400 if n == 0 else rnd.choice([1, 3, 60])
        batch = [(str(rnd.randrange(500)) + " " * rnd.randrange(2), n) for _ in range(size)]
        for k in {k.strip() for k, _ in batch}:
            want[k] = sum(x.strip() == k for x, _ in batch)
        want = want | {None: want.get(None, 0) + 1}  # rows without a key are never replaced
        frame = spark.createDataFrame([*batch, (None, n)], "k string, v int")
        keyed.replace_keys(frame, target, ["k"], f"batch {n}", buckets=4)
        state = keyed.KeyedTable(spark, target).manifest()
        assert len(state.batches) <= keyed.MAX_BATCHES
        found = keyed.read_keyed(spark, target).groupBy(F.trim("k").alias("k")).count().collect()
        assert {r.k: r["count"] for r in found} == want
    held = keyed.KeyedTable(spark, target).read([1, 2], with_bucket=True)
    assert {r[0] for r in held.select("key_bucket").distinct().collect()} == {1, 2}
    every = keyed.KeyedTable(spark, target).read(with_bucket=True).where("key_bucket in (1, 2)")
    assert held.count() == every.count()


def test_data_without_a_manifest_is_refused(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) as k").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        keyed.replace_keys(spark.createDataFrame([("a",)], "k string"), str(tmp_path / "t"), ["k"], "a")


@pytest.mark.parametrize("step", ["table", "mark"])
def test_a_generation_that_died_leaves_the_one_before(spark, monkeypatch, step):
    state = generations.Generations(spark, session.scratch_path(spark, "g"))
    one, two = (spark.createDataFrame([(n,)], "v int") for n in (1, 2))
    state.write({"a": one, "b": one}, "first")
    with monkeypatch.context() as broken:
        if step == "mark":
            broken.setattr(generations.Generations, "_mark", lambda *args: 1 / 0)
        frames = {"a": two, "b": two if step == "mark" else two.select(F.raise_error(F.lit("lost")).alias("v"))}
        with pytest.raises(Exception):
            state.write(frames, "second")
    assert state.newest().note == "first" and [state.table(x).first().v for x in "ab"] == [1, 1]
    for n in range(4):
        state.write({"a": two}, f"again {n}")
    assert state.table("a").first().v == 2 and state.table("b") is None and state.newest().note == "again 3"


def test_newest_versions_equal_the_full_computation(spark):
    """Slices in any order, ties, NULL keys and clocks: each merge gives what grouping the whole history would."""
    rnd = random.Random(9)
    known = newest.NewestVersions(spark, session.scratch_path(spark, "n"), ["a", "b"], "clock", buckets=4)
    seen = spark.createDataFrame([], "a string, b string, clock int, v int, s int")
    for n in range(6):
        rows = [(rnd.choice(["x", "x ", "y", None]), rnd.choice(["1", "2", None]), rnd.choice([None, *range(8)]), rnd.randrange(99), n) for _ in range(25)]
        batch = spark.createDataFrame(rows, seen.schema)
        seen = seen.unionByName(batch)
        want = sorted(map(str, versions.latest_versions(seen, ["a", "b"], "clock", within=batch).collect()))
        for _ in range(2):
            assert sorted(map(str, known.merge(batch, f"batch {n}").collect())) == want


def test_another_bucket_count_is_refused(spark):
    rows = spark.createDataFrame([(str(i), i) for i in range(20)], "k string, v int")
    target, copy = session.scratch_path(spark, "t"), session.scratch_path(spark, "t")
    keyed.replace_keys(rows, target, ["k"], session.scratch_path(spark, "s"), buckets=8)
    with pytest.raises(ValueError):
        keyed.replace_keys(rows, target, ["k"], session.scratch_path(spark, "s"), buckets=64)
    keyed.replace_keys(rows, target, ["k"], session.scratch_path(spark, "s"))
    keyed.rebucket(spark, target, copy, ["k"], 3)
    keyed.replace_keys(rows, copy, ["k"], session.scratch_path(spark, "s"))
    assert keyed.stored_buckets(spark, copy) == 3
    assert keyed.read_keyed(spark, target).count() == keyed.read_keyed(spark, copy).count() == 20


def test_null_and_emptied_slices_are_refreshed(spark, tmp_path):
    target = str(tmp_path / "t")
    layout = "v int, s string"
    tables.replace_slices(spark.createDataFrame([(1, "a b/c%d"), (2, None), (3, "k")], layout), target, ["s"])
    changed = spark.createDataFrame([("a b/c%d",), (None,), ("new",)], "s string")
    tables.replace_slices(spark.createDataFrame([(9, "new")], layout), target, ["s"], changed)
    assert sorted(map(tuple, spark.read.parquet(target).select("v", "s").collect())) == [(3, "k"), (9, "new")]


def test_history_of_a_day_is_not_doubled(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01")], "x string, load_dt string")
    for _ in range(2):
        tables.append_history(rows, str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).count() == 1


def test_work_folders_are_emptied(spark):
    kept = []
    with pytest.raises(ZeroDivisionError), session.workspace(spark) as settle:
        frame = settle(spark.range(5), "x")
        kept += frame.inputFiles()
        assert frame.count() == 5
        1 / 0
    assert kept and not any(os.path.exists(f.removeprefix("file:")) for f in kept)


def test_hot_key_keeps_all_rows(spark):
    """A third of the rows share one key; nothing is dropped and order columns decide."""
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) as k", "cast(id % 100 as int) as clock", "id")
    newest = versions.latest_versions(rows, ["k"], "clock")
    assert newest.where("k = 0").count() == rows.where("k = 0 and clock = 99").count()
    top = versions.top_n_per_key(rows, ["k"], [F.col("id").desc()], 4)
    assert [r["id"] for r in top.where("k = 0").orderBy("slot").collect()] == [29997, 29994, 29991, 29988]


def test_gate_treats_null_slices_as_equal(spark):
    source = spark.createDataFrame([("a",), ("b",), (None,)], "d string")
    target = spark.createDataFrame([("a",), (None,)], "d string")
    assert [r[0] for r in versions.new_slices(source, target, "d").collect()] == ["b"]


CONFIG_ROW = ("s", "m", "one", "t", "m", "copy", "APPEND", "DAILY", True)
CONFIG = (
    "source_db_name string, source_schema_name string, source_table_name string, target_db_name string, "
    "target_schema_name string, target_table_name string, load_type string, frequency string, run_backup_trigger_ind boolean"
)


def test_a_failed_copy_leaves_the_others_done(spark, tmp_path):
    good, bad = CONFIG_ROW, (*CONFIG_ROW[:2], "two", "t", "m", "other", *CONFIG_ROW[6:])
    spark.range(3).write.parquet(str(tmp_path / "one"))
    control = str(tmp_path / "control")
    totals = spark.createDataFrame([("x", "N")], "t string, archive_status string")
    archive.store_control(spark, control, spark.createDataFrame([good, bad], CONFIG), totals)
    words = spark.createDataFrame([], "table_name string, extract_field_name string, field_desc string")
    places = archive.Places(lambda database, schema, name: str(tmp_path / name))
    for attempt in (1, 2):
        result = archive.run_archive(spark, control, words, places, F.current_date())
        audit = sorted((r["table_name"], r["status"]) for r in result["audit"].collect())
        assert audit == [("copy", "LOADED")] + [("other", "FAILED")] * attempt
        assert {r["target_table_name"]: r["run_backup_trigger_ind"] for r in result["config"].collect()} == {"copy": False, "other": True}
    assert tables.read_runs(spark, str(tmp_path / "copy")).count() == 3
    assert result["totals"].first()["archive_status"] == "Y"
    spark.range(4).write.parquet(str(tmp_path / "two"))
    result = archive.run_archive(spark, control, words, places, F.current_date())
    assert tables.read_runs(spark, str(tmp_path / "other")).count() == 4
    assert not any(r["run_backup_trigger_ind"] for r in result["config"].collect())


@pytest.mark.parametrize("moment", ["config", "totals", "mark", "after"])
def test_a_run_that_died_storing_its_control_tables(spark, tmp_path, monkeypatch, moment):
    """Config and totals change together or not at all; the next run ends the work and copies nothing twice."""
    spark.range(4).write.parquet(str(tmp_path / "one"))
    rows = [("s", "m", "one", "t", "m", "one_copy", "APPEND", "DAILY", True), ("s", "m", "two", "t", "m", "two_copy", "APPEND", "DAILY", False)]
    control, places = str(tmp_path / "control"), archive.Places(lambda database, schema, name: str(tmp_path / name))
    archive.store_control(spark, control, spark.createDataFrame(rows, CONFIG), spark.createDataFrame([("x", "N")], "t string, archive_status string"))
    words = spark.createDataFrame([], "table_name string, extract_field_name string, field_desc string")
    real, seen = generations.Generations.write, []

    def die(self, frames, note=""):
        if "config" not in frames:
            return real(self, frames, note)
        lost = {n: f.select(*[F.raise_error(F.lit("lost")).cast(x.dataType).alias(x.name) for x in f.schema.fields]) if n == moment else f for n, f in frames.items()}
        if moment == "mark":
            monkeypatch.setattr(generations.Generations, "_mark", lambda *args: 1 / 0)
        real(self, lost, note)
        seen.append(1 / 0 if moment == "after" else 1)

    with monkeypatch.context() as broken:
        broken.setattr(generations.Generations, "write", die)
        mark = generations.Generations._mark
        with pytest.raises(Exception):
            archive.run_archive(spark, control, words, places, F.current_date())
    monkeypatch.setattr(generations.Generations, "_mark", mark)
    config = {r.target_table_name: r.run_backup_trigger_ind for r in archive.control_table(spark, control, "config").collect()}
    closed = archive.control_table(spark, control, "totals").first().archive_status
    assert (config, closed) == (({"one_copy": False, "two_copy": False}, "Y") if moment == "after" else ({"one_copy": True, "two_copy": False}, "N"))
    result = archive.run_archive(spark, control, words, places, F.current_date())
    assert tables.read_runs(spark, str(tmp_path / "one_copy")).count() == 4
    assert result["audit"].count() == 1 and result["config"].where("run_backup_trigger_ind").count() == 0
    assert result["totals"].first().archive_status == "Y" and result["config"].count() == 2


def test_control_totals_close_only_without_pending_full_copies(spark):
    totals = spark.createDataFrame([("x", "N"), ("y", "Y")], "t string, archive_status string")

    def closed(target):
        config = spark.createDataFrame([(*CONFIG_ROW[:5], target, *CONFIG_ROW[6:])], CONFIG)
        return sorted(r[1] for r in archive.close_control_totals(totals, config, "one").collect())

    assert closed("copy") == ["N", "Y"] and closed("copy_INCREMENTAL") == ["Y", "Y"]


def test_extract_reports_missing_and_empty_sources(spark, tmp_path):
    words = spark.createDataFrame([("t", "a", "First Name")], "table_name string, extract_field_name string, field_desc string")
    empty = spark.createDataFrame([], "a string, b int")
    full = spark.createDataFrame([("x", 1)], "a string, b int")
    assert extract.build_extract(spark, "t", None, words, "").first()["status"] == "source table does not exist"
    assert extract.build_extract(spark, "t", empty, words, "").first()["status"] == "source is empty"
    report = extract.build_extract(spark, "t", full, words, str(tmp_path / "x")).first()
    assert (report["status"], report["renamed_columns"], report["kept_columns"]) == ("verified", 1, 1)
    assert spark.read.parquet(str(tmp_path / "x")).columns == ["First Name", "b"]


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
