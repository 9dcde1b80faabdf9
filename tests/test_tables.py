import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelens.session import broadcast_if_bounded, shared_dir
from farelens.sources import versions
from farelens.sources.readers import load_schemas, read_trips, read_trips_dir, read_zones, schema_groups
from farelens.sources.schemas import RAW_TRIP, RAW_ZONE, select_to_schema
from farelens.sources.tables import (
    LOAD_PERIOD,
    DuplicateKeyError,
    ensure_table,
    read_table,
    replace_partitions,
    replace_period,
    table_exists,
    upsert,
    write_mart,
)

KV = "id bigint, v string, p string"


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def content(spark, path, schema=KV):
    return sorted((r["id"], r["v"], r["p"]) for r in read_table(spark, path, StructType.fromDDL(schema)).collect())


def test_upsert_updates_inserts_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", "x"), (2, "b", "x"), (3, "c", "y")), path, ["id"], "p")
    second = kv(spark, (2, "B", "x"), (4, "d", "z"))
    for _ in range(2):
        upsert(second, path, ["id"], "p")
        assert content(spark, path) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "d", "z")]


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = tmp_path / "t"
    upsert(kv(spark, (1, "a", "x"), (3, "c", "y")), str(path), ["id"], "p")
    _, before = versions.read_manifest(spark, str(path))
    upsert(kv(spark, (1, "A", "x")), str(path), ["id"], "p")
    _, after = versions.read_manifest(spark, str(path))
    assert after["p=y"] == before["p=y"] and after["p=x"] != before["p=x"]


def test_upsert_without_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", "x"), (2, "b", "x")), path, ["id", "p"])
    upsert(kv(spark, (2, "B", "x"), (2, "n", "q")), path, ["id", "p"])
    assert content(spark, path) == [(1, "a", "x"), (2, "B", "x"), (2, "n", "q")]


def test_upsert_cut_short_anywhere_can_be_repeated(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "t"), [(k, "a", "x") for k in range(100)]
    upsert(kv(spark, *rows), path, ["id"])
    want = sorted([(0, "B", "x"), (100, "n", "x"), *rows[1:]])
    source = kv(spark, (0, "B", "x"), (100, "n", "x"))
    # In the write of the new rows.
    failing = source.withColumn("v", F.when(F.col("id") == 100, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        upsert(failing, path, ["id"])
    assert content(spark, path) == sorted(rows)
    # Between the two renames, and after both.
    shutil.copytree(path, f"{path}.next")
    os.rename(path, f"{path}.old")
    upsert(source, path, ["id"])
    assert content(spark, path) == want
    shutil.copytree(path, f"{path}.old")
    upsert(source, path, ["id"])
    assert content(spark, path) == want and sorted(os.listdir(tmp_path)) == ["t"]


def test_months_of_different_schemas_lose_no_column(spark, tmp_path):
    old = spark.createDataFrame([(1, 2.5)], "VendorID int, fare_amount double")
    new = spark.createDataFrame([(2.0, 3, 0.75)], "VendorID double, fare_amount int, cbd_congestion_fee double")
    old.write.parquet(str(tmp_path / "a"))
    new.write.parquet(str(tmp_path / "b"))
    for paths in (("a", "b"), ("b", "a")):
        got = read_trips(spark, *(str(tmp_path / p) for p in paths))
        rows = sorted((r["VendorID"], r["fare_amount"], r["cbd_congestion_fee"]) for r in got.collect())
        assert [str(r) for r in rows] == ["(1, 2.5, None)", "(2, 3.0, 0.75)"]


def test_schema_groups_take_few_jobs(spark, tmp_path, monkeypatch):
    """Nine months, of which the middle three have another type and a column more."""
    for k in range(9):
        kind = "double" if 3 <= k < 6 else "bigint"
        spark.range(2).select(F.col("id").cast(kind).alias("VendorID"), *([F.lit(1.5).alias("extra")] if k > 4 else [])).coalesce(1).write.parquet(str(tmp_path / f"m{k}"))
    files = sorted(read_trips(spark, *[str(tmp_path / f"m{k}") for k in range(9)]).inputFiles())
    groups = schema_groups(spark, files)
    assert sorted(f for some in groups.values() for f in some) == files
    assert all(len({"/m3" <= f[f.index("/m") :] < "/m6" for f in some}) == 1 for some in groups.values()) and len(groups) <= 4
    got = read_trips(spark, *[str(tmp_path / f"m{k}") for k in range(9)])
    assert got.agg(F.sum("VendorID"), F.count("extra")).first()[:2] == (9, 8)
    catalogue = load_schemas(spark, str(tmp_path / "m0"), str(tmp_path / "m4"))
    assert sorted(r["n_files"] for r in catalogue.collect()) == [1, 1]


def test_upsert_refuses_repeated_keys_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", "x")), path, ["id"], "p")
    with pytest.raises(DuplicateKeyError):
        upsert(kv(spark, (1, "b", "x"), (1, "c", "x")), path, ["id"], "p")
    assert content(spark, path) == [(1, "a", "x")]


def test_upsert_null_keys_match_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (None, "a", "x")), path, ["id"], "p")
    upsert(kv(spark, (None, "b", "x"), (None, "c", "x")), path, ["id"], "p")
    assert read_table(spark, path, StructType.fromDDL(KV)).count() == 3


def test_replace_period_is_repeatable_and_can_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    april = kv(spark, (1, "a", "2026-04"), (2, "late", "2026-03"))
    may = kv(spark, (3, "c", "2026-05"))
    schema = f"{KV}, {LOAD_PERIOD} string"
    for _ in range(2):
        replace_period(april, path, "2026-04", ["p"], cluster_by=["id"])
        replace_period(may, path, "2026-05", ["p"], cluster_by=["id"])
    assert content(spark, path, schema) == [(1, "a", "2026-04"), (2, "late", "2026-03"), (3, "c", "2026-05")]
    replace_period(april.filter("false"), path, "2026-04", ["p"], cluster_by=["id"])
    assert content(spark, path, schema) == [(3, "c", "2026-05")]


def test_period_folder_prunes_files(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(kv(spark, (1, "a", "2026-04"), (2, "b", "2026-05")), path, "p")
    df = spark.read.schema(KV).parquet(path).filter("p = '2026-04'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p#" in plan and df.count() == 1


def test_replace_partitions_touches_only_those_in_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(kv(spark, (1, "a", "x"), (2, "b", "y")), path, "p")
    replace_partitions(kv(spark, (9, "z", "y")), path, "p")
    assert content(spark, path) == [(1, "a", "x"), (9, "z", "y")]


def test_ensure_table_creates_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    ensure_table(spark, path, RAW_ZONE)
    assert read_table(spark, path, RAW_ZONE).count() == 0
    write_mart(spark.createDataFrame([(1, "b", "z", "s")], RAW_ZONE), path)
    ensure_table(spark, path, RAW_ZONE)
    assert read_table(spark, path, RAW_ZONE).count() == 1


def test_reading_trips_conforms_types_and_fails_without_files(spark, tmp_path):
    folder = str(tmp_path / "trips")
    spark.range(3).select(
        F.col("id").cast("int").alias("vendorid"), F.lit(2).cast("double").alias("passenger_count"), F.lit("x").alias("other")
    ).write.parquet(folder)
    df = read_trips_dir(spark, folder)
    assert df.schema.simpleString() == RAW_TRIP.simpleString()
    assert df.agg(F.sum("passenger_count"), F.count("fare_amount"), F.sum("VendorID")).first()[:3] == (6, 0, 3)
    (tmp_path / "empty").mkdir()
    for missing in ("empty", "absent"):
        with pytest.raises(FileNotFoundError):
            read_trips_dir(spark, str(tmp_path / missing))


def test_reading_zones(spark, tmp_path):
    file = tmp_path / "zones.csv"
    file.write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n265,"N/A","Outside of NYC","N/A"\n')
    assert read_zones(spark, str(file)).collect()[1]["Borough"] == "N/A"
    assert read_zones(spark, str(file), null_value="N/A").collect()[1]["Borough"] is None
    assert read_zones(spark, str(file)).schema == RAW_ZONE


def test_select_to_schema(spark):
    df = spark.sql("select 1 as extra, '7' as LocationID")
    out = select_to_schema(df, RAW_ZONE)
    assert out.columns == RAW_ZONE.fieldNames() and tuple(out.first()) == (7, None, None, None)


def test_broadcast_only_when_small(spark):
    small = broadcast_if_bounded(spark.range(10), 10)
    large = broadcast_if_bounded(spark.range(11), 10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_the_wanted_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "z")), path, ["id"], "p")
    some = versions.read_versions(spark, path, StructType.fromDDL(KV), [versions.folder_name("p", v) for v in ("x", None, "absent")])
    assert sorted(r["id"] for r in some.collect()) == [1, 3]
    assert all("p=y" not in f and "p=z" not in f for f in some.inputFiles())


def test_upsert_keeps_rows_without_partition_value(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", None), (2, "b", "x")), path, ["id"], "p")
    upsert(kv(spark, (3, "c", None), (1, "A", None)), path, ["id"], "p")
    got = read_table(spark, path, StructType.fromDDL(KV)).collect()
    assert sorted((r["id"], r["v"], r["p"]) for r in got) == [(1, "A", None), (2, "b", "x"), (3, "c", None)]


@pytest.mark.parametrize("step", ["in the write", "before the manifest", "before its rename"])
def test_partitioned_upsert_cut_short_anywhere(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    upsert(kv(spark, *rows), path, ["id"], "p")
    source = kv(spark, (1, "A", "x"), (2, "B", "y"), (9, "n", "w"))
    want = [(1, "A", "x"), (2, "B", "y"), (3, "c", "z"), (9, "n", "w")]
    with monkeypatch.context() as patch:
        failing = source
        if step == "in the write":
            failing = source.withColumn("v", F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
        elif step == "before the manifest":
            patch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        else:

            def half(fs, file, text):
                whole(fs, file, text[: len(text) // 2])
                raise RuntimeError("lost")

            whole = versions._write_text
            patch.setattr(versions, "_write_text", half)
        with pytest.raises(Exception, match="lost"):
            upsert(failing, path, ["id"], "p")
    assert content(spark, path) == rows
    for _ in range(2):
        upsert(source, path, ["id"], "p")
        assert content(spark, path) == want
    assert versions.remove_unreferenced(spark, path, keep=1) >= 1
    assert content(spark, path) == want
    assert len(list((tmp_path / "t").glob("version=*"))) == len(set(versions.read_manifest(spark, path)[1].values()))


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(kv(spark, (1, "a", "x")), path, ["id"], "p")
    number, manifest = versions.read_manifest(spark, path)
    upsert(kv(spark, (2, "b", "y")), path, ["id"], "p")
    with pytest.raises(versions.ConcurrentWriteError):
        versions.commit(spark, path, number, manifest)
    assert content(spark, path) == [(1, "a", "x"), (2, "b", "y")]


def test_partition_values_that_folders_escape(spark, tmp_path):
    path, odd = str(tmp_path / "t"), ["a/b", "x=y", "10:30", "50%", "ü ?", "__x"]
    upsert(kv(spark, *[(k, "old", p) for k, p in enumerate(odd)]), path, ["id"], "p")
    upsert(kv(spark, *[(k + 100, "new", p) for k, p in enumerate(odd)]), path, ["id"], "p")
    assert content(spark, path) == sorted([(k, "old", p) for k, p in enumerate(odd)] + [(k + 100, "new", p) for k, p in enumerate(odd)])


def test_partitioned_upsert_writes_its_source_once(spark, tmp_path, monkeypatch):
    from farelens.sources import tables

    path, written = str(tmp_path / "t"), []
    whole = versions.write_version
    monkeypatch.setattr(versions, "write_version", lambda df, *a, **k: written.append(df.count()) or whole(df, *a, **k))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "materialize", lambda *_: pytest.fail("the source is stored besides"))
        upsert(kv(spark, (1, "a", "x"), (2, "b", "y"), (None, "c", "y"), (None, "d", "y")), path, ["id"], "p")
        upsert(kv(spark, (2, "B", "y"), (3, "e", "z")), path, ["id"], "p")
    # The second source, then the merged rows of the one partition that was there before.
    assert written == [4, 2, 3]
    rows = {(r["id"], r["v"], r["p"]) for r in read_table(spark, path, StructType.fromDDL(KV)).collect()}
    assert rows == {(1, "a", "x"), (2, "B", "y"), (None, "c", "y"), (None, "d", "y"), (3, "e", "z")}


def test_refused_first_upsert_leaves_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(DuplicateKeyError, match="'id': 1"):
        upsert(kv(spark, (1, "a", "x"), (1, "b", "y")), path, ["id"], "p")
    assert not list((tmp_path / "t").glob("version=*"))
    # Empty text and NULL fall into one folder, yet they are different keys.
    upsert(kv(spark, (1, "a", ""), (1, "b", None), (1, "c", "x")), path, ["id", "p"], "p")
    assert read_table(spark, path, StructType.fromDDL(KV)).count() == 3


def test_repeated_keys_are_found_among_many(spark, monkeypatch):
    from farelens.sources import tables

    # The hash is only a filter: one that repeats without a repeated key refuses nothing.
    monkeypatch.setattr(tables.F, "xxhash64", lambda *_: F.lit(1))
    tables.refuse_repeats(spark.range(50), ["id"])
    for most in (1, 1_000):
        monkeypatch.setattr(tables, "MOST_HASHES", most)
        with pytest.raises(DuplicateKeyError):
            tables.refuse_repeats(spark.range(50).unionAll(spark.range(7, 8)), ["id"])
