from __future__ import annotations

import os

import pytest

from casaframe.sources.readers import missing_to_null, read_csv, read_tabular


def _write(tmp_path, name, text):
    p = os.path.join(str(tmp_path), name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_csv_missing_tokens_and_inference(spark, tmp_path):
    p = _write(tmp_path, "h.csv",
               "Order,Lot Frontage,Neighborhood,Gr Liv/Area,Note\n"
               "1,NA,NAmes,1500,None\n2,60.5,null,1600,x\n3,,N/A,1700,NaN\n")
    df = read_csv(spark, p)
    assert df.columns == ["order", "lot_frontage", "neighborhood", "gr_liv_area", "note"]
    types = dict(df.dtypes)
    assert types["order"] == "bigint" and types["lot_frontage"] == "double"
    assert types["gr_liv_area"] == "bigint" and types["neighborhood"] == "string"
    rows = {r.order: r for r in df.collect()}
    assert rows[1].lot_frontage is None and rows[1].neighborhood == "NAmes"  # NAmes survives
    assert rows[2].neighborhood is None and rows[3].neighborhood is None
    assert rows[1].note is None and rows[3].note is None and rows[2].note == "x"


def test_csv_with_declared_schema(spark, tmp_path):
    from pyspark.sql import types as T

    p = _write(tmp_path, "s.csv", "a,b\n1,2.5\nx,NA\n")
    sch = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    rows = read_csv(spark, p, schema=sch).collect()
    assert [(r.a, r.b) for r in rows] == [(1, 2.5), (None, None)]


def test_read_tabular_dispatch(spark, tmp_path):
    p = _write(tmp_path, "d.CSV", "a\n1\n")
    assert read_tabular(spark, p).first().a == 1
    pq = os.path.join(str(tmp_path), "d.parquet")
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(pq)
    assert sorted(r.x is None for r in read_tabular(spark, pq).collect()) == [False, True]
    with pytest.raises(FileNotFoundError):
        read_tabular(spark, os.path.join(str(tmp_path), "absent.csv"))
    bad = _write(tmp_path, "d.txt", "a\n")
    with pytest.raises(ValueError):
        read_tabular(spark, bad)


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "NA"), (1.0, "NAmes")], "x double, s string")
    rows = missing_to_null(df).collect()
    assert rows[0].x is None and rows[0].s is None and rows[1].s == "NAmes"


def test_text_number_guard(spark):
    from casaframe.functions.exprs import to_double

    df = spark.createDataFrame([(" 12 ",), ("1d",), ("1_0",), ("nan",), ("-1.5e2",), (".5",)], "s string")
    got = [r[0] for r in df.select(to_double("s", df.schema["s"].dataType)).collect()]
    assert got == [12.0, None, None, None, -150.0, 0.5]


def test_raw_table_ddl_runs(spark, tmp_path):
    from casaframe.sources.sinks import raw_table_ddl

    ddl = raw_table_ddl("props_raw_ddl_test", str(tmp_path / "t"))
    assert "`saleprice` INT NOT NULL" in ddl and "USING parquet" in ddl
    spark.sql(ddl)
    assert "lot_frontage" in spark.table("props_raw_ddl_test").columns
    spark.sql("DROP TABLE props_raw_ddl_test")


def test_rounding_and_integer_casts(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    # Spark rounds half up on the decimal text (2.675 -> 2.68), unlike Python's round
    assert spark.range(1).select(F.round(F.lit(2.675), 2)).first()[0] == 2.68
    # text to integer columns is rounded before the cast, never truncated
    p = _write(tmp_path, "i.csv", "a\n2.7\n-2.7\n")
    sch = T.StructType([T.StructField("a", T.IntegerType())])
    assert [r.a for r in read_csv(spark, p, schema=sch).collect()] == [3, -3]


def test_worker_functions_ship_by_value():
    # executors must not need the package installed: its functions are pickled by value
    import pickle

    import casaframe
    from pyspark import cloudpickle

    from casaframe.operators import drift

    assert cloudpickle.cloudpickle._is_registered_pickle_by_value(casaframe)
    blob = cloudpickle.dumps(drift.one_sample_sf)
    assert pickle.loads(blob)(1, 0.75) == pytest.approx(0.5)


def test_csv_keeps_quotes_line_breaks_and_wide_numbers(spark, tmp_path):
    from casaframe.sources.readers import apply_schema, read_csv
    from casaframe.sources.sinks import write_csv
    from pyspark.sql import types as T

    path = tmp_path / "odd.csv"
    path.write_text('t,n,wide,flag,gone\n"say ""hi"", ok",1,12345678901234567890,True,\n'
                    '"two\nlines",9007199254740993,2,false,\n')
    df = read_csv(spark, str(path))
    assert dict(df.dtypes) == {"t": "string", "n": "bigint", "wide": "decimal(38,0)",
                               "flag": "boolean", "gone": "double"}
    rows = {r.n: r for r in df.collect()}
    assert rows[1].t == 'say "hi", ok' and int(rows[1].wide) == 12345678901234567890
    assert rows[9007199254740993].t == "two\nlines"
    text = spark.createDataFrame([("9007199254740993",), ("2.6",), ("x",)], "n string")
    got = apply_schema(text, T.StructType([T.StructField("n", T.LongType())])).collect()
    assert [r.n for r in got] == [9007199254740993, 3, None]
    back = read_csv(spark, write_csv(df.select("t", "n"), str(tmp_path / "out")))
    assert {(r.t, r.n) for r in back.collect()} == {(r.t, r.n) for r in df.collect()}


# ------------------------------------------------------------------ quoted CSV by many tasks

@pytest.fixture
def small_splits(spark):
    """Splits of 600 bytes, so that a small file has many."""
    conf = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _one_task(spark, path):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path))


def _bag(df):
    return sorted(map(tuple, df.collect()), key=str)


CELLS = ["plain", "", "two\nlines", "a,b", 'say ""hi""', "\n\n", "x" * 700, 'end""', "é ü", '""', "a\r\nb",
         "l1\nl2,\nl3 ""q"" \n", " lead", '""\n""']


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_split_csv_equals_the_one_task_reader(small_splits, tmp_path, seed, end):
    import random
    rng = random.Random(seed)
    rows = []
    for k in range(120):
        cells = [rng.choice(CELLS) for _ in range(3)]
        shown = [f'"{c}"' if rng.random() < .5 or set(c) & set(',\n"\r') else c for c in cells]
        rows.append(",".join([str(k), *shown]))
        if rng.random() < .1:
            rows.append("")
    head = 'id,a,"b\nname",c' if seed == 3 else "id,a,b,c"
    path = str(tmp_path / "t.csv")
    with open(path, "w", newline="") as f:
        f.write(end.join([head, *rows]) + (end if seed != 2 else ""))
    raw = read_csv(small_splits, path, infer=False, normalize=False, tokens=[])
    assert raw.rdd.getNumPartitions() > 1 and "MultiLine" not in raw._jdf.queryExecution().toString()
    want = _one_task(small_splits, path)
    assert raw.columns == want.columns
    assert _bag(raw) == _bag(want) and want.count() == 120


def test_split_csv_reads_the_file_in_many_tasks(small_splits, tmp_path):
    from casaframe.sources.csv_records import _lines
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("id,text\n" + "".join(f'{k},"first {k}\nsecond, ""line"""\n' for k in range(300)))
    assert _lines(small_splits, [path]).rdd.getNumPartitions() >= 8
    got = read_csv(small_splits, path)
    assert dict(got.dtypes) == {"id": "bigint", "text": "string"}
    assert sorted(map(tuple, got.collect())) == [(k, f'first {k}\nsecond, "line"') for k in range(300)]


def test_split_csv_with_quotes_inside_plain_cells(small_splits, tmp_path):
    """A quote counts only where a cell starts with it: a stray one does not swallow lines."""
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("id,size,text\n" + "".join(f'{k},5" pipe,"a\n{k}"\n{k + 1000},x, "y\n' for k in range(80)))
    got = read_csv(small_splits, path, infer=False, tokens=[])
    assert _bag(got) == _bag(_one_task(small_splits, path)) and got.count() == 160


def test_large_and_small_files_of_one_folder(small_splits, tmp_path):
    for name, n in (("a", 3), ("b", 200), ("c", 90)):
        with open(tmp_path / f"{name}.csv", "w") as f:
            f.write("k,t\n" + "".join(f'{name}{k},"x\n{k}"\n' for k in range(n)))
    got = read_csv(small_splits, str(tmp_path), infer=False)
    assert _bag(got) == _bag(_one_task(small_splits, str(tmp_path))) and got.count() == 293


# ------------------------------------------------------------------ atomic publication

def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F

    from casaframe.sources import snapshots as S
    path = str(tmp_path / "t")
    assert S.publish(spark.range(10), path) == 1
    broken = spark.range(1000).repartition(4).withColumn(
        "id", F.when(F.col("id") == 977, F.raise_error(F.lit("disk full"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="disk full"):
        S.publish(broken, path)
    assert S.read_published(spark, path).count() == 10
    old = S.read_published(spark, path)
    assert S.publish(old.where("id < 4"), path) == 2          # from the table to itself
    assert S.read_published(spark, path).count() == 4 and old.count() == 10
    assert S.publish(spark.range(2), path) == 3
    assert S.expire(spark, path, keep=2) == 1 and S.read_published(spark, path).count() == 2
    assert S.current(spark, str(tmp_path / "none")) is None


def test_an_unfinished_manifest_is_not_read(spark, tmp_path):
    from casaframe.sources import snapshots as S
    path = str(tmp_path / "t")
    S.publish(spark.range(3), path)
    with open(S.numbered(S._manifests(path), 2), "w") as f:
        f.write('{"snapshot": "snap')
    assert S.read_published(spark, path).count() == 3
    assert S.publish(spark.range(5), path) == 3 and S.read_published(spark, path).count() == 5


def test_concurrent_commits_get_their_own_numbers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from casaframe.plans.runlog import RunLog
    from casaframe.sources import snapshots as S
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda k: S.commit(spark, str(tmp_path / "c"), {"k": k}), range(24)))
        log = RunLog(spark, str(tmp_path / "log"))
        versions = list(pool.map(lambda k: log.register_model("m/x", f"run{k}", "p"), range(8)))
    assert sorted(got) == list(range(1, 25)) and sorted(versions) == list(range(1, 9))
    rows = log.versions().collect()
    assert {(r["version"], r["run_id"]) for r in rows} == {(v, f"run{k}") for k, v in enumerate(versions)}
    assert all(r["name"] == "m/x" and r["ts"] is not None for r in rows)
