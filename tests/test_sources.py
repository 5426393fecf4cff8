"""CSV reading, load history and the table store."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.values import amount
from stratalake.session import work_root
from stratalake.sources.csv_layer import physical_schema, read_csv_layer
from stratalake.sources.ledger import FileLoader, file_in, glob_for, list_files, new_files
from stratalake.sources.staging import stage, stage_scope
from stratalake.sources.store import TableStore

COLS = ["id", "name", "money"]
SCHEMA = physical_schema(COLS, padding=2)
STAMP = "2024-06-01 00:00:00"
RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*COLS, "file_name"]] + [T.StructField("load_timestamp", T.TimestampType())]
)


def stamp():
    return F.lit(STAMP).cast("timestamp")


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id,name,money,,\r\n" + "".join(x + "\r\n" for x in lines), newline="")


def read(spark, folder, **kw):
    return read_csv_layer(spark, str(folder), SCHEMA, COLS, stamp(), **kw)


def test_cells(spark, tmp_path):
    write(tmp_path / "f", "a.csv", '1,"a, b",  7 ,,', "NULL,null,,,", '2,"say ""hi""",NULL,,', ",,,,", "3,  x ,1,,")
    good, bad = read(spark, tmp_path / "f")
    got = sorted((tuple(r)[:3] for r in good.collect()), key=repr)
    assert got == [("1", "a, b", "7"), ("2", 'say "hi"', None), ("3", "x", "1"), (None, None, None), (None, None, None)]
    assert bad.count() == 0
    row = good.first()
    assert row.file_name == "a.csv" and str(row.load_timestamp) == STAMP


def test_bad_lines(spark, tmp_path):
    write(tmp_path / "f", "a.csv", "1,a,5,,", "2,b", "3,c,5,,,,,", '4,"open,5,,', "5,much too long,5,,")
    good, bad = read(spark, tmp_path / "f", limits={"name": 10}, short_lines="reject")
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted(r.line[0] for r in bad.collect()) == ["2", "3", "4", "5"]
    assert good.count() == 1 and good.select("file_name").count() == 1  # whatever columns are read
    good, bad = read(spark, tmp_path / "f")
    assert sorted((r.id, r.name, r.money) for r in good.collect()) == [
        ("1", "a", "5"),
        ("2", "b", None),
        ("3", "c", "5"),
        ("5", "much too long", "5"),
    ]
    assert bad.count() == 1
    with pytest.raises(ValueError):
        read(spark, tmp_path / "f", short_lines="?")


def test_cast_while_loading(spark, tmp_path):
    write(tmp_path / "f", "a.csv", "1,a,5.555,,", "2,b,five,,")
    columns = {"id": None, "money": amount("money")}
    good, _ = read_csv_layer(spark, str(tmp_path / "f"), SCHEMA, columns, stamp())
    assert good.columns == ["id", "money", "file_name", "load_timestamp"]
    assert [str(r.money) for r in good.orderBy("id").collect()] == ["5.56", "None"]


def test_load_history(spark, tmp_path, root):
    folder = tmp_path / "f"
    write(folder, "visits_1.csv", "1,a,5,,")
    write(folder, "other.csv", "9,z,5,,")
    store = TableStore(spark, root)
    store.create("raw", "v", RAW)
    loader = FileLoader(store)

    def load(path, **kw):
        n = loader.load("raw", "v", path, SCHEMA, COLS, stamp(), **kw)
        return n, store.read("raw", "v").count()

    prefix = glob_for(str(folder), "visits")
    assert load(prefix) == (1, 1)
    assert load(prefix) == (0, 1)
    write(folder, "visits_2.csv", "2,b,5,,", 'bad,"open,5,,')
    assert load(prefix) == (1, 2)
    assert [r.line[:3] for r in loader.rejected("raw", "v").collect()] == ["bad"]
    assert store.marks("raw", "v")["set_aside"] == 1 and store.marks("raw", "v")["files"] == 1
    assert load(prefix, force=True) == (2, 4)
    write(folder, "visits_1.csv", "1,a,5,,", "3,c,5,,")  # a changed file is a new file
    assert load(prefix) == (1, 6)
    assert load(file_in(str(folder), "other.csv")) == (1, 7)
    assert load(file_in(str(folder), "absent.csv")) == (0, 7)
    assert loader.history("raw", "other").count() == 0 and loader.history("raw", "v").count() == 6
    store.truncate("raw", "v")
    assert load(prefix) == (2, 3) and load(prefix) == (0, 3)
    listing = list_files(spark, str(folder))
    assert listing.count() == 3 and new_files(listing, loader.history("raw", "v")).count() == 1  # not loaded since


def test_create_append_replace(spark, root):
    store = TableStore(spark, root)
    with pytest.raises(LookupError):
        store.read("a", "t")
    schema = T.StructType().add("k", "long").add("v", "string")
    store.create("a", "t", schema)
    store.append("a", "t", spark.createDataFrame([("x", 1)], "v string, k int"))
    store.publish("a", "t", store.read("a", "t").withColumn("v", F.upper("v")))  # reads what it replaces
    assert store.read("a", "t").collect() == [(1, "X")]
    store.drop_column("a", "t", "v")
    assert store.read("a", "t").columns == ["k"]
    store.truncate("a", "t")
    assert store.read("a", "t").count() == 0
    store.register_view("a", "t")
    assert spark.sql("select * from a_t").columns == ["k"]
    assert TableStore(spark, root).exists("a", "t") and not store.exists("a", "u")


def test_a_write_that_died_leaves_the_old_content(spark, root):
    store = TableStore(spark, root)
    store.create("a", "t", T.StructType().add("k", "long"))
    store.publish("a", "t", spark.range(5).select(F.col("id").alias("k")))
    spark.range(9).select(F.col("id").alias("k")).write.parquet(f"{root}/a/t/__write=died/__side=rows")  # no pointer followed
    Path(f"{root}/a/t/pointer-0.json").write_text('{"turn": 9, "wri')  # or the slot was not written to its end
    store.refresh()
    assert store.read("a", "t").count() == 5
    store.publish("a", "t", spark.range(3).select(F.col("id").alias("k")))
    assert store.read("a", "t").count() == 3


class Died(Exception):
    pass


def _dies_at_the_pointer(store, monkeypatch, table):
    """The next pointer of the table is not written."""
    real = TableStore._point

    def point(self, layer, name, *args, **kwargs):
        if name == table:
            raise Died
        return real(self, layer, name, *args, **kwargs)

    monkeypatch.setattr(TableStore, "_point", point)


def test_a_merge_that_died_is_done_again(spark, root, monkeypatch):
    """Dead after all files are written, and again after only some are."""
    store = TableStore(spark, root)
    rows = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("old").alias("v"))
    store.create("a", "t", rows.schema, parts=4, part_keys=["k"])
    store.merge("a", "t", rows, ["k"])
    delta = spark.range(90, 120).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("new").alias("v"))
    with monkeypatch.context() as m:
        _dies_at_the_pointer(store, m, "t")
        with pytest.raises(Died):
            store.merge("a", "t", delta, ["k"])
    store = TableStore(spark, root)
    assert store.read("a", "t").count() == store.rows("a", "t") == 100 and store.read("a", "t").where("v = 'new'").count() == 0
    store.merge("a", "t", delta, ["k"])
    again = TableStore(spark, root)
    assert again.read("a", "t").count() == again.rows("a", "t") == 120 and again.read("a", "t").where("v = 'new'").count() == 30


@pytest.mark.parametrize("table", ["v", "load_ledger"])
def test_a_load_that_died_repeats_no_row(spark, tmp_path, root, monkeypatch, table):
    """Dead between the files' note and the rows, or before the note: rows and rejected lines come once."""
    folder = tmp_path / "f"
    write(folder, "visits_1.csv", "1,a,5,,", 'bad,"open,5,,')
    store = TableStore(spark, root)
    store.create("raw", "v", RAW)
    load = lambda: FileLoader(store).load("raw", "v", glob_for(str(folder), "visits"), SCHEMA, COLS, stamp())
    FileLoader(store)
    for _ in range(2):
        with monkeypatch.context() as m:
            _dies_at_the_pointer(store, m, table)
            with pytest.raises(Died):
                load()
        store.refresh()
        assert store.read("raw", "v").count() == 0 and FileLoader(store).rejected("raw", "v").count() == 0
    assert load() == 1 and load() == 0
    assert store.read("raw", "v").count() == 1 and FileLoader(store).rejected("raw", "v").count() == 1
    assert FileLoader(store).history("raw", "v").count() == 1


def test_old_files_go(spark, root):
    store = TableStore(spark, root)
    store.create("a", "t", T.StructType().add("k", "long"))
    for n in range(6):
        store.publish("a", "t", spark.range(n + 1).select(F.col("id").alias("k")))
    kept = [p for p in Path(f"{root}/a/t").glob("__write=*/__side=*")]
    assert len(kept) == 2 and store.read("a", "t").count() == 6  # the present ones, and those before for whoever still reads


def test_many_listed_files_few_new(spark, tmp_path, root):
    """A hundred thousand files listed, three to load: no list of paths goes to the reader, and old files are not opened."""
    folder = tmp_path / "f"
    folder.mkdir()
    for i in range(100_000):
        (folder / f"visits_{i}.csv").touch()
    new = [folder / f"visits_{i}.csv" for i in (7, 50_000, 99_999)]
    old = list_files(spark, str(folder)).where(~F.col("path").rlike("visits_(7|50000|99999)[.]csv"))
    store = TableStore(spark, root)
    store.create("raw", "v", RAW)
    loader = FileLoader(store)
    known = old.select("*", F.lit("raw.v").alias("target"), stamp().alias("load_timestamp"))
    store.append("raw", "load_ledger", known, "before")
    store.append("raw", "v", spark.createDataFrame([], RAW), "before", {"files": 99_997})
    later = max(p.stat().st_mtime for p in folder.iterdir()) + 100
    for i, path in enumerate(new):
        path.write_text(f"id,name,money,,\n{i},a,5,,\n")
        os.utime(path, (later, later))
    assert loader.load("raw", "v", str(folder), SCHEMA, COLS, stamp()) == 3
    assert sorted(r.id for r in store.read("raw", "v").collect()) == ["0", "1", "2"]
    assert loader.load("raw", "v", str(folder), SCHEMA, COLS, stamp()) == 0


def test_names_with_odd_characters(spark, tmp_path, root):
    folder = tmp_path / "a b"
    write(folder, "visits 1%20#x.csv", "1,a,5,,")
    store = TableStore(spark, root)
    store.create("raw", "v", RAW)
    load = lambda: FileLoader(store).load("raw", "v", str(folder), SCHEMA, COLS, stamp())
    assert load() == 1 and load() == 0
    assert [r.file_name for r in store.read("raw", "v").collect()] == ["visits%201%2520%23x.csv"]  # as in a URL


QUOTED = [
    'id,name,money,,', '1,"one', 'two",5,,', '2,plain,6,,', '', '3,"a ""quoted""', '', ', word",7,,', '4,"x",8,,', '5,"long' + '\n-' * 80 + '",9,,', '6,,"",,',
]


@pytest.mark.parametrize("size", ["25", "1m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_ends_inside_quotes_wherever_the_file_is_split(spark, tmp_path, size, end):
    folder = tmp_path / "f"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        (folder / name).write_bytes(end.join(QUOTED * 1 + [line.replace("plain", name) for line in QUOTED[1:]] + ['9,last,1,,']).encode())
    one_task = spark.read.schema(SCHEMA).options(header=True, multiLine=True, escape='"').csv(str(folder))
    clean = lambda x: x if x is None or x.strip() else None
    want = sorted((r.id, clean(r.name), clean(r.money)) for r in one_task.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        good, bad = read(spark, folder, multi_line=True)
        got = sorted((r.id, r.name, r.money) for r in good.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(a, b and b.replace("\r\n", "\n"), c) for a, b, c in got] == [(a, b and b.replace("\r\n", "\n"), c) for a, b, c in want]
    assert bad.count() == 0 and {r.file_name for r in good.select("file_name").distinct().collect()} == {"a.csv", "b.csv"}


def test_a_quote_that_is_never_closed(spark, tmp_path):
    write(tmp_path / "f", "a.csv", "1,a,5,,", '2,"open,5,,', "3,b,5,,")
    good, bad = read(spark, tmp_path / "f", multi_line=True)
    assert [r.id for r in good.collect()] == ["1"] and bad.count() == 1


def _written(root):
    """The files that the table's pointer names."""
    pointer = max((json.loads(p.read_text()) for p in Path(f"{root}/a/t").glob("pointer-*.json")), key=lambda p: p["turn"])
    return {f: f.stat().st_mtime_ns for w in pointer["writes"] for f in Path(f"{root}/a/t/{w['path']}").glob("*.parquet")}


def test_merge_writes_only_the_folders_it_touches(spark, root):
    store = TableStore(spark, root)
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("old").alias("v"))
    store.create("a", "t", rows.schema, parts=200, part_keys=["k"])
    store.merge("a", "t", rows, ["k"])
    before = _written(root)
    assert len(before) == 200  # a file each
    delta = spark.range(19_990, 20_050).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("new").alias("v"))
    store.merge("a", "t", delta, ["k"])
    after = _written(root)
    kept = [p for p in before if after.get(p) == before[p]]
    touched = delta.select(F.pmod(F.xxhash64("k"), F.lit(200))).distinct().count()
    assert len(after) == 200 and len(kept) == 200 - touched > 100
    got = store.read("a", "t")
    assert got.count() == 20_050 and got.where("v = 'new'").count() == 60
    store.merge("a", "t", delta, ["k"])  # once more changes nothing
    assert store.read("a", "t").count() == 20_050
    assert len({f.split("/__part=")[1].split("/")[0] for f in store.matching("a", "t", delta.limit(1), ["k"]).inputFiles() if "__part=" in f}) == 1
    large = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("all").alias("v"))
    store.merge("a", "t", large, ["k"])
    assert len(_written(root)) == 200 and store.read("a", "t").where("v = 'all'").count() == 30_000


def test_stage_scope_releases_files(spark):
    with stage_scope(spark):
        inside = stage(spark.range(10), "s")
        with stage_scope(spark):
            inner = stage(inside, "s")
        assert inside.count() == 10 and inner.count() == 10
    assert not Path(inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]).exists()
    outside = stage(spark.range(3), "s")
    assert outside.count() == 3


def test_staging_leaves_no_shuffle_files(spark):
    """What was shuffled for a staged table goes when it is written."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {str(x) for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllBlocks()) if "shuffle_" in str(x)}
    before = shuffles()
    stage(spark.range(1000).repartition(5, "id"), "dealt")
    for _ in range(50):  # they are removed in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before


def test_loads_and_marks(spark, root):
    store = TableStore(spark, root)
    store.create("a", "t", T.StructType().add("k", "long"))
    assert store.loads("a", "t") == [] and store.marks("a", "t") == {}
    one = spark.range(1).select(F.col("id").alias("k"))
    store.append("a", "t", one, "first", {"seen": 5})
    found = store.append("a", "t", one.union(one), "second", {"seen": 7}, measures={"most": F.max("k")})
    assert found["rows"] == 2 and store.marks("a", "t") == {"seen": 7, "most": 0} and store.loads("a", "t") == ["first", "second"]
    assert store.read("a", "t").count() == store.rows("a", "t") == 3
    assert store.read("a", "t", loads={"second"}).count() == 2 and store.read("a", "t", loads=set()).count() == 0
    store.append("a", "t", one.where("false"), "third")
    assert store.loads("a", "t") == ["first", "second"]
    store.mark("a", "t", {"more": [1]})
    assert TableStore(spark, root).marks("a", "t")["more"] == [1]
    with pytest.raises(ValueError):
        store.create("a", "p", T.StructType().add("k", "long"), parts=2, part_keys=["k"])
        store.append("a", "p", one)


def test_work_root_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or work_root(spark) == shared.rstrip("/")


def test_fold_in_is_whole_or_not_at_all(spark, root):
    store = TableStore(spark, root)
    rows = lambda a, b, v: spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(v).alias("v"))
    store.create("a", "t", rows(0, 1, "").schema, parts=4, part_keys=["k"])
    store.fold_in("a", "t", rows(0, 100, "old"), ["k"], set(), lambda: {"n": 1})
    before = _written(root)

    def broken():
        raise ValueError("broken")

    with pytest.raises(ValueError):
        store.fold_in("a", "t", rows(50, 150, "new"), ["k"], range(4), broken)
    store.fold_in("a", "t", rows(0, 0, "none"), ["k"], range(4), lambda: None)
    assert _written(root) == before and len(list(Path(f"{root}/a/t").glob("__write=*"))) == 1
    store.fold_in("a", "t", rows(50, 150, "new"), ["k"], range(4), lambda: {"n": 2})
    assert store.marks("a", "t") == {"n": 2} and store.rows("a", "t") == 150
    assert {r.k: r.v for r in store.read("a", "t").collect()} == {f"k{i}": "old" if i < 50 else "new" for i in range(150)}
