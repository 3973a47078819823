"""CSV files read in many tasks equal the same files read whole."""

import csv
import random

import pytest

from lakesmith.operators.layers import Layer, Table
from lakesmith.sources import csv as source
from lakesmith.sources.tables import ROW_ORDER, in_written_order, read_layer, read_table, write_layer


def _write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=quoting).writerows(rows)


def _rows(df):
    return [tuple(r) for r in df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _texts(seed, n):
    rng = random.Random(seed)
    parts = ["plain", 'say ""', "a,b", "line\nbreak", "two\n\nbreaks", '"', "é", " padded ", "NULL", "12", "\n", ",", ""]
    return [[str(i), "".join(rng.choices(parts, k=rng.randint(0, 6))), rng.choice(["x", "y,z", "", 'q"uote'])] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_records_over_many_lines_and_splits(spark, tmp_path, small_splits, end, quoting):
    folder = tmp_path / "many"
    folder.mkdir()
    for part in range(2):
        _write(folder / f"part-{part}.csv", [["id", "text", "other"], *_texts(part, 200)], end, quoting)
    split = source._joined_records(spark, str(folder))
    assert split is not None and spark.read.text(str(folder)).rdd.getNumPartitions() > 8
    assert _rows(split) == _rows(source.read_raw_csv(spark, str(folder), multi_line=True))
    assert _rows(source.read_raw_csv(spark, str(folder))) == _rows(split)


def test_one_long_record_over_all_splits(spark, tmp_path, small_splits):
    path = str(tmp_path / "long.csv")
    _write(path, [["id", "text"], ["1", "short"], ["2", "\n".join(f"line {i}, with \"quotes\"" for i in range(500))], ["3", "end"]])
    got = _rows(source.read_raw_csv(spark, path))
    assert got == _rows(source.read_raw_csv(spark, path, multi_line=True)) and len(got) == 3


def test_plain_lines_are_split_by_spark_itself(spark, tmp_path, small_splits):
    path = str(tmp_path / "plain.csv")
    _write(path, [["id", "v"], *[[str(i), f"v {i}"] for i in range(1000)]])
    df = source.read_raw_csv(spark, path)
    assert df.rdd.getNumPartitions() > 8 and _rows(df) == [(str(i), f"v {i}") for i in range(1000)]


def test_quotes_inside_plain_fields_fall_back_to_the_whole_file(spark, tmp_path, small_splits):
    path = str(tmp_path / "inch.csv")
    with open(path, "w") as f:
        f.write('id,size\n1,5" disk\n2,"two\nlines"\n3,7" 8" tape\n')
    assert source._joined_records(spark, path) is None
    assert _rows(source.read_raw_csv(spark, path)) == _rows(source.read_raw_csv(spark, path, multi_line=True))


def test_written_layers_hold_no_row_order_and_keep_it(spark, tmp_path):
    folder = str(tmp_path / "src")
    for n, size in enumerate((50, 700, 3)):  # several files of different sizes
        (spark.range(size).selectExpr(f"{n} AS file_no", "id AS v").coalesce(1).write.mode("append" if n else "overwrite").parquet(folder))
    df = read_table(spark, folder)
    want = [tuple(r) for r in df.orderBy(ROW_ORDER).select("file_no", "v").collect()]
    assert in_written_order(df) is not df
    paths, rows = write_layer({"t_bronze": df}, str(tmp_path), "r", "bronze")
    assert rows == {"t_bronze": 753} and ROW_ORDER not in spark.read.parquet(paths["t_bronze"]).columns
    back = read_layer(spark, paths)["t_bronze"]
    assert [tuple(r) for r in back.orderBy(ROW_ORDER).select("file_no", "v").collect()] == want
    keyed = back.drop(ROW_ORDER).selectExpr("753 - v - 100 * file_no AS pk_t_silver_id", "v")
    layer = Layer()
    layer.add("t_silver", Table.keyed(lambda: keyed))
    paths, _ = write_layer(layer, str(tmp_path), "r", "silver")
    order = [r["pk_t_silver_id"] for r in read_layer(spark, paths)["t_silver"].orderBy(ROW_ORDER).collect()]
    assert order == sorted(order)
