"""What the findings of round 4 asked for."""

import datetime as dt
import random

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from filinglake.llm import near_dedup
from filinglake.operators import keyed


def test_an_order_may_be_made_of_several_columns(spark):
    rows = spark.createDataFrame([("a", "f2", 1, "x"), ("a", "f1", 2, "y"), ("a", "f1", 3, "z"), ("b", "f9", 9, None)], "k STRING, file STRING, line INT, v STRING")
    by = F.struct("file", "line")
    first, last = keyed.first_per_key(rows, ["k"], by), keyed.last_per_key(rows, ["k"], by, seen=F.count("v"))
    assert first.columns == rows.columns and last.columns == [*rows.columns, "seen"]
    assert {tuple(r) for r in first.collect()} == {("a", "f1", 2, "y"), ("b", "f9", 9, None)}
    assert {tuple(r) for r in last.collect()} == {("a", "f2", 1, "x", 3), ("b", "f9", 9, None, 0)}
    mapped = rows.withColumn("m", F.create_map("k", "v"))
    assert keyed.first_per_key(mapped.where("k = 'a'"), ["k"], by).first().m == {"a": "y"}


def test_copies_in_a_group_weigh_alike_whatever_the_size(spark):
    words = [random.Random(1).choice("abcdefgh") + str(n) for n in range(3000)]

    def text(seed, length):
        draw = random.Random(seed)
        return " ".join(draw.choice(words) for _ in range(length))

    base = text(0, 200).split()
    # Four words of 200 are changed: 176 of 216 shingles are those of the first text, 0.81.
    copies = [" ".join(f"own{n}x{i}" if i % 50 == 8 + n else w for i, w in enumerate(base)) for n in range(30)]
    rows = [(0, " ".join(base)), *((1 + n, t) for n, t in enumerate(copies)), *((100 + n, text(100 + n, 12)) for n in range(3000))]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame).collect()}
    assert {found[n] for n in range(31)} == {0}
    assert all(found[100 + n] == 100 + n for n in range(3000))
    known = near_dedup.frequencies(frame.select("text"))
    assert near_dedup.similarities(pa.array([rows[0][1]]), pa.array([rows[1][1]]), known)[0] > 0.8
    # A shingle of one text and one of many copies weigh the same, boilerplate weighs less.
    hashes = np.array([1, 2, 3], np.uint64)
    counts = np.zeros((near_dedup.DEPTH, near_dedup.CELLS), np.int64)
    for row in range(near_dedup.DEPTH):
        counts[row][near_dedup._cells(hashes, row)] = (1, 9_000, 500_000)
    one, many, common = near_dedup.Frequencies(1_000_000, counts).weights(hashes, np.ones(3))
    assert one == many > common


def test_rows_without_a_side_are_merged(spark, tmp_path):
    days = lambda n: dt.datetime(1997, 1, 1) + dt.timedelta(n)
    orders = [(n, 7, s, days(n), "3-MEDIUM") for n, s in ((21, "F"), (22, None), (23, "P"), (24, None), (25, None))]
    # Order 21 is held and read again without a side, from submissions as before; 24 is held from submissions, but comes from the data set.
    lines = [(21, "F"), (21, None), (22, None), (23, "O"), (24, "F"), (24, None)]
    legs = [(n, 5, 3, i + 1, 2.0, 9.0, 0.0, 0.0, "A", side, days(n)) for i, (n, side) in enumerate(lines)]
    for name, rows, shape in (
        ("customer", [(7, "c")], "c_custkey LONG, c_name STRING"),
        ("orders", orders, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
        (
            "lineitem",
            legs,
            "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
            "l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
        ),
    ):
        spark.createDataFrame(rows, shape).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = queries()["g2_file_merge"](spark, str(tmp_path))
    assert {(r.tbl, r.accession[-2:], r.k[-2:], r.source[4]) for r in found.collect()} == {
        ("filing", "22", "07", "d"), ("filing", "23", "07", "d"), ("filing", "25", "07", "d"), ("filing", "25", "09", "d"),
        ("leg", "21", "v2", "a"), ("leg", "22", "v3", "d"), ("leg", "23", "v4", "d"), ("leg", "24", "v5", "a"),
    }
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in ("customer", "orders", "lineitem"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    cursor = db.execute(oracle_sql()["g2_file_merge"])
    want = [dict(zip([d[0] for d in cursor.description], row, strict=True)) for row in cursor.fetchall()]
    key = lambda row: sorted(map(str, row.items()))
    assert sorted(want, key=key) == sorted((r.asDict() for r in found.collect()), key=key)
