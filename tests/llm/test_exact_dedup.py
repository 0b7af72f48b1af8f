import hashlib
import re

import duckdb
import pandas as pd

from tapelens.llm import exact_dedup, queries


def brute(rows):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for text, group in groups.items():
        best = min(group)
        seen = False
        for member in sorted(group):
            stays = member == best and not seen
            seen |= stays
            out.append((member[3], best[3], len(group), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((None if pd.isna(r.doc_id) else int(r.doc_id), None if pd.isna(r.keep_id) else int(r.keep_id), r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=repr)


def test_odd_rows(odd):
    want = brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert result(exact_dedup.exact_groups(odd.repartition(5))) == want
    assert result(exact_dedup.exact_groups(odd.repartition(13), fan_in=2, slice_size=3)) == want


def test_one_row_stays_of_a_repeated_id(spark):
    """Rows of one id whose texts are equal but for white space, and hot groups, in runs of all sizes."""
    rows = [(5, "a  b"), (5, "a b"), (7, "a b"), (5, "a  b"), (None, "a  b"), (None, None), (None, ""), (8, "c")]
    rows += [(100 + i, " " * (i % 3)) for i in range(3000)] + [(i // 2, f"text {i % 700}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    for fan_in, size in ((2, 100), (8, 10_000)):
        got = exact_dedup.exact_groups(df, fan_in=fan_in, slice_size=size)
        assert result(got) == brute(rows)
        assert got.where("kept").count() == got.select("digest").distinct().count()
    assert exact_dedup.drop_exact_copies(df).count() == 703


def test_sorted_runs_merge():
    import pyarrow as pa

    def run(keys):
        return pa.table({"doc_id": pa.array(range(len(keys)), pa.int64()), "row": pa.array(range(len(keys)), pa.int64()), "key": pa.array([k.to_bytes(40, "big") for k in keys], pa.binary()), "n_chars": pa.array([1] * len(keys), pa.int64()), "n": pa.array([1] * len(keys), pa.int64())})

    got = exact_dedup.merge_two(run([0, 2, 256]), run([1, 2, 3, 512]), "doc_id")
    assert [int.from_bytes(k, "big") for k in got["key"].to_pylist()] == [0, 1, 2, 3, 256, 512] and got["n"].to_pylist() == [1, 1, 2, 1, 1, 1]
    assert exact_dedup.merge_two(run([]), run([4]), "doc_id").num_rows == 1


def test_many_batches(odd, spark):
    """Groups that reach over the batches of a partition."""
    want = brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        assert result(exact_dedup.exact_groups(odd.repartition(3))) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(none):
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_exact_copies(none).columns == none.columns


def test_drop_keeps_one_of_each(odd):
    left = exact_dedup.drop_exact_copies(odd)
    assert left.columns == odd.columns
    bare = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in left.collect()]
    assert sorted(bare) == sorted({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in odd.collect()})


def test_repeated_id_with_two_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (2, "c"), (3, "c"), (3, "c")], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.drop_exact_copies(df).collect())) == [(1, "a b"), (2, "c")]


def test_sql_keeps_one_row_of_a_repeated_id(spark, tmp_path):
    rows = [(5, "a  b"), (5, "a b"), (7, "a b"), (7, "a b"), (6, ""), (6, None), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.oracle_sql()["op6_exact_dedup"]).df()
    got = queries.op6_exact_dedup(spark, str(tmp_path)).toPandas()
    order = lambda d: d[sorted(d)].sort_values(sorted(d)).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    assert want.kept.sum() == 3


def test_query_equals_sql(spark, sf):
    got = queries.op6_exact_dedup(spark, sf).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op6_exact_dedup"]).df()
    order = lambda d: d[sorted(d)].sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
