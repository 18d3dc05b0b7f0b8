"""What a reviewer's findings showed: each test failed before its finding was settled."""

import hashlib
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from snapquarry import queries as Q
from snapquarry.functions import checks as C
from snapquarry.operators import edges as E
from snapquarry.sources import files as S


def test_lock_issues_of_several_version_tokens(spark, sf_dir, tmp_path):
    """Locks of several version tokens that stand at one path of different trees are all told."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 5000)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 50_000))
    more.coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for t in ("lineitem", "customer", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("e1_lock_issues", "e1_lock_summary"):
        df = Q.QUERIES[name](spark, str(tmp_path))
        want = c.execute(f"SELECT {', '.join(df.columns)} FROM ({Q.ORACLE_SQL[name]})").fetchall()
        assert sorted(tuple(r) for r in df.collect()) == sorted(want)
        assert name != "e1_lock_issues" or sum(r[0].startswith("token/") for r in want) > len({r[0] for r in want if r[0].startswith("token/")})


def test_many_sidecars_are_read_by_few_tasks(spark, tmp_path):
    """Small files are dealt by their names' size, not one to each few MB of opening cost; folders of any depth are read, large files apart."""
    n = 400
    S.write_files(spark.range(n).select(F.concat(F.expr("id div 100").cast("string"), F.lit("/a+b é"), F.col("id").cast("string"), F.lit(".json")).alias("path"), F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("content")), f"file://{tmp_path}")
    for name in ("_hidden", ".hidden", "empty"):
        (tmp_path / "0" / name).write_text("" if name == "empty" else "x")
    read = S.read_sidecars(spark, f"file://{tmp_path}", most=50)
    assert sorted((r.file, r.value) for r in read.collect()) == sorted((f"a+b é{k}.json", f'{{"n":{k}}}') for k in range(n))
    assert read.select(F.spark_partition_id().alias("p")).distinct().count() <= 8


def test_digest_of_a_group_over_many_tasks(spark, monkeypatch):
    """No task sorts a group whole, not even one of equal keys; keys with line breaks, empty ones and a null group count too."""
    kept, write = [], E.written
    monkeypatch.setattr(E, "RANGE", 100)
    monkeypatch.setattr(E, "written", lambda df: kept.append(write(df)) or kept[-1])
    rng = random.Random(3)
    rows = [("big", rng.choice(["a\nb", "é", "", "x" * 50]) + str(rng.randint(0, 400))) for _ in range(1500)] + [("same", "k")] * 900 + [(None, ""), (None, ""), ("one", "")]
    rng.shuffle(rows)
    got = E.inventory_digest(spark.createDataFrame(rows, "organism string, source string").repartition(5), ["source"]).collect()
    want = {g: sorted(k for h, k in rows if h == g) for g in ("big", "same", None, "one")}
    assert {r.organism: (r.digest, r.edges) for r in got} == {g: (hashlib.sha256("\n".join(k).encode()).hexdigest(), len(k)) for g, k in want.items()}
    assert max(r.n for r in kept[0].collect()) < 400


def test_compared_inventories_over_many_tasks(spark, sf_dir, monkeypatch):
    """No task sorts a group whole on either side of a comparison, and ranges get longer before they get too many to deal."""
    kept, write, name = [], E.written, "e9_compare_inventories"
    monkeypatch.setattr(E, "written", lambda df: kept.append(write(df)) or kept[-1])
    c = duckdb.connect()
    for t in ("documents", "lineitem", "customer", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = c.execute(f'SELECT organism, "start", "end", equal FROM ({Q.ORACLE_SQL[name]})').fetchall()
    for most, plain, ranges in ((400, 200, 16), (100, 20, 20), (20, 4, 38)):  # over 6,000 edges, less than one organism's
        monkeypatch.setattr(E, "RANGE", most, raising=False)
        monkeypatch.setattr(E, "PLAIN", plain, raising=False)
        kept.clear()
        assert sorted(tuple(r) for r in Q.QUERIES[name](spark, sf_dir).collect()) == sorted(want)
        assert len(kept) == 2
        for rows in (k.collect() for k in kept):
            assert len({r.task for r in rows}) <= ranges and max(r.n for r in rows) < 900


def test_repeated_json_is_read_once(spark, monkeypatch):
    """Each text of a batch is decoded once, and every row keeps its own answer, nulls and marks of byte order too."""
    texts = ['{"a":1}', '{"a":1} x', None, "﻿{}", "NaN", "1" * 5000, "[" * 100_000, '"é"', ""] * 20
    read, strict = [], C.strict_json
    monkeypatch.setattr(C, "strict_json", lambda v: read.append(v) or strict(v))
    assert C.json_ok.func(pd.Series(texts)).tolist() == [True, False, False, False, False, True, False, True, False] * 20 and len(read) == 9
    monkeypatch.undo()
    assert [r.ok for r in spark.createDataFrame([(x,) for x in texts], "v string").select(C.json_ok("v").alias("ok")).collect()] == [True, False, False, False, False, True, False, True, False] * 20
    assert spark.createDataFrame([], "v string").select(C.json_ok("v").alias("ok")).count() == 0
