"""Reconciliation: what is declared, recorded and present, and what to do about it.

Records and expectations are keyed by path. All joins are equi-joins on the path, so
Spark broadcasts a small declaration and shuffles two large tables by the same key. The
policies differ by family and stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapquarry.functions import checks as C


def declared_vs_present(declared: DataFrame, present: DataFrame, ignore_extra: bool = False) -> DataFrame:
    """(path, status): ok, missing, undeclared, wrong size. declared: path, expected_bytes (nullable)."""
    status = F.when(F.col("p.path").isNull(), "missing").when(F.col("d.path").isNull(), "undeclared").when(F.col("d.expected_bytes") != F.col("p.bytes"), "wrong size").otherwise("ok")
    both = declared.alias("d").join(present.alias("p"), F.col("d.path") == F.col("p.path"), "full_outer")
    out = both.select(F.coalesce("d.path", "p.path").alias("path"), status.alias("status"))
    return out.filter("status <> 'undeclared'") if ignore_extra else out


def record_set_issues(records: DataFrame, declared: DataFrame) -> DataFrame:
    """(path, rule) of a complete set: duplicate, undeclared, missing, and mismatches of asset, url and size with the declaration.

    Url and asset are compared if the declaration has such columns; a missing value is an
    empty one. An expected size of 0 or null isn't known and matches any.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    compared = [c for c in ("asset", "url") if c in declared.columns and c in records.columns]
    d = declared.select("path", *compared, "expected_bytes").alias("d")
    each = records.select("path", *compared, "bytes").alias("r").join(d, F.col("r.path") == F.col("d.path"), "left")
    rules = [F.when(text(f"r.{c}") != text(f"d.{c}"), c) for c in compared]
    rules.append(F.when((F.col("d.expected_bytes") > 0) & ~F.col("r.bytes").eqNullSafe(F.col("d.expected_bytes")), "bytes"))
    known = F.col("d.path").isNotNull()
    own = each.select(F.col("r.path").alias("path"), F.when(~known, F.array(F.lit("undeclared"))).otherwise(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("rules"))
    by = own.groupBy("path").agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("rules"), F.count("*").alias("copies"))
    told = by.select("path", F.explode(F.concat("rules", F.when(F.col("copies") > 1, F.array(F.lit("duplicate"))).otherwise(F.array().cast("array<string>")))).alias("rule"))
    missing = declared.select("path").join(records.select("path"), "path", "left_anti").select("path", F.lit("missing").alias("rule"))
    return told.unionByName(missing)


def _joined(expected: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    r = records.select("path", F.col("bytes").alias("r_bytes"), F.col("sha256").alias("r_sha"))
    f = files.select("path", F.col("bytes").alias("f_bytes"), *([F.col("sha256").alias("f_sha")] if "sha256" in files.columns else []))
    return expected.select("path").join(r, "path", "left").join(f, "path", "left")


def _strict() -> Column:
    same = (F.col("r_bytes") == F.col("f_bytes")) & (F.col("r_sha") == F.col("f_sha"))
    return F.when(F.coalesce(same, F.lit(False)), "reuse").otherwise("acquire")


def _manifest_first() -> Column:
    return F.when(F.coalesce(F.col("r_bytes") == F.col("f_bytes"), F.lit(False)), "reuse_manifest").when(F.coalesce(F.col("f_bytes") > 0, F.lit(False)), "rebuild_hash").otherwise("acquire")


def _adopting() -> Column:
    known = F.col("r_bytes").isNotNull()
    return F.when(known & F.coalesce(F.col("r_bytes") == F.col("f_bytes"), F.lit(False)), "reuse_manifest").when(known, "acquire").when(F.coalesce(F.col("f_bytes") > 0, F.lit(False)), "rebuild_hash").otherwise("acquire")


def _intact() -> Column:
    return F.when(F.coalesce(F.col("f_bytes") > 0, F.lit(False)), "rebuild_hash").otherwise("acquire")


POLICIES = {"strict": _strict, "manifest_first": _manifest_first, "adopting": _adopting, "intact": _intact}


def plan_fetch(expected: DataFrame, records: DataFrame, files: DataFrame, policy: str) -> DataFrame:
    """(path, decision). For ``intact`` give files that passed the gzip check."""
    return _joined(expected, records, files).select("path", POLICIES[policy]().alias("decision"))


def plan_restore(records: DataFrame, files: DataFrame, by: str = "sha256") -> DataFrame:
    """(path, decision): what is recorded is there, by hash or by size, else acquire."""
    same = F.col("r_sha") == F.col("f_sha") if by == "sha256" else F.col("r_bytes") == F.col("f_bytes")
    return _joined(records, records, files).select("path", F.when(F.coalesce(same, F.lit(False)), "reuse").otherwise("acquire").alias("decision"))


def restore_issues(records: DataFrame) -> DataFrame:
    """(asset, path, rule) of what keeps records from being restored: blank asset, path, sha256, bytes, and a path or an asset that more than one record has."""
    own = [("asset", ~C.blank(F.col("asset"))), ("path", C.record_path_ok(F.col("path"))), ("sha256", C.sha256_ok(F.col("sha256"))), ("bytes", C.bytes_ok(F.col("bytes")))]
    broken = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in own]), lambda x: x.isNotNull())
    out = records.select("asset", "path", F.explode(broken).alias("rule"))
    for c, rule in (("path", "duplicate path"), ("asset", "duplicate asset")):
        again = records.groupBy(c).agg(F.count("*").alias("copies")).filter("copies > 1").select(c)
        out = out.unionByName(records.join(again, c, "left_semi").select("asset", "path", F.lit(rule).alias("rule")))
    return out


def plan_statistics(plan: DataFrame) -> DataFrame:
    return plan.groupBy("decision").agg(F.count("*").alias("files"))


def merge_records(old: DataFrame, new: DataFrame, files: DataFrame) -> DataFrame:
    """Newest record of each path that is still there. Only paths with two records meet a window."""
    both = old.withColumn("age", F.lit(1)).unionByName(new.withColumn("age", F.lit(0)))
    newest = both.withColumn("place", F.row_number().over(Window.partitionBy("path").orderBy("age"))).filter("place = 1").drop("place", "age")
    return newest.join(files.select("path"), "path", "left_semi")


def keep_known_url(records: DataFrame, known: DataFrame, derived: Column) -> DataFrame:
    k = known.select("path", F.col("url").alias("known_url"))
    return records.join(k, "path", "left").withColumn("url", F.coalesce(C.first_filled(F.col("known_url")), derived)).drop("known_url")


def lock_snapshot(declared: DataFrame, present: DataFrame, known: DataFrame, derived: Column, ignore_extra: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records of the files that are as declared, in path order; issues: path, status). A known record's url is kept, else ``derived``."""
    status = declared_vs_present(declared, present, ignore_extra)
    good = present.join(status.filter("status = 'ok'").select("path"), "path", "left_semi")
    return keep_known_url(good, known, derived).orderBy("path"), status.filter("status <> 'ok'").orderBy("path")


def to_hash(expected: DataFrame, records: DataFrame, states: DataFrame) -> DataFrame:
    """Paths whose size equals the recorded one: only these need hashing (first stage of a strict plan)."""
    return _joined(expected, records, states).filter("r_bytes = f_bytes").select("path")


def checksum_binding(archives: DataFrame, sidecars: DataFrame) -> DataFrame:
    """(name, status) of every archive against its checksum file <name>.md5: ok, mismatch, name (the line is another archive's), malformed, missing.

    archives: name, md5; sidecars: file, line (the whole file's text).
    """
    line = sidecars.select(F.regexp_extract("file", "^(.*)\\.md5$", 1).alias("name"), C.checksum_line(F.col("line")).alias("c"), F.lit(True).alias("there"))
    status = F.when(F.col("there").isNull(), "missing").when(F.col("c").isNull(), "malformed").when(F.col("c.name") != F.col("name"), "name").when(F.col("c.md5") != F.col("md5"), "mismatch").otherwise("ok")
    return archives.join(line, "name", "left").select("name", status.alias("status"))
