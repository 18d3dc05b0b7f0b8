"""Aggregation straight from locks: one row a lock, its files checked where they stand, in a nested array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapquarry.functions import checks as C
from snapquarry.operators.manifest import IDENTITY, identity_rules, kind_and_count, summary

MOST_BYTES = (1 << 63) - 1


def _issue(broken: Column, rule: str, detail: Column) -> Column:
    return F.when(broken, F.struct(F.lit(rule).alias("rule"), F.coalesce(detail, F.lit("")).alias("detail")))


def file_issues(files: Column) -> Column:
    """(rule, detail: path) of every record rule that the files of a lock break, and of every further occurrence of a path."""
    own = lambda f: F.array(_issue(~C.record_path_ok(f["path"]), "path", f["path"]), _issue(~C.sha256_ok(f["sha256"]), "sha256", f["path"]), _issue(~C.bytes_ok(f["bytes"]), "bytes", f["path"]))
    paths = F.array_sort(F.transform(files, lambda f: f["path"]))
    again = F.filter(paths, lambda p, k: (k > 0) & (p == F.get(paths, k - 1)))
    return F.concat(F.flatten(F.transform(files, own)), F.transform(again, lambda p: _issue(F.lit(True), "duplicate path", p)))


def total_bytes(files: Column) -> Column:
    """The files' bytes in all, or null beyond 64 bits. Missing and negative sizes count as 0 here; they are issues of their own."""
    total = F.aggregate(files, F.lit(0).cast("decimal(38,0)"), lambda a, f: (a + F.greatest(F.coalesce(f["bytes"], F.lit(0)), F.lit(0)).cast("decimal(20,0)")).cast("decimal(38,0)"))
    return F.when(total <= F.lit(MOST_BYTES).cast("decimal(38,0)"), total.cast("bigint"))


def checked_locks(locks: DataFrame, root: str) -> DataFrame:
    """A row for each lock: ``snapshot`` (its folder below root), the fields of the aggregate manifest, and ``issues`` (rule, detail): parse, database, asset, version_token, dataset, directory, files, overflow and the files' own. No shuffle: a lock's files stay in its row."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    below = F.substring_index(folder, root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    rows = locks.withColumn("snapshot", folder)
    files = F.coalesce("files", F.array().cast("array<struct<path:string,sha256:string,bytes:bigint>>"))
    kind = kind_and_count(F.col("species"), F.col("pathways"), F.col("brites"))
    total = total_bytes(files)
    whole = [_issue(~ok, name, F.lit("")) for name, ok in identity_rules()]
    whole += [_issue(F.size(files) == 0, "files", F.lit("")), _issue(total.isNull(), "overflow", F.lit(""))]
    read = F.filter(F.concat(F.array(*whole), file_issues(files)), lambda x: x.isNotNull())
    issues = F.when(F.col("error").isNotNull(), F.array(_issue(F.lit(True), "parse", F.lit("")))).otherwise(read)
    texts = ["downloaded_at", "source_release", "source_release_start", "source_release_end", "source_last_update", "source_last_update_start", "source_last_update_end"]
    return rows.select(
        below.alias("snapshot"), *IDENTITY, C.source_version(F.col("version"), F.col("version_token")).alias("source_version"), *texts,
        F.size(files).cast("bigint").alias("file_count"), total.alias("total_bytes"), kind["kind"].alias("record_kind"), kind["count"].cast("bigint").alias("record_count"),
        F.lit("manifest.lock").alias("manifest_path"), F.col("lock_sha256").alias("manifest_sha256"), F.col("lock_bytes").alias("manifest_bytes"), issues.alias("issues"),
    )


def build_from_locks(locks: DataFrame, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(snapshots with all fields of the manifest, summary, issues: path, rule, detail) of scanned locks.

    A lock with an issue of its own is told and takes no identity; of sound locks with one
    identity the first by folder counts and the others are issues (detail: the first's folder).
    """
    checked = checked_locks(locks, root)
    place = Window.partitionBy(*IDENTITY).orderBy("snapshot")
    sound = checked.filter(F.size("issues") == 0).drop("issues").withColumn("place", F.row_number().over(place)).withColumn("first", F.first("snapshot").over(place))
    lock = F.concat("snapshot", F.lit("/manifest.lock")).alias("path")
    own = checked.select(lock, F.explode("issues").alias("i")).select("path", "i.rule", "i.detail")
    again = sound.filter("place > 1").select(lock, F.lit("duplicate identity").alias("rule"), F.col("first").alias("detail"))
    good = sound.filter("place = 1").drop("place", "first")
    return good, summary(good), own.unionByName(again)
