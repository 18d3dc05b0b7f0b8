"""Manifest aggregation: record checks, snapshot totals, identities, issues. All results are DataFrames; bad rows are rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapquarry.functions import checks as C

IDENTITY = ["database", "asset", "dataset", "version_token"]


def failed_rules(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of the rules that do not hold."""
    return F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules]), lambda x: x.isNotNull())


def record_rules() -> list[tuple[str, Column]]:
    return [("path", C.record_path_ok(F.col("path"))), ("sha256", C.sha256_ok(F.col("sha256"))), ("bytes", C.bytes_ok(F.col("bytes")))]


def identity_rules() -> list[tuple[str, Column]]:
    return [("database", ~C.blank(F.col("database"))), ("asset", ~C.blank(F.col("asset"))), ("version_token", ~C.blank(F.col("version_token"))), ("dataset", C.dataset_ok(F.col("dataset"))), ("directory", F.coalesce(C.last_segment(F.col("snapshot")) == F.col("version_token"), F.lit(False)))]


def record_issues(files: DataFrame, key: Sequence[str] = ("snapshot", "path")) -> DataFrame:
    """(key, rule) of every record rule broken: path, sha256, bytes."""
    return files.select(*key, F.explode(failed_rules(record_rules())).alias("rule"))


def identity_issues(locks: DataFrame) -> DataFrame:
    """(snapshot, rule): blank identity fields, a malformed dataset, a token that isn't the directory's name."""
    return locks.select("snapshot", F.explode(failed_rules(identity_rules())).alias("rule"))


def snapshot_totals(files: DataFrame) -> DataFrame:
    """A row for each snapshot; total_bytes is null if the sum overflows, to be reported."""
    return files.groupBy("snapshot", *IDENTITY).agg(F.count("*").alias("file_count"), F.try_sum("bytes").alias("total_bytes"))


def duplicate_paths(files: DataFrame) -> DataFrame:
    return files.groupBy("snapshot", "path").agg(F.count("*").alias("copies")).filter("copies > 1")


def duplicate_identities(totals: DataFrame) -> DataFrame:
    """Snapshots whose identity an earlier one (by snapshot) already has, and that one's name."""
    w = Window.partitionBy(*IDENTITY).orderBy("snapshot")
    ranked = totals.withColumn("place", F.row_number().over(w)).withColumn("first_snapshot", F.first("snapshot").over(w))
    return ranked.filter("place > 1").select("snapshot", "first_snapshot")


def summary(totals: DataFrame) -> DataFrame:
    return totals.agg(F.countDistinct("database").alias("database_count"), F.count("*").alias("snapshot_count"), F.sum("file_count").alias("file_count"), F.try_sum("total_bytes").alias("total_bytes"))


def sound_snapshots(files: DataFrame) -> DataFrame:
    """Totals of the snapshots that break no rule of their own: one pass over the records for totals and rules, and one over snapshot and path for repeated paths. Identities aren't compared."""
    broken = F.max(F.size(failed_rules(record_rules())) > 0).alias("broken")
    totals = files.groupBy("snapshot", *IDENTITY).agg(F.count("*").alias("file_count"), F.try_sum("bytes").alias("total_bytes"), broken)
    bad = F.col("broken") | (F.size(failed_rules(identity_rules())) > 0) | F.col("total_bytes").isNull()
    marked = totals.withColumn("bad", bad).withColumn("bad", F.max("bad").over(Window.partitionBy("snapshot")))
    return marked.filter(~F.col("bad")).drop("broken", "bad").join(duplicate_paths(files).select("snapshot").distinct(), "snapshot", "left_anti")


def first_identities(sound: DataFrame) -> DataFrame:
    """Of the sound snapshots with one identity the first by name. A snapshot that breaks a rule of its own takes no identity."""
    return sound.withColumn("place", F.row_number().over(Window.partitionBy(*IDENTITY).orderBy("snapshot"))).filter("place = 1").drop("place")


def build_manifest(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(snapshots, summary, issues). Snapshots with an issue stay out of the first two. Each of the three is a plan of its own; the issues read the records once for their rules, once for identities and totals, and for repeated paths and identities."""
    sound = sound_snapshots(files)
    rows = files.select("snapshot", *IDENTITY, "path", "bytes", failed_rules(record_rules()).alias("broken"))
    totals = rows.groupBy("snapshot", *IDENTITY).agg(F.count("*").alias("file_count"), F.try_sum("bytes").alias("total_bytes"), F.count("bytes").alias("sized"))
    lost = F.when(F.col("total_bytes").isNull() & (F.col("sized") > 0), F.lit("overflow"))
    whole = F.filter(F.concat(failed_rules(identity_rules()), F.array(lost)), lambda r: r.isNotNull())
    parts = [
        rows.filter(F.size("broken") > 0).select("snapshot", F.explode("broken").alias("rule"), F.col("path").alias("detail")),
        totals.select("snapshot", F.explode(whole).alias("rule"), F.lit("").alias("detail")),
        duplicate_paths(files).select("snapshot", F.lit("duplicate path").alias("rule"), F.col("path").alias("detail")),
        duplicate_identities(sound).select("snapshot", F.lit("duplicate identity").alias("rule"), F.col("first_snapshot").alias("detail")),
    ]
    good = first_identities(sound)
    return good, summary(good), reduce(DataFrame.unionByName, parts)


def validation_report(good: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: totals of the compatible snapshots and the number of incompatible ones."""
    bad = issues.agg(F.countDistinct("snapshot").alias("incompatible_count"))
    return summary(good).join(bad, how="cross")


def kind_and_count(species: Column, pathways: Column, brites: Column) -> Column:
    """Kind and number of the first non-empty entity list."""
    out = F.struct(F.lit("").alias("kind"), F.lit(0).alias("count"))
    for name, c in (("brites", brites), ("pathways", pathways), ("species", species)):
        out = F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.struct(F.lit(name).alias("kind"), F.size(c).alias("count"))).otherwise(out)
    return out


def entity_files(records: DataFrame, entity: str) -> DataFrame:
    """Sorted paths of each entity, by asset, then path."""
    files = F.array_sort(F.collect_list(F.struct("asset", "path")))
    return records.groupBy(entity).agg(F.transform(files, lambda x: x["path"]).alias("paths"))


#: Hierarchy scopes that stand for the reference, and the name of a query's own metadata.
REFERENCE_SCOPES, QUERY_META = ("br", "ko"), "query_meta.json"


def scope(records: DataFrame, key: Sequence[str], family: str = "organism", default: tuple[str, str] = ("organisms", "")) -> DataFrame:
    """Scope type and value of each snapshot from its records, by the rules of its family; ``default`` where no record has a scope.

    pathway: reference alone is (reference, pathway); one organism, or several without the reference, joined.
    hierarchy: one or several, of the reference, of organisms or mixed (scopes); all are joined.
    organism: second path segments but the query's metadata.
    annotation: datasets|formats of the assets' names.
    """
    kind, value = F.lit(default[0]), F.lit(default[1])
    if family == "annotation":
        name = C.annotation_name(F.col("asset"))
        sets = records.groupBy(*key).agg(F.array_sort(F.collect_set(name["dataset"])).alias("scopes"), F.array_sort(F.collect_set(name["format"])).alias("formats"))
        some = F.size("scopes") > 0
        joined = F.concat(F.array_join("scopes", ","), F.lit("|"), F.array_join("formats", ","))
        return sets.select(*key, F.when(some, "datasets_formats").otherwise("").alias("scope_type"), F.when(some, joined).otherwise("").alias("scope_value"))
    own = F.nullif(C.scope_of(F.col("path")), F.lit(""))
    sets = records.groupBy(*key).agg(F.array_sort(F.collect_set(own)).alias("scopes"))
    n = F.size("scopes")
    if family == "pathway":
        others = F.filter("scopes", lambda s: s != "reference")
        kind = F.when(n == 0, kind).when(F.size(others) == 0, "reference").when(n == 1, "organism").otherwise("organisms")
        value = F.when(n == 0, value).when(F.size(others) == 0, "pathway").otherwise(F.array_join(others, ","))
    elif family == "hierarchy":
        general = lambda s: s.isin(*REFERENCE_SCOPES)
        all_, none = F.forall("scopes", general), ~F.exists("scopes", general)
        one = F.when(all_, "reference").otherwise("organism")
        kind = F.when(n == 0, kind).when(n == 1, one).when(all_, "references").when(none, "organisms").otherwise("scopes")
        value = F.when(n == 0, value).otherwise(F.array_join("scopes", ","))
    elif family == "organism":
        others = F.filter("scopes", lambda s: s != QUERY_META)
        kind = F.when(F.size(others) == 0, kind).when(F.size(others) == 1, "organism").otherwise("organisms")
        value = F.when(F.size(others) == 0, value).otherwise(F.array_join(others, ","))
    else:
        raise ValueError(f"unknown family {family}")
    return sets.select(*key, kind.alias("scope_type"), value.alias("scope_value"))


def entity_manifest(records: DataFrame, key: Sequence[str], entity: str, family: str = "organism") -> DataFrame:
    """(key, entity, paths, scope_type, scope_value): each entity's sorted files beside its snapshot's scope."""
    files = F.array_sort(F.collect_list(F.struct("asset", "path")))
    listed = records.groupBy(*key, entity).agg(F.transform(files, lambda x: x["path"]).alias("paths"))
    return listed.join(scope(records, key, family), list(key), "left").orderBy(*key, entity)


def classified_files(files: DataFrame, family: str, base_url: str) -> tuple[DataFrame, DataFrame]:
    """(files with entity_id, asset and url; violations: path, rule) of pathway or hierarchy files, by their names. The list file has no entity."""
    name = C.last_segment(F.col("path"))
    found = C.entity_file(name, C.scope_of(F.col("path")), family, base_url)
    known = files.withColumn("found", found)
    bad = known.filter("found is null").select("path", F.lit("unexpected name").alias("rule"))
    return known.filter("found is not null").select(*files.columns, "found.*"), bad


def reused_and_acquired(reused: DataFrame, acquired: DataFrame) -> DataFrame:
    return reused.unionByName(acquired)


def distinct_values(rows: DataFrame, value: str) -> DataFrame:
    """Sorted distinct values that aren't blank."""
    return rows.select(value).filter(~C.blank(F.col(value))).distinct().orderBy(value)


def combined_version(records: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    return records.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(version)), "_").alias("version_token"))


def single_url(records: DataFrame, key: Sequence[str]) -> DataFrame:
    """The url of the only record that isn't metadata, else empty."""
    data = F.when(F.col("asset") != "query_meta", F.col("url"))
    return records.groupBy(*key).agg(F.when(F.count(data) == 1, F.max(data)).otherwise("").alias("data_url"))


def datasets_and_formats(names: DataFrame) -> DataFrame:
    return names.agg(F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets"), F.array_join(F.array_sort(F.collect_set("format")), ",").alias("formats"))


def ordered_snapshots(df: DataFrame) -> DataFrame:
    return df.orderBy(*IDENTITY, "snapshot")


def fixed_domain(values: Column, domain: Sequence[str]) -> Column:
    """The collected values that belong to a domain, once each, in the domain's order."""
    return F.filter(F.array(*[F.lit(x) for x in domain]), lambda x: F.array_contains(values, x))
