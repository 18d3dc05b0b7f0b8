"""Declared asset catalogue and selection from it."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.functions import checks as C
from snapquarry.operators.discover import selected, six_digits
from snapquarry.operators.ranks import ranked

ENTRIES_A_BATCH = 10

SCHEMA = "database string, asset string, name string, path string, url string, is_default boolean, is_large boolean, expected_bytes bigint"


def catalog(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The declared assets: templates with {version}, default and large marks, exact sizes where known."""
    return spark.createDataFrame(rows, SCHEMA)


def select_assets(declared: DataFrame, requested: DataFrame, version: str, allow_large: bool = False, above: int | None = None, family: str = "bulk") -> tuple[DataFrame, DataFrame]:
    """(selected assets with expanded paths and urls, issues: name, rule). Rules of ``selected``'s family, and large: an asset that is marked large, or over ``above`` bytes, without leave."""
    chosen, issues = selected(requested, declared, "name", "is_default" if "is_default" in declared.columns else None, family)
    large = F.coalesce(F.col("is_large"), F.lit(False)) | (F.coalesce(F.col("expected_bytes"), F.lit(0)) > above if above is not None else F.lit(False))
    v = F.lit(version)
    out = chosen.withColumn("path", F.concat(F.lit("raw/"), C.expanded(F.col("path"), v))).withColumn("url", C.expanded(F.col("url"), v))
    if allow_large:
        return out, issues
    return out.filter(~large), issues.unionByName(out.filter(large).select("name", F.lit("large").alias("rule")))


def declared_assets(spark: SparkSession, bases: dict[str, str]) -> DataFrame:
    """The assets of ``assets.tsv`` (fixed values) for the databases in ``bases``, which gives the address that a database's urls begin with. expansion: fixed, organism (a row for each organism), entries (batches of entries follow the list)."""
    with Path(__file__).with_name("assets.tsv").open(newline="") as f:
        rows = [(r["database"], r["asset"], r["name"], r["path"], bases[r["database"]].rstrip("/") + r["url"], r["default"] == "1", r["large"] == "1", int(r["bytes"]) if r["bytes"] else None, r["expansion"]) for r in csv.DictReader(f, delimiter="\t", quoting=csv.QUOTE_NONE) if r["database"] in bases]
    return spark.createDataFrame(rows, SCHEMA + ", expansion string")


def expand_assets(chosen: DataFrame, organisms: DataFrame, entries: DataFrame, bases: dict[str, str]) -> DataFrame:
    """Selected rows of ``declared_assets`` as what is fetched: database, asset, name, path, url.

    organisms: database, asset, organism; an asset for organisms gives a row for each distinct
    one of its database and asset, and none without. entries: database, asset, name, entry, pos;
    an asset of entries is followed by batches of ten in the order of ``pos``. Null and blank
    organisms and entries are left out; repeated entries repeat. Chosen rows are the small side
    (the catalogue's size); organisms and entries stay where they are, and batches are numbered
    in two passes, so one list may be of any length.
    """
    key, out = ["database", "asset"], ["database", "asset", "name", "path", "url"]
    fixed = chosen.filter("expansion != 'organism'").select(*out)
    who = organisms.filter(~C.blank(F.col("organism"))).select(*key, "organism").distinct()
    code = F.col("organism")
    per = who.join(F.broadcast(chosen.filter("expansion = 'organism'").select(*out)), key).select(*key, F.concat_ws(".", code, "name").alias("name"), *[F.replace(F.col(c), F.lit("{organism}"), code).alias(c) for c in ("path", "url")])
    listed = entries.filter(~C.blank(F.col("entry"))).select(*key, "name", "entry", "pos").join(F.broadcast(chosen.filter("expansion = 'entries'").select(*key, "name")), [*key, "name"])
    batch = ranked(listed, [*key, "name"], ["pos"]).groupBy(*key, "name", F.expr(f"place div {ENTRIES_A_BATCH} + 1").alias("k")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "entry"))), lambda x: x["entry"]), "+").alias("ids"))
    base = F.create_map(*[F.lit(x) for d, b in bases.items() for x in (d, b.rstrip("/"))])
    number = six_digits(F.col("k"))
    more = batch.select(*key, F.concat("name", F.lit("-entry-"), number).alias("name"), F.concat(F.lit("raw/"), "name", F.lit("/entries/"), number, F.lit(".keg")).alias("path"), F.concat(base[F.col("database")], F.lit("/get/"), "ids").alias("url"))
    return fixed.unionByName(per).unionByName(more)
