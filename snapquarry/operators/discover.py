"""Discovery: links, listings, versions, selections, grids and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapquarry.functions import checks as C
from snapquarry.operators.ranks import ranked

HREF = "href=[\"']([^\"']*)[\"']"


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href) in document order."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("pos", "href"))


def link_names(pages: DataFrame) -> DataFrame:
    """(page_id, pos, name): the decoded base name of each link, trailing slashes and blanks off."""
    target = F.rtrim(C.link_target("href"), F.lit("/"))
    return page_links(pages).select("page_id", "pos", F.trim(F.regexp_replace(target, "^.*/", "")).alias("name"))


def discover_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, name): names of a listing page's files, each once, at its first place; directories, .. and index.html dropped."""
    kept = link_names(pages).filter(F.col("name").contains(".") & ~F.col("name").isin("..", ".", "index.html"))
    return first_seen(kept, "name", "pos", ["page_id"]).select("page_id", "pos", "name")


def annotation_links(pages: DataFrame, formats: Sequence[str], base_url: str) -> DataFrame:
    """(page_id, name, dataset, format, path, url) of the annotation files that pages link to, each name once."""
    named = link_names(pages).select("page_id", "name", C.annotation_name(F.col("name")).alias("a")).filter(F.col("a.format").isin(*formats))
    return named.select("page_id", "name", "a.*").distinct().withColumns({"path": F.concat(F.lit("raw/"), "name"), "url": F.concat(F.lit(base_url.rstrip("/") + "/"), "name")})


def pathway_set_links(pages: DataFrame) -> DataFrame:
    """(page_id, species, name, released): of several files for a species the last one of the page."""
    named = link_names(pages).select("page_id", "pos", "name", C.pathway_set_name(F.col("name")).alias("p")).filter("p is not null").select("page_id", "pos", "name", "p.*")
    return named.groupBy("page_id", "species").agg(F.max_by(F.struct("name", "released"), "pos").alias("r")).select("page_id", "species", "r.*")


def in_order(rows: DataFrame, value: str, rule: str = "asc", pos: str = "pos") -> DataFrame:
    """Rows in the traversal order asc, desc or input (by ``pos``)."""
    orders = {"asc": F.col(value).asc(), "desc": F.col(value).desc(), "input": F.col(pos).asc()}
    return rows.orderBy(orders[rule])


def first_seen(rows: DataFrame, value: str, pos: str, by: Sequence[str] = ()) -> DataFrame:
    """Each value once, at its first place; the input's order stays in ``pos``."""
    return rows.groupBy(*by, value).agg(F.min(pos).alias(pos))


def last_match(rows: DataFrame, by: Sequence[str], value: str, pos: str) -> DataFrame:
    """The value of the last place: the latest archive is the last in document order."""
    return rows.groupBy(*by).agg(F.max_by(value, pos).alias(value))


def first_match(rows: DataFrame, by: Sequence[str], value: str, pos: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.min_by(value, pos).alias(value))


def last_per_key(rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return rows.withColumn("place", F.row_number().over(w)).filter("place = 1").drop("place")


def latest_version(text: Column, pattern: str) -> Column:
    """The greatest of all matches, as text."""
    return F.array_max(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def header_version(lines: DataFrame) -> DataFrame:
    """Version of each file's first data-version: line: its first ISO date, else its text. lines: file, pos, value."""
    first = lines.filter(F.col("value").startswith("data-version:")).groupBy("file").agg(F.min_by("value", "pos").alias("v"))
    text = F.trim(F.substring_index("v", "data-version:", -1))
    date = F.regexp_extract("v", "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    return first.select("file", F.coalesce(F.nullif(date, F.lit("")), text).alias("version"))


def selected(requested: DataFrame, available: DataFrame, name: str, default: str | None = None, family: str = "exact") -> tuple[DataFrame, DataFrame]:
    """(available rows that are requested, issues: ``name``, rule). Requests are comma lists of names.

    No request at all means the rows for which the column ``default`` is true, or every row.
    family bulk: all, in this spelling, is every row, also beside names. family exact: all, in
    any case, is every row; beside known names it is an issue (all beside names), and hides
    unknown ones. family plain: all is a name like others. Other issues: unknown; file syntax
    (a name that begins with @); empty (a request without any name). With an issue the rows
    that are asked for stand all the same; callers decide.
    """
    if family not in ("bulk", "exact", "plain"):
        raise ValueError(f"unknown family {family}")
    tokens, at = token_list(requested.select(F.lit(0).alias("k"), F.col(name).alias("v")), "k", "v")
    all_ = {"bulk": F.col("token") == "all", "exact": F.lower("token") == "all", "plain": F.lit(False)}[family]
    names = tokens.filter(~all_).select(F.col("token").alias(name)).distinct()
    known = available.select(name).distinct()
    n = requested.agg(F.count("*").alias("requests"))  # one row, as are the two below
    n = n.crossJoin(tokens.agg(F.count("*").alias("tokens"), F.coalesce(F.max(all_), F.lit(False)).alias("every"))).crossJoin(names.join(known, name, "left_semi").agg(F.count("*").alias("known")))
    marked = available.join(names.withColumn("asked", F.lit(True)), name, "left").crossJoin(F.broadcast(n))
    usual = F.coalesce(F.col(default), F.lit(False)) if default else F.lit(True)
    chosen = marked.filter(F.when(F.col("requests") == 0, usual).otherwise(F.col("every") | F.coalesce("asked", F.lit(False)))).select(*available.columns)
    lost = names.join(known, name, "left_anti").crossJoin(F.broadcast(n)).filter(~F.col("every") | F.lit(family == "bulk")).select(name, F.lit("unknown").alias("rule"))
    beside = n.filter(F.col("every") & (F.col("known") > 0) & F.lit(family == "exact")).select(F.lit("all").alias(name), F.lit("all beside names").alias("rule"))
    empty = n.filter("requests > 0 and tokens = 0").select(F.lit("").alias(name), F.lit("empty").alias("rule"))
    return chosen, lost.unionByName(at.select(F.col("token").alias(name), "rule")).unionByName(beside).unionByName(empty)


def prefix_partition(codes: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(code with its prefix, prefixes without a code): an equi-join on the first letter."""
    keyed = codes.withColumn("prefix", F.substring("code", 1, 1))
    return keyed.join(prefixes, "prefix", "left_semi"), prefixes.join(keyed.select("prefix").distinct(), "prefix", "left_anti")


def task_grid(left: DataFrame, right: DataFrame, template: str) -> DataFrame:
    """Every combination of two declared lists (bounded by their declarations), with its path."""
    path = F.lit(template)
    grid = left.join(right, how="cross")
    for c in grid.columns:
        path = F.replace(path, F.lit("{" + c + "}"), F.col(c).cast("string"))
    return grid.withColumn("path", F.concat(F.lit("raw/"), path))


def fixed_batches(ids: DataFrame, by: Sequence[str], value: str, size: int) -> DataFrame:
    """(by, batch, ids, n): groups of ``size`` in order, named with six digits. A key's ids are numbered by many tasks; what meets is a batch."""
    numbered = ranked(ids.select(*by, value), by, [value]).withColumn("k", F.expr(f"place div {size}"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(value)), lambda x: x.cast("string")), ",")
    return numbered.groupBy(*by, six_digits(F.col("k")).alias("batch")).agg(joined.alias("ids"), F.count("*").alias("n"))


def six_digits(k: Column) -> Column:
    """At least six digits; more where there are more batches."""
    text = k.cast("string")
    return F.when(k < 1_000_000, F.lpad(text, 6, "0")).otherwise(text)


def work_grid(codes: DataFrame, prefixes: DataFrame, assets: DataFrame, template: str, by: Sequence[str], size: int) -> tuple[DataFrame, DataFrame]:
    """(tasks: every code with a requested prefix and every asset, with path and batch; prefixes without a code). Batches of ``size`` codes go by ``by`` and prefix."""
    keyed, missing = prefix_partition(codes, prefixes)
    batched = ranked(keyed, [*by, "prefix"], ["code"]).withColumn("batch", six_digits(F.expr(f"place div {size}"))).drop("place")
    return task_grid(batched, assets, template), missing


def listing_id(line: Column, kind: str) -> Column:
    """The id of a listing's line, or null. kind: pathway, hierarchy, organism, species, entry."""
    cells = F.split(line, "\t")
    first, second = F.get(cells, F.lit(0)), F.get(cells, F.lit(1))
    if kind == "pathway":
        return C.pathway_id(first)
    if kind == "hierarchy":
        return C.hierarchy_id(first)
    if kind == "organism":
        return C.organism_code(second)
    if kind == "species":
        return F.when(C.taxid_ok(first), first)
    if kind == "entry":
        return F.nullif(F.regexp_extract(line, "^\\s*(\\S+)", 1), F.lit(""))
    raise ValueError(f"unknown kind {kind}")


def listing_ids(lines: DataFrame, kind: str) -> DataFrame:
    """(listing, pos, id) of a listing's lines (see ``listing_id``), first occurrences only; entries keep all."""
    rows = lines.filter(~C.blank(F.col("value"))).select("listing", "pos", listing_id(F.col("value"), kind).alias("id")).filter("id is not null")
    return rows if kind == "entry" else first_seen(rows, "id", "pos", ["listing"])


def listing_issues(lines: DataFrame, kind: str) -> DataFrame:
    return lines.filter(~C.blank(F.col("value")) & listing_id(F.col("value"), kind).isNull()).select("listing", "pos", "value")


def root_pick(ids: DataFrame, by: str) -> DataFrame:
    """<code>00001 of each code; where there is none, all ids that end in 00001."""
    roots = ids.filter(F.col("id").endswith("00001"))
    own = F.col("id") == F.concat(F.col(by), F.lit("00001"))
    w = Window.partitionBy(by)
    return roots.withColumn("own", F.max(own).over(w)).filter(own | ~F.col("own")).drop("own")


def token_list(rows: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(tokens; issues: key, token, rule) of comma lists: split, trimmed, blanks dropped. A token that begins with @ is an issue."""
    out = rows.select(key, F.explode(F.split(value, ",")).alias("token")).select(key, F.trim("token").alias("token")).filter("token <> ''")
    at = F.col("token").startswith("@")
    return out.filter(~at), out.filter(at).withColumn("rule", F.lit("file syntax"))
