"""Evidence edges: validation, batches, organisms, comparison, fingerprints."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import urlencode

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from snapquarry.functions import checks as C
from snapquarry.operators.ranks import BLOCK, batch_steps, ranked, walk
from snapquarry.sources.files import STEP, _store
from snapquarry.sources.storage import shared_dir, written

KEY = ["source", "target", "is_directed", "is_stimulation", "is_inhibition", "consensus_direction", "consensus_stimulation", "consensus_inhibition"]
RANGE, PLAIN = 500_000, 200  # keys that one task sorts; most ranges that Spark's shuffle writes without holding a task's rows in memory
MOST_EDGES, MOST_TARGETS, MOST_URL = 500, 100, 6144  # fixed values: bounds of a batch


def key_text(cols: Sequence[str]) -> Column:
    return F.concat_ws("\t", *cols)


def edges_per_target(edges: DataFrame) -> DataFrame:
    return edges.groupBy("organism", "target").agg(F.count("*").alias("edges"))


def inventory_digest(edges: DataFrame, cols: Sequence[str], by: str = "organism") -> DataFrame:
    """(by, digest, edges): the exact digest of each group's keys, sorted and joined by newlines.

    Keys are dealt to ranges of about ``RANGE`` rows, however many of them are equal, and
    sorted there; beyond ``PLAIN`` ranges the tasks that deal would hold all they read, so
    ranges first get up to eight times as long. Each task writes its own keys, joined, as one
    file to the shared folder and tells where each group's stand. One digest is one chain of
    blocks by its definition, so one task reads a group's pieces through SHA-256 in their
    order, a MB at a time; what it sorts are the pieces' places. No task's memory grows with
    the group; ``bucketed_digest`` spreads the hashing too.
    """
    kind, root = edges.schema[by].dataType, f"{shared_dir(edges.sparkSession)}/tables/{uuid.uuid4().hex}"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, (store, top) = TaskContext.get().partitionId(), _store(root)
        store.create_dir(top, recursive=True)
        name = f"{task}-{uuid.uuid4().hex}"  # a task that is run again writes another file
        out: list[list] = []  # group, start, bytes, keys
        with store.open_output_stream(f"{top}/{name}", compression=None) as file:
            for b in batches:
                groups = b.column(0)
                ends = pc.indices_nonzero(pc.fill_null(pc.not_equal(groups.slice(1), groups.slice(0, len(groups) - 1)), True)).to_pylist() if len(groups) > 1 else []
                cuts = [0, *(e + 1 for e in ends), len(groups)]
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    if i == j:
                        continue
                    group = groups[i].as_py()
                    if not out or group != out[-1][0]:
                        out.append([group, file.tell(), 0, 0])
                    keys = (("\n" if out[-1][3] else "") + "\n".join(b.column(1).slice(i, j - i).to_pylist())).encode()
                    file.write(keys)
                    out[-1][2] += len(keys)
                    out[-1][3] += j - i
        columns = [pa.array([r[0] for r in out], to_arrow_type(kind)), pa.array([task] * len(out), pa.int32()), pa.array([name] * len(out), pa.string()), *(pa.array([r[k] for r in out], pa.int64()) for k in (1, 2, 3))]
        yield pa.RecordBatch.from_arrays(columns, names=[by, "task", "name", "start", "bytes", "n"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, n = None, None, 0
        out: list[tuple] = []
        store, top = _store(root)
        for b in batches:
            for group, name, start, size, keys in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                if sha is None or group != now:
                    if sha is not None:
                        out.append((now, sha.hexdigest(), n))
                    now, sha, n = group, hashlib.sha256(), 0
                if n:
                    sha.update(b"\n")
                with store.open_input_file(f"{top}/{name}") as file:
                    file.seek(start)
                    while size:
                        part = file.read(min(size, STEP))
                        if not part:
                            raise OSError(f"{name} ends early")
                        sha.update(part)
                        size -= len(part)
                n += keys
        if sha is not None:
            out.append((now, sha.hexdigest(), n))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], to_arrow_type(kind)), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.int64())], names=[by, "digest", "edges"])

    keys = edges.select(by, key_text(cols).alias("k"))
    n = keys.count()
    ranges = max(min(1 + n // RANGE, PLAIN), 1 + n // (8 * RANGE))
    rows = keys.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(ranges, by, "k", "at").select(by, "k").sortWithinPartitions(by, "k")
    own = T.StructField(by, kind)
    pieces = written(rows.mapInArrow(packed, T.StructType([own, *T._parse_datatype_string("task int, name string, start bigint, bytes bigint, n bigint").fields])))
    return pieces.repartition(by).sortWithinPartitions(by, "task").mapInArrow(fold, T.StructType([own, T.StructField("digest", T.StringType()), T.StructField("edges", T.LongType())]))


def bucketed_digest(edges: DataFrame, cols: Sequence[str], by: str = "organism", digits: int = 2) -> DataFrame:
    """Digest for groups of any size: keys meet in buckets by hash, then the buckets' digests. Not equal to the exact one."""
    k = edges.select(by, key_text(cols).alias("k")).withColumn("bucket", F.substring(F.sha2("k", 256), 1, digits))
    small = k.groupBy(by, "bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("k")), "\n"), 256).alias("d"), F.count("*").alias("n"))
    return small.groupBy(by).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "d"))), lambda x: x["d"]), "\n"), 256).alias("digest"), F.sum("n").alias("edges"))


def query_fingerprint(fields: Sequence[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def edge_difference(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(cols, side, copies): edges, with their multiplicity, that only one side has. One shuffle: both sides are counted first."""
    both = a.select(*cols, F.lit(1).alias("n")).unionByName(b.select(*cols, F.lit(-1).alias("n")))
    left = both.groupBy(*cols).agg(F.sum("n").alias("n")).filter("n <> 0")
    return left.select(*cols, F.when(F.col("n") > 0, "missing").otherwise("extra").alias("side"), F.abs("n").alias("copies"))


def duplicate_edges(edges: DataFrame, cols: Sequence[str]) -> DataFrame:
    return edges.groupBy(*cols).agg(F.count("*").alias("copies")).filter("copies > 1")


def outside_batches(edges: DataFrame, batches: DataFrame) -> DataFrame:
    """Edges whose target is in no batch of their organism. batches: organism, targets."""
    inside = batches.select("organism", F.explode("targets").alias("target")).distinct()
    return edges.join(inside, ["organism", "target"], "left_anti")


def targets_in_two_batches(batches: DataFrame) -> DataFrame:
    return batches.select("organism", F.explode("targets").alias("target")).groupBy("organism", "target").agg(F.count("*").alias("batches")).filter("batches > 1")


def batch_reconciliation(edges: DataFrame, batches: DataFrame) -> DataFrame:
    """(organism, batch, expected_edges, actual_edges, ok)."""
    want = batches.select("organism", "batch", "expected_edges", F.explode("targets").alias("target"))
    got = want.join(edges_per_target(edges), ["organism", "target"], "left").groupBy("organism", "batch", "expected_edges").agg(F.sum(F.coalesce("edges", F.lit(0))).alias("actual_edges"))
    return got.withColumn("ok", F.col("expected_edges") == F.col("actual_edges"))


def missing_capabilities(requested: DataFrame, advertised: DataFrame) -> DataFrame:
    """Requested (argument, value) pairs that are not advertised. advertised: argument, values (; list)."""
    have = advertised.select("argument", F.explode(F.split("values", ";")).alias("value"))
    return requested.join(have.select("argument", F.trim("value").alias("value")).distinct(), ["argument", "value"], "left_anti")


def routed(edges: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each organism an edge belongs to: equal ids once; -1 goes with the other; both otherwise; blank or malformed ids drop the edge."""
    x, y = F.trim(a), F.trim(b)
    pair = F.when(x == y, F.array(x)).when(x == "-1", F.array(y)).when(y == "-1", F.array(x)).otherwise(F.array(x, y))
    ok = F.forall(pair, lambda t: t.rlike("^[0-9]+$"))
    return edges.filter(F.coalesce(ok, F.lit(False))).withColumn("organism", F.explode(F.array_sort(F.array_distinct(pair))))


def split_counts(edges: DataFrame, requested: DataFrame) -> DataFrame:
    """Edges of every requested organism, also those without any."""
    n = edges.join(requested, "organism", "left_semi").groupBy("organism").agg(F.count("*").alias("edges"))
    return requested.join(n, "organism", "left").select("organism", F.coalesce("edges", F.lit(0)).alias("edges"))


def canonical_url(base: str, constants: dict[str, str], organism: Column, targets: Column) -> Column:
    """A batch's request: parameters by name, values encoded, targets joined by commas. The constants' names come before the other two's."""
    return F.concat(F.lit(f"{base}?{urlencode(sorted(constants.items()), safe='~')}{'&' if constants else ''}organisms="), C.query_value(organism), F.lit("&targets="), C.query_value(F.array_join(targets, ",")))


def plan_edge_batches(edges: DataFrame, base_url: str = "https://example.org/interactions", constants: dict[str, str] | None = None, edges_bound: int = MOST_EDGES, targets_bound: int = MOST_TARGETS, url_bound: int = MOST_URL) -> DataFrame:
    """(organism, batch, targets, expected_edges, url, error): greedy batches of the sorted targets.

    The bound on a url counts its encoded bytes. A target that is null or blank, or that is
    over a bound by itself, is a row with an error and no batch number.

    Greedy is a walk: where a batch begins says where the next one does. Edges are counted by
    target and targets numbered first. As no batch has over ``targets_bound`` targets, a block
    of consecutive ones, with as many of the next block, says alone what becomes of a walk
    from each of its first places; these steps are put together block by block (see ``walk``).
    So no task reads an organism's list of targets.
    """
    head = f"{base_url}?{urlencode(sorted((constants or {}).items()), safe='~')}{'&' if constants else ''}organisms="
    first = F.lit(len(head) + len("&targets=")) + F.octet_length(C.query_value(F.col("organism")))
    counted = edges_per_target(edges).withColumns({"own": F.octet_length(C.query_value(F.col("target"))), "first": first})
    error = F.when(F.coalesce(F.trim("target") == "", F.lit(True)), "empty target").when((F.col("edges") > edges_bound) | (F.col("first") + F.col("own") > url_bound), "target over a bound")
    told = written(counted.withColumn("error", error))
    bad = told.filter("error is not null").select("organism", F.lit(None).cast("int").alias("batch"), F.array("target").alias("targets"), F.col("edges").alias("expected_edges"), F.lit(None).cast("string").alias("url"), "error")
    size = max(BLOCK, targets_bound)
    placed = ranked(told.filter("error is null").select("organism", "target", "edges", "own", "first"), ["organism"], ["target"])
    placed = written(placed.withColumn("block", F.expr(f"place div {size}")))
    fields = ["organism", "block", "place", "edges", "own", "first"]
    ahead = placed.filter((F.col("place") % size < targets_bound) & (F.col("block") > 0)).withColumn("block", F.col("block") - 1)

    def starts(pdf: pd.DataFrame) -> tuple[np.ndarray, int]:
        """Where the batch after each place begins (places within the block), and the block's own size."""
        pdf = pdf.sort_values("place")
        n, own = len(pdf), int((pdf["place"] // size == pdf["block"]).sum())
        total = np.r_[0, np.cumsum(pdf["edges"].to_numpy(np.int64))]
        length = np.r_[0, np.cumsum(pdf["own"].to_numpy(np.int64) + 3)]
        k = np.arange(n)
        most = np.minimum(np.searchsorted(total, total[:-1] + edges_bound, "right"), np.searchsorted(length, length[:-1] + url_bound - int(pdf["first"].iloc[0]) + 3, "right")) - 1
        return np.minimum(np.minimum(most, k + targets_bound), n), own

    def steps(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        after, own = starts(pdf)
        rows = [(key[0], key[1], *r) for r in batch_steps(after, own, targets_bound if key[1] else 0)]
        return pd.DataFrame(rows, columns=["organism", "block", "entry", "exit", "steps"])

    def numbered(key: tuple, pdf: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        after, own = starts(pdf)
        entry, batch = int(at["entry"].iloc[0]), int(at["done"].iloc[0])
        out = np.full(own, batch - 1, np.int64)  # what stands before the entry belongs to the last batch of the block before
        while entry < own:
            out[entry : after[entry]] = batch
            entry, batch = int(after[entry]), batch + 1
        return pd.DataFrame({"organism": key[0], "place": pdf["place"].to_numpy()[:own], "batch": out})

    seen = placed.select(*fields).unionByName(ahead.select(*fields))
    path = walk(seen.groupBy("organism", "block").applyInPandas(steps, "organism string, block bigint, entry int, exit int, steps bigint"), "organism")
    batches = seen.groupBy("organism", "block").cogroup(path.groupBy("organism", "block")).applyInPandas(numbered, "organism string, place bigint, batch int")
    grouped = placed.select("organism", "place", "target", "edges").join(batches, ["organism", "place"]).groupBy("organism", "batch").agg(F.array_sort(F.collect_list("target")).alias("targets"), F.sum("edges").alias("expected_edges"))
    url = canonical_url(base_url, constants or {}, F.col("organism"), F.col("targets"))
    return grouped.select("organism", "batch", "targets", "expected_edges", url.alias("url"), F.lit(None).cast("string").alias("error")).unionByName(bad)


def validate_edges(evidence: DataFrame, batches: DataFrame, levels: Sequence[str] = ()) -> DataFrame:
    """(source, target, rule): outside its batch, level, evidences and extra_attrs that aren't JSON."""
    inside = batches.select("organism", F.explode("targets").alias("target"), F.lit(True).alias("inside")).distinct()
    j = evidence.join(inside, ["organism", "target"], "left").withColumns({"e": C.json_ok("evidences"), "x": C.json_ok("extra_attrs")})
    rules = [F.when(F.col("inside").isNull(), "target"), F.when(~F.col("e"), "evidences"), F.when(~F.col("x"), "extra_attrs")]
    if levels:
        rules.append(F.when(~C.levels_ok(F.col("dorothea_level"), levels), "level"))
    return j.select("source", "target", F.explode(F.filter(F.array(*rules), lambda r: r.isNotNull())).alias("rule"))


def compare_inventories(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(organism, start, end, equal): digests of two inventories."""
    x = inventory_digest(a, cols).select("organism", F.col("digest").alias("start"))
    y = inventory_digest(b, cols).select("organism", F.col("digest").alias("end"))
    return x.join(y, "organism", "full_outer").withColumn("equal", F.coalesce(F.col("start") == F.col("end"), F.lit(False)))


def inventory_drift(a: DataFrame, b: DataFrame, cols: Sequence[str], by: str = "organism") -> DataFrame:
    """(by, cols, side, copies): the edges that make two inventories differ: missing from the second, or extra there. No digest is needed and no group meets in one task."""
    return edge_difference(a, b, [by, *cols])


def validate_batch_plan(batches: DataFrame, inventory: DataFrame, organisms: Sequence[str], base_url: str = "https://example.org/interactions", constants: dict[str, str] | None = None) -> DataFrame:
    """(organism, batch, rule) of every rule that a plan breaks; batches: organism, batch, targets, expected_edges, url, and the place ``leaf`` in the whole plan.

    organism: not among the query's. order: an organism's batches stand before an earlier
    organism's. targets, edges: none or too many. unsorted: targets out of order. empty: a
    blank target. repeated: a target that an earlier batch of the organism has. canonical:
    the url isn't that of the query. url: too many bytes. counts: not the inventory's
    number of edges. total: all batches together don't have as many edges as the inventory (one row
    without organism and batch).
    """
    n, asked = F.size("targets"), F.array(*[F.lit(x) for x in organisms])
    rules = F.array(
        F.when(~F.array_contains(asked, F.col("organism")), "organism"),
        F.when(~n.between(1, MOST_TARGETS), "targets"),
        F.when(~F.col("expected_edges").between(1, MOST_EDGES), "edges"),
        F.when(F.array_sort("targets") != F.col("targets"), "unsorted"),
        F.when(F.exists("targets", lambda t: C.blank(t)), "empty"),
        F.when(~F.col("url").eqNullSafe(canonical_url(base_url, constants or {}, F.col("organism"), F.col("targets"))), "canonical"),
        F.when(F.octet_length("url") > MOST_URL, "url"),
    )
    own = batches.select("organism", "batch", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("rule"))
    counted = batch_reconciliation(inventory, batches).filter("not ok").select("organism", "batch", F.lit("counts").alias("rule"))
    place = F.array_position(asked, F.col("organism"))
    spans = batches.filter(place > 0).groupBy("organism").agg(F.min("leaf").alias("first"), F.max("leaf").alias("last"), F.min(place).alias("place"))
    before = F.max("last").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))  # one row an organism of the query
    late = spans.withColumn("before", before).filter("first < before").select("organism", F.lit(None).cast("int").alias("batch"), F.lit("order").alias("rule"))
    seen = batches.select("organism", "batch", F.explode("targets").alias("target")).filter(~C.blank(F.col("target")))
    first = seen.groupBy("organism", "target").agg(F.min("batch").alias("first"), F.count("*").alias("n")).filter("n > 1")
    twice = seen.join(first, ["organism", "target"]).filter("batch > first").select("organism", "batch", F.lit("repeated").alias("rule")).distinct()
    inside = seen.groupBy("organism", "batch", "target").count().filter("count > 1").select("organism", "batch", F.lit("repeated").alias("rule")).distinct()
    want = inventory.agg(F.count("*").alias("edges"))
    total = batches.agg(F.coalesce(F.sum("expected_edges"), F.lit(0)).alias("planned")).join(want, how="cross").filter("planned <> edges")
    whole = total.select(F.lit(None).cast("string").alias("organism"), F.lit(None).cast("int").alias("batch"), F.lit("total").alias("rule"))
    return own.unionByName(counted).unionByName(late).unionByName(twice.unionByName(inside).distinct()).unionByName(whole)


def assembled(batches: Sequence[DataFrame], key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(all batches' edges as one table, edges that more than one row has)."""
    edges = reduce(DataFrame.unionByName, batches)
    return edges, duplicate_edges(edges, key)


def split_archive(edges: DataFrame, dataset: str | None, requested: DataFrame, a: str = "ncbi_tax_id_source", b: str | None = "ncbi_tax_id_target") -> tuple[DataFrame, DataFrame]:
    """(edges of the dataset, of its requested organisms; edges of every requested organism, also those without any).

    With ``dataset`` only rows count whose column of that name is exactly True. With ``b``
    None there is one taxid column, ``a``, and a row belongs to that organism alone.
    """
    own = edges.filter(F.col(dataset) == "True") if dataset else edges
    alone = own.withColumn("organism", F.trim(a)).filter(C.taxid_ok(F.col("organism"))) if b is None else routed(own, a, b)
    mine = alone.join(requested, "organism", "left_semi")
    return mine, split_counts(mine, requested)


#: What a full-evidence query may ask for, and the columns it must name.
DATASETS, LICENSES, LEVELLED = ("collectri", "dorothea", "kinaseextra"), ("academic", "commercial"), "dorothea"
QUERY_FIELDS = ["curation_effort", "dorothea_level", "dorothea_methods", "evidences", "extra_attrs", "ncbi_tax_id", "references", "sources", "type"]
OUTPUT_FIELDS = [
    "source", "target", "source_genesymbol", "target_genesymbol", "is_directed", "is_stimulation", "is_inhibition", "consensus_direction", "consensus_stimulation", "consensus_inhibition", "sources", "references",
    "dorothea_curated", "dorothea_chipseq", "dorothea_tfbs", "dorothea_coexp", "dorothea_level", "type", "curation_effort", "extra_attrs", "evidences", "ncbi_tax_id_source", "ncbi_tax_id_target",
]
QUERY_ORDER = ("schema", "dataset", "license", "organisms", "fields", "output_fields", "levels")


def query_json(query: Column) -> Column:
    """The query as compact JSON in its fixed order of fields, as it is fingerprinted: missing lists are null, and < > & are escaped."""
    text = F.to_json(F.struct(*[query[c].alias(c) for c in QUERY_ORDER]), {"ignoreNullFields": "false"})
    for c, code in (("<", "003c"), (">", "003e"), ("&", "0026")):
        text = F.replace(text, F.lit(c), F.lit(f"\\u{code}"))
    return text


def validate_query_meta(meta: DataFrame, dataset: Column, version_token: Column, supported: Sequence[str] = DATASETS) -> DataFrame:
    """(query_id, rule) of the rules that a decoded sidecar breaks (query_id, meta; ``dataset`` and ``version_token`` are what its snapshot says).

    schema, transport, dataset, license, fields: not the fixed ones. organisms: none, out of
    order, repeated, or not digits. levels: not canonical A to D for the levelled dataset, or
    any for another. fingerprint: not the query's SHA-256. time: not RFC 3339 in UTC. token:
    not the time and the first twelve digits. inventory: start and end differ, fewer than 0
    edges, or no digest. The leaves are checked by ``validate_batch_plan``.
    """
    m, q = F.col("meta"), F.col("meta.query")
    fixed = lambda c, want: c.eqNullSafe(F.array(*[F.lit(x) for x in want]))
    organisms = F.coalesce(q["organisms"], F.array().cast("array<string>"))
    sorted_ = organisms.eqNullSafe(F.array_sort(F.array_distinct(organisms)))
    levels = F.coalesce(q["levels"], F.array().cast("array<string>"))
    canonical = F.filter(F.array(*[F.lit(x) for x in "ABCD"]), lambda x: F.array_contains(levels, x)).eqNullSafe(levels) & (F.size(levels) > 0)
    own = F.sha2(query_json(q), 256)
    time = m["acquired_at_utc"]
    parts = "^([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{2}):([0-9]{2}):([0-9]{2})(?:[.,]([0-9]{1,9})[0-9]*)?Z$"
    real = time.rlike(parts) & F.try_to_timestamp(F.regexp_replace(F.substring(time, 1, 19), "T", " "), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    digits = [F.regexp_extract(time, parts, k) for k in range(1, 8)]
    stamp = F.concat(*digits[:3], F.lit("T"), *digits[3:6], F.lit("."), F.rpad(digits[6], 9, "0"), F.lit("Z"))
    start, end = m["start_inventory"], m["end_inventory"]
    same = start["sha256"].eqNullSafe(end["sha256"]) & F.coalesce(start["edges"], F.lit(0)).eqNullSafe(F.coalesce(end["edges"], F.lit(0)))
    rules = {
        "schema": (m["schema"] == "full-evidence-v1") & (q["schema"] == "full-evidence-v1"),
        "transport": m["transport"] == "target-batches-v1",
        "dataset": (q["dataset"] == dataset) & q["dataset"].isin(*supported),
        "license": q["license"].isin(*LICENSES),
        "fields": fixed(q["fields"], QUERY_FIELDS) & fixed(q["output_fields"], OUTPUT_FIELDS),
        "organisms": (F.size(organisms) > 0) & sorted_ & F.forall(organisms, lambda o: C.taxid_ok(o)),
        "levels": F.when(q["dataset"] == LEVELLED, canonical).otherwise(F.size(levels) == 0),
        "fingerprint": m["fingerprint"] == own,
        "time": real,
        "token": F.when(F.coalesce(real, F.lit(False)), version_token == F.concat_ws("-", stamp, F.substring(own, 1, 12))).otherwise(True),
        "inventory": same & (F.coalesce(start["edges"], F.lit(0)) >= 0) & C.sha256_ok(start["sha256"]),
    }
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return meta.select("query_id", F.explode(broken).alias("rule"))


def sidecar_leaves(meta: DataFrame) -> DataFrame:
    """The leaf batches of decoded sidecars as ``validate_batch_plan`` takes them: query_id, organism, batch and leaf (places in the plan), targets, expected_edges, url."""
    leaves = meta.select("query_id", F.posexplode("meta.leaf_batches").alias("leaf", "b"))
    return leaves.select("query_id", "b.organism", F.col("leaf").alias("batch"), "leaf", "b.targets", "b.expected_edges", "b.url")


def sidecar_inventories(meta: DataFrame) -> DataFrame:
    """(query_id, start, end, equal) of decoded sidecars' inventories, as ``compare_inventories`` gives them."""
    start, end = F.col("meta.start_inventory"), F.col("meta.end_inventory")
    return meta.select("query_id", start["sha256"].alias("start"), end["sha256"].alias("end"), (start["sha256"].eqNullSafe(end["sha256"]) & start["edges"].eqNullSafe(end["edges"])).alias("equal"))
