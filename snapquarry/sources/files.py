"""Sources and sinks on shared storage. Most readers only use Spark's file sources, so any store that Spark opens will do; many small files, and steps of large ones, are read by tasks from stores that pyarrow opens too."""

from __future__ import annotations

import hashlib
import io
import json
import tomllib
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapquarry.sources.storage import written

LARGEST, STEP = (1 << 31) - 1025, 1 << 20  # most bytes of a file that is read as one value; bytes of a step beyond
FILES = 5000  # small files that one task opens
LINE_LIMIT = 32 << 20  # fixed value: longest line of a strict table, in bytes
SKIPPED_DIRS = ("raw", "tidy", "logs")
LOCK_TEXTS = ("database", "asset", "dataset", "version", "version_token", "downloaded_at", "source_release", "source_release_start", "source_release_end", "source_last_update", "source_last_update_start", "source_last_update_end")
LOCK_FIELDS = ", ".join(f"{c} string" for c in LOCK_TEXTS) + ", files array<struct<path string, sha256 string, bytes bigint>>, species array<struct<id string>>, pathways array<struct<id string>>, brites array<struct<id string>>, error string"
EMPTY_SHA256, EMPTY_MD5 = hashlib.sha256(b"").hexdigest(), hashlib.md5(b"").hexdigest()


def _dir(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def scan_locks(spark: SparkSession, root: str) -> DataFrame:
    """Every manifest.lock below root: its fields, path, hash and size. A lock that can't be read, or has a value of a wrong type, is a row with ``error``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.lock").load(root)
    src = found.select("path", F.sha2("content", 256).alias("lock_sha256"), F.length("content").cast("bigint").alias("lock_bytes"), "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*LOCK_TEXTS, "files", "species", "pathways", "brites", "error"]
        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                try:
                    rows.append([*_lock_fields(tomllib.loads(bytes(content).decode())), None])
                except (ValueError, TypeError, RecursionError) as e:
                    rows.append([None] * (len(columns) - 1) + [str(e)])
            out = pd.DataFrame(rows, columns=columns, dtype=object)
            yield pd.concat([pdf[["path", "lock_sha256", "lock_bytes"]].reset_index(drop=True), out], axis=1)

    return src.mapInPandas(parse, "path string, lock_sha256 string, lock_bytes bigint, " + LOCK_FIELDS)


def _lock_fields(t: dict) -> list:
    """The fields of a lock; a value of another type than its field's is an error."""

    def typed(v: object, kind: type, name: str) -> object:
        if v is not None and (not isinstance(v, kind) or isinstance(v, bool) or kind is int and not -(1 << 63) <= v < 1 << 63):
            raise ValueError(f"{name} is not of its type")
        return v

    def tables(name: str) -> list[dict]:
        return [typed(x, dict, name) for x in typed(t.get(name, []), list, name)]

    files = [{"path": typed(f.get("path", ""), str, "path"), "sha256": typed(f.get("sha256", ""), str, "sha256"), "bytes": typed(f.get("bytes"), int, "bytes")} for f in tables("files")]
    return [*(typed(t.get(n), str, n) for n in LOCK_TEXTS), files, *([{"id": typed(x.get("id"), str, "id")} for x in tables(k)] for k in ("species", "pathways", "brites"))]


def prune_nested(locks: DataFrame) -> DataFrame:
    """A lock's directory is terminal: locks below another lock's directory, or below raw, tidy, logs or part folders, go."""
    d = locks.withColumn("dir", _dir(F.col("path")))
    skipped = F.exists(F.split("dir", "/"), lambda s: s.isin(*SKIPPED_DIRS) | s.endswith(".part") | s.endswith(".part.parts"))
    d = d.filter(~skipped)
    parts = F.split("dir", "/")
    above = d.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
    nested = above.join(d.select(F.col("dir").alias("above")).distinct(), "above", "left_semi").select("path").distinct()
    return d.join(nested, "path", "left_anti").drop("dir")


def lock_files(locks: DataFrame) -> DataFrame:
    """One row a recorded file, with its snapshot's identity."""
    return locks.select(_dir(F.col("path")).alias("snapshot"), "database", "asset", "dataset", "version_token", F.explode("files").alias("f")).select("snapshot", "database", "asset", "dataset", "version_token", "f.*")


def file_states(spark: SparkSession, root: str, deal: int = 64) -> DataFrame:
    """(path, bytes) of every file below root (a folder, a file or a pattern), hidden names and empty files too, contents unread.

    Folders are listed by tasks, level by level: the folders that one round finds are dealt to
    the tasks of the next, through written tables. The driver resolves the pattern and sees
    how many folders are left, no names.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    found = top.getFileSystem(conf).globStatus(top) or []
    kind = "path string, bytes bigint, folder boolean"
    now = spark.createDataFrame([(x.getPath().toString(), x.getLen(), x.isDirectory()) for x in found], kind)
    files = now.filter("not folder")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                store, name = _store(path)
                rows = [(f"{path.rstrip('/')}/{x.base_name}", x.size or 0, x.type == fs.FileType.Directory) for x in store.get_file_info(fs.FileSelector(name))]
                for k in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[k : k + 10_000], columns=["path", "bytes", "folder"])

    while left := (folders := now.filter("folder").select("path")).count():
        now = written(folders.repartition(max(1, min(left, deal)), "path").mapInPandas(listed, kind))
        files = files.unionByName(now.filter("not folder"))
    return files.select("path", "bytes")


def hashed_in_steps(files: DataFrame) -> DataFrame:
    """(path, sha256, md5) of files too large for one value, a file a row, read step by step by the tasks."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                store, name = _store(path)
                sha, md5 = hashlib.sha256(), hashlib.md5()
                with store.open_input_stream(name) as stream:
                    while part := stream.read(STEP):
                        sha.update(part)
                        md5.update(part)
                yield pd.DataFrame({"path": [path], "sha256": [sha.hexdigest()], "md5": [md5.hexdigest()]})

    return files.select("path").repartition("path").mapInPandas(f, "path string, sha256 string, md5 string")


def file_inventory(spark: SparkSession, root: str, largest: int = LARGEST) -> DataFrame:
    """(path, bytes, sha256, md5) below root, *.part left out.

    Empty files, which the binary source drops, get the empty hashes; files over
    ``largest`` bytes, whose contents that source then never reads, are hashed in steps.
    """
    states = file_states(spark, root).filter(~F.col("path").endswith(".part"))
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter(F.col("length") <= largest).select("path", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))
    read = whole.unionByName(hashed_in_steps(states.filter(F.col("bytes") > largest)))
    key = F.regexp_replace("path", "^file:/+", "/")
    joined = states.withColumn("k", key).join(read.withColumn("k", key).drop("path"), "k", "left")
    empty = F.col("bytes") == 0
    return joined.select("path", "bytes", F.when(empty, EMPTY_SHA256).otherwise(F.col("sha256")).alias("sha256"), F.when(empty, EMPTY_MD5).otherwise(F.col("md5")).alias("md5"))


def _lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(value, file, id of every line; file, head, head_id: each file's first line). Splits keep a file's lines in order."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    heads = lines.groupBy("file").agg(F.min_by(F.struct("value", "id"), F.struct("start", "id")).alias("h"))
    return lines.drop("start"), heads.select("file", F.col("h.value").alias("head"), F.col("h.id").alias("head_id"))


def read_strict_tsv(spark: SparkSession, path: str, header: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, violations): exact header in the first line, exact width, no quoting, trailing carriage return stripped, lines bounded. A file without a line has no header."""
    lines, heads = _lines(spark, path)
    head, plain = "\t".join(header), F.regexp_replace("value", "\r$", "")
    bad = heads.filter(F.regexp_replace("head", "\r$", "") != head).select("file", F.lit("header").alias("rule"), F.lit("").alias("detail"))
    empty = file_states(spark, path).filter("bytes = 0").select(F.col("path").alias("file"), F.lit("header").alias("rule"), F.lit("").alias("detail"))
    body = lines.join(heads.select("file", "head_id"), "file").filter("id <> head_id").select("file", plain.alias("value"))
    cells = F.split("value", "\t", -1)
    ok = (F.size(cells) == len(header)) & (F.octet_length("value") <= LINE_LIMIT)
    rows = body.filter(ok).select(*[F.get(cells, F.lit(k)).alias(c) for k, c in enumerate(header)])
    return rows, bad.unionByName(empty).unionByName(body.filter(~ok).select("file", F.lit("width").alias("rule"), F.substring("value", 1, 80).alias("detail")))


def read_edge_archive(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, violations): columns of a tab-separated archive, plain or gz, found by each file's first line. Files whose header lacks a column are violations; short rows are dropped."""
    lines, heads = _lines(spark, path)
    names = F.split("head", "\t")
    has = F.forall(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_contains(names, c))
    bad = heads.filter(~has).select("file", F.lit("header").alias("rule"))
    j = lines.join(heads.filter(has), "file").filter("id <> head_id")
    places = [F.array_position(names, c).cast("int") for c in columns]
    cells, wide = F.split("value", "\t", -1), F.greatest(*places, F.lit(0))
    return j.filter(F.size(cells) >= wide).select(*[F.get(cells, p - 1).alias(c) for p, c in zip(places, columns, strict=True)]), bad


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html) of index pages."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> int:
    """One file a row below root (contents are bytes), written by the tasks to the shared store; the number of files. A retried task writes the same file again."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(root)
        made = set()
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                folder = f"{top}/{name}".rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{top}/{name}", compression=None) as out:
                    out.write(bytes(data))
            yield pd.DataFrame({"n": [len(pdf)]})

    src = df.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content"))
    return src.mapInPandas(f, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path as Hadoop writes it, and the name there; nothing in the path is encoded."""
    scheme, rest = ("file", path) if path.startswith("/") else path.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, name = rest.removeprefix("//").partition("/")
    store, top = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, f"{top.rstrip('/')}/{name}"


def file_name() -> Column:
    """A row's file, its name decoded (Spark gives it encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """(listing, pos, value): lines of small listings in file order, blank ones dropped."""
    whole = spark.read.text(path, wholetext=True).select(file_name().alias("listing"), "value")
    return whole.select("listing", F.posexplode(F.split("value", "\r?\n")).alias("pos", "value")).filter(F.trim("value") != "")


def read_sidecars(spark: SparkSession, path: str, most: int = 8 << 20) -> DataFrame:
    """(file, value): the files below path by name, empty and hidden ones left out. Tasks list them, folder by folder, and read them, about ``most`` bytes at a time; the driver sees no name."""
    named = file_states(spark, path).withColumn("file", F.substring_index("path", "/", -1)).filter("bytes > 0 and not startswith(file, '_') and not startswith(file, '.')")

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            files, values, size = [], [], 0
            for at, file in zip(pdf["path"], pdf["file"], strict=True):
                store, name = _store(at)
                with store.open_input_stream(name, compression=None) as stream:
                    values.append(stream.read().decode("utf-8", "replace"))
                files.append(file)
                size += len(values[-1])
                if size > most:
                    yield pd.DataFrame({"file": files, "value": values})
                    files, values, size = [], [], 0
            yield pd.DataFrame({"file": files, "value": values})

    tasks = 1 + named.count() // FILES  # by number: the names' bytes say little of the work
    return named.select("path", "file").repartition(tasks, "path").mapInPandas(f, "file string, value string")


#: The layout of a full-evidence sidecar, its schema and transport, and the header of a capability table.
SIDECAR = "schema string, acquired_at_utc string, fingerprint string, query struct<schema string, dataset string, license string, organisms array<string>, fields array<string>, output_fields array<string>, levels array<string>>, transport string, start_inventory struct<sha256 string, edges bigint>, end_inventory struct<sha256 string, edges bigint>, leaf_batches array<struct<organism string, targets array<string>, expected_edges bigint, url string>>"
FULL_EVIDENCE, TRANSPORT, CAPABILITIES = "full-evidence-v1", "target-batches-v1", "argument\tvalues"


def _layout_error(value: object, kind: T.DataType, name: str) -> str | None:
    """Why a decoded JSON value isn't of a layout: another type, or a field that the layout doesn't have. Null and missing fields are fine."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return f"{name} is no object"
        unknown = sorted(set(value) - set(kind.names))
        if unknown:
            return f"unknown field {name}.{unknown[0]}".replace("..", ".")
        return next((e for f in kind if (e := _layout_error(value.get(f.name), f.dataType, f"{name}.{f.name}"))), None)
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            return f"{name} is no list"
        return next((e for x in value if (e := _layout_error(x, kind.elementType, name))), None)
    if isinstance(kind, T.StringType):
        return None if isinstance(value, str) else f"{name} is no text"
    return None if isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63 else f"{name} is no number"


def classify_sidecars(sidecars: DataFrame) -> DataFrame:
    """(file, kind, error, meta) of query sidecars.

    full-evidence-v1: JSON of that schema whose fields are all known and of their types; meta
    has them, its leaves and inventories as the batch and inventory checks take them.
    legacy-basic: JSON of mode archive and another schema, or a capability table: its header,
    then at least one row of two cells, with an argument in each. unsupported: other JSON.
    malformed: anything else, text behind the JSON value included.
    """
    layout = T._parse_datatype_string(SIDECAR)

    def reject(_: str) -> None:
        raise ValueError("not JSON")

    def kind(value: str) -> tuple[str, str | None]:
        try:
            v = json.loads(value, parse_constant=reject)
        except (ValueError, RecursionError):
            if value.strip()[:1] in ("{", "["):
                return "malformed", "malformed JSON"
            lines = [x.removesuffix("\r") for x in value.removesuffix("\n").split("\n")]
            if lines[0] != CAPABILITIES:
                return "malformed", "header"
            rows = [x.split("\t") for x in lines[1:]]
            if not rows or any(len(r) != 2 for r in rows):
                return "malformed", "width" if rows else "no rows"
            return ("legacy-basic", None) if all(r[0].strip() for r in rows) else ("malformed", "empty argument")
        if not isinstance(v, dict) or not isinstance(v.get("schema", ""), str | None) or not isinstance(v.get("mode", ""), str | None):
            return "malformed", "no envelope"
        if v.get("schema") != FULL_EVIDENCE:
            return ("legacy-basic", None) if v.get("mode") == "archive" else ("unsupported", "schema")
        error = _layout_error(v, layout, "")
        return ("malformed", error) if error else (FULL_EVIDENCE, None)

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [kind(v or "") for v in pdf["value"]]
            yield pd.DataFrame({"file": pdf["file"], "value": pdf["value"], "kind": [k for k, _ in found], "error": [e for _, e in found]})

    told = sidecars.select("file", "value").mapInPandas(f, "file string, value string, kind string, error string")
    return told.select("file", "kind", "error", F.when(F.col("kind") == FULL_EVIDENCE, F.from_json("value", layout)).alias("meta"))


def write_by_organism(df: DataFrame, out: str) -> None:
    """A folder of tab-separated files for each organism; the column also stays in the files. Rows are rebalanced by organism, so adaptive execution gives a large one several writers."""
    df.withColumn("taxid", F.col("organism")).hint("rebalance", "taxid").write.partitionBy("taxid").option("header", "true").csv(out, sep="\t", quote="")


#: Columns of the aggregate manifest, with the snapshot's fields.
MANIFEST_COLUMNS = {"SchemaVersion": "schema_version", "ResourceRoot": "resource_root", "Database": "database", "Asset": "asset", "Dataset": "dataset", "Version": "version_token", "SourceVersion": "source_version", "Path": "snapshot", "DownloadedAt": "downloaded_at", "FileCount": "file_count", "TotalBytes": "total_bytes", "SourceRelease": "source_release", "SourceReleaseStart": "source_release_start", "SourceReleaseEnd": "source_release_end", "SourceLastUpdate": "source_last_update", "SourceLastUpdateStart": "source_last_update_start", "SourceLastUpdateEnd": "source_last_update_end", "RecordKind": "record_kind", "RecordCount": "record_count", "ManifestPath": "manifest_path", "ManifestSHA256": "manifest_sha256", "ManifestBytes": "manifest_bytes"}
NUMBERS = ("file_count", "total_bytes", "record_count", "manifest_bytes")
MANIFEST_FORMATS = ("toml", "tsv", "json", "parquet")


def manifest_rows(snapshots: DataFrame, resource_root: str, schema_version: str = "2") -> DataFrame:
    """The 22 columns of the aggregate manifest in order; what ``snapshots`` doesn't have is empty or 0."""
    have = {"schema_version": F.lit(schema_version), "resource_root": F.lit(resource_root)} | {c: F.col(c) for c in snapshots.columns}
    cols = [F.coalesce(have.get(f, F.lit(None)).cast("bigint"), F.lit(0)) if f in NUMBERS else F.coalesce(have.get(f, F.lit(None)).cast("string"), F.lit("")) for f in MANIFEST_COLUMNS.values()]
    return snapshots.select(*[c.alias(n) for c, n in zip(cols, MANIFEST_COLUMNS, strict=True)])


def toml_blocks(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(value and ``keep``): a [[snapshots]] block of each manifest row. Empty texts and a record count of 0 are left out; a text is quoted as JSON quotes it, which TOML reads alike."""
    kept = ("database", "asset", "version_token", "snapshot", "file_count", "total_bytes")
    renamed = {"version_token": "version", "snapshot": "path"}
    lines = [F.lit("[[snapshots]]")]
    for name, f in list(MANIFEST_COLUMNS.items())[2:]:
        if f == "manifest_path":
            lines.append(F.lit("[snapshots.manifest]"))
        text = F.regexp_extract(F.to_json(F.struct(F.col(name).alias("v"))), '^[{]"v":(.*)[}]$', 1)
        line = F.concat(F.lit(f"{renamed.get(f, f.removeprefix('manifest_'))} = "), text)
        filled = F.col(name) != (0 if f in NUMBERS else "")
        lines.append(line if f in kept or f.startswith("manifest_") else F.when(filled, line))
    return rows.select(F.concat_ws("\n", *lines).alias("value"), *keep)


ORDER = ("Database", "Asset", "Dataset", "Version", "Path")


def write_manifest(snapshots: DataFrame, out: str, formats: Sequence[str] = MANIFEST_FORMATS, resource_root: str = "", schema_version: str = "2") -> None:
    """One document a format, equal at every run: the 22 columns as tsv, json or parquet; toml has the version and root once and a block a snapshot.

    Rows are sorted by ranges, in parallel; the parts' names follow the order, so that a
    format's files, one after another, are the document. Every part of a tsv has the header.
    """
    unknown = [f for f in formats if f not in MANIFEST_FORMATS]
    if unknown:
        raise ValueError(f"unknown manifest formats: {', '.join(unknown)}")
    rows = manifest_rows(snapshots, resource_root, schema_version)
    ordered = rows.orderBy(*ORDER)
    for f in formats:
        if f == "tsv":
            ordered.write.csv(f"{out}/tsv", sep="\t", header=True, emptyValue="")
        elif f == "json":
            ordered.write.json(f"{out}/json")
        elif f == "parquet":
            ordered.write.parquet(f"{out}/parquet")
        else:
            head = f"schema_version = {json.dumps(schema_version)}\nresource_root = {json.dumps(resource_root)}"
            blocks = toml_blocks(rows, ORDER).withColumn("k", F.lit(1))
            top = snapshots.sparkSession.range(1).select(F.lit(head).alias("value"), *[F.lit("").alias(c) for c in ORDER], F.lit(0).alias("k"))
            blocks.unionByName(top).orderBy("k", *ORDER).select("value").write.text(f"{out}/toml")


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): the lines of an ordered sink's parts, one after another; pos ascends with the order."""
    lines = spark.read.text(path).select("value", file_name().alias("part"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    return lines.withColumn("pos", F.struct("part", "start", "id")).select("pos", "value")


def _verified(files: DataFrame, check: Callable[[BinaryIO], str | None], largest: int) -> DataFrame:
    """(path, ok, error) of binaryFile rows or of ``path, length``. Contents up to ``largest`` bytes come with the rows if they have them; other files are opened by the tasks and read in steps, from any place."""
    whole = "content" in files.columns
    size = F.col("length") if "length" in files.columns else F.length("content")
    rows = files.select("path", F.when(size <= largest, F.col("content")).alias("content") if whole else F.lit(None).cast("binary").alias("content"))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            errors = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                if content is not None:
                    errors.append(check(io.BytesIO(bytes(content))))
                    continue
                store, name = _store(path)
                try:
                    with store.open_input_file(name) as opened:
                        errors.append(check(opened))
                except OSError as e:
                    errors.append(str(e))
            yield pd.DataFrame({"path": pdf["path"], "ok": [e is None for e in errors], "error": errors})

    return rows.mapInPandas(f, "path string, ok boolean, error string")


def gzip_intact(files: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(path, ok, error) of binaryFile rows, or of path and length: every member decompressed to its end, in steps, nothing kept. Files over ``largest`` bytes are read step by step."""

    def check(opened: BinaryIO) -> str | None:
        d, any_ = None, False
        try:
            while part := opened.read(STEP):
                any_ = True
                while part:
                    d = d or zlib.decompressobj(31)
                    d.decompress(part, STEP)
                    part = d.unused_data if d.eof else d.unconsumed_tail
                    d = None if d.eof else d
        except zlib.error as e:
            return str(e)
        return "empty" if not any_ else "truncated" if d is not None else None

    return _verified(files, check, largest)


def zip_member_ok(files: DataFrame, member: str, largest: int = LARGEST) -> DataFrame:
    """(path, ok, error): the archive holds the member and it can be read, checksum and all. Of files over ``largest`` bytes only the directory at their end and the member are read."""

    def check(opened: BinaryIO) -> str | None:
        try:
            with zipfile.ZipFile(opened) as z, z.open(member) as f:
                while f.read(STEP):
                    pass
        except (KeyError, zipfile.BadZipFile, zlib.error, OSError, EOFError, RuntimeError, NotImplementedError) as e:
            return str(e)
        return None

    return _verified(files, check, largest)


def first_error(content: Column, verifiers: Sequence[Callable[[Column], Column]]) -> Column:
    """User verifiers (content -> error text or null), in order; the first error counts."""
    return F.coalesce(*[v(content) for v in verifiers])
