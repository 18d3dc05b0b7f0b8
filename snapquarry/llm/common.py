"""Helpers shared by the text operators: table loading, shared storage, Arrow batches, samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapquarry.sources.storage import shared_dir

ARROW_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WRITTEN: list[str] = []  # the tables that materialise wrote and nobody dropped yet


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete tables that ``materialise`` wrote, once nothing reads them any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        WRITTEN.remove(path)


HOT = 1000  # a key is hot if it holds over one in so many rows


def with_value(rows: DataFrame, found: DataFrame, key: str, members: str, total: int | None = None) -> DataFrame:
    """``rows`` joined with ``found``, which has one row a key and the key's number of rows in ``members``.

    Keys that hold over 1 / ``HOT`` of all rows, of which there are fewer than ``HOT``, are
    broadcast and their rows stay where they are; the other rows are shuffled. So no task
    gets more than a ``HOT``-th of the rows for one key, however large a group is.
    """
    hot = found.filter(F.col(members) > F.lit((rows.count() if total is None else total) / HOT)).drop(members)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(found.drop(members), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def packed(df: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (by default all) as one struct ``row``, beside the ``text``: a name in the row can't clash with what an operator adds. ``select("row.*")`` gives them back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias("row"), F.col(f"`{text_col}`").alias("text"))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3, is 1. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(df: DataFrame, key: str, strata: Sequence[str], per_stratum: int) -> DataFrame:
    """About ``per_stratum`` rows of each combination of ``strata``, chosen by a hash of ``key``.

    One small count, then a filter: nothing is shuffled but the counts, the same
    rows come back at every run, and the expected size is bounded by the parameter.
    """
    n = df.groupBy(*[F.col(c).alias(f"__{c}") for c in strata]).agg(F.count("*").alias("__n"))
    cond = F.lit(True)
    for c in strata:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = df.join(n, cond).select(*df.columns, "__n")
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return joined.filter(place < F.lit(float(per_stratum)) / F.col("__n")).drop("__n")


SAMPLE_BYTES, LONGEST = 96 << 20, 1 << 20  # bounds of a training sample's texts: all together (expected), and each


def labelled_texts(documents: DataFrame, chosen: DataFrame, cols: Sequence[str]) -> pa.Table:
    """doc_id, text and ``cols`` of the chosen ids (few rows: the bounded sample of ids), ascending, on the driver.

    One row an id, however often the id is repeated. Texts over ``LONGEST`` bytes aren't
    learned from; if the others have over ``SAMPLE_BYTES`` together, ids are thinned by a
    hash to that size.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").filter(F.octet_length("text") <= LONGEST)
    rows = materialise(rows.groupBy("doc_id").agg(F.max(F.struct("text", *cols)).alias("r")))
    total = rows.agg(F.sum(F.octet_length("r.text"))).first()[0] or 0
    some = rows.filter(F.pmod(F.xxhash64(F.lit("bytes"), "doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE_BYTES / max(1, total)))))
    out = some.select("doc_id", "r.*").toArrow()
    return out.take(np.argsort(np.asarray(out["doc_id"]), kind="stable")) if out.num_rows else out


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, off, data = texts.buffers()
    at = np.frombuffer(off, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if off is not None and off.size else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, or of one row."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    i, base = 0, 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield i, j
        base, i = int(sizes[j - 1]), j


def small_batches(spark: SparkSession) -> None:
    """Have Spark cut Arrow batches at a few MB, so that very long texts take no more memory than short ones (a row is never cut)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def map_text(df: DataFrame, make: Callable[[], Callable], keep: Sequence[str], fields: str, text_col: str = "text", most: int = 1 << 20) -> DataFrame:
    """Apply a function of Arrow string arrays to ``text_col``, a MB of whole texts at a time.

    ``make()`` is called once a task and returns ``f(texts) -> list of columns`` for
    ``fields`` ("name type, ..."). Null texts arrive as empty ones. The result has the
    columns ``keep`` of ``df`` and the new ones; all other columns are left behind, so
    names can't clash. No shuffle.
    """
    small_batches(df.sparkSession)
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias("__text"))
    new = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in (x.strip().split(" ", 1) for x in fields.split(","))])
    schema = T.StructType([*src.schema.fields[:-1], *new.fields])
    kinds = [ARROW_TYPES[f.dataType.simpleString()] for f in new.fields]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            texts = b.column(b.num_columns - 1)
            for i, j in slices(b, texts, most):
                got = f(pc.fill_null(texts.slice(i, j - i), ""))
                cols = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, k) for x, k in zip(got, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(k).slice(i, j - i) for k in range(b.num_columns - 1)] + cols, names=names)

    return src.mapInArrow(run, schema)
