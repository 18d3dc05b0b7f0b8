"""Phrase collocations by SON partitioning.

A phrase with ``least`` or more occurrences in all has at least ceil(least / s) of them in one
of any s shards. So each shard (an eighth of the input's partitions) is mined completely at
that lowered support, what is frequent in some shard is a candidate, and a second pass counts
the candidates in all texts exactly.

Pass 1: a task splits its texts in numpy, counts the phrases of each chunk and writes their
hashes, dealt to ranges of the hash. A range's task adds the counts up by shard and marks what
reaches the local support in its part of a bitmap. Hashes that meet by chance only make more
candidates. Pass 2: each chunk's phrases that the bitmap has are written as text with their
counts and added up exactly; what is below ``least`` goes. The bitmap is all that the driver
collects and broadcasts: at most ``MOST_BITS`` bits (32 MB); where a corpus has more
candidates than that, more phrases pass and are counted, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapquarry.llm.common import buffers, materialise, small_batches, table

SHARDS = 8
CHUNK = 4 << 20  # bytes of text that are counted together
RANGE = 1 << 21  # about so many hashes meet in one range
MOST_BITS = 28
ENTRY = 40  # bits of a hash that are kept within its range
TOP, PARTS = 2000, 64  # a language's phrases are ranked in so many parts first

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: 2 ends a piece, 1 only a word.
CLASS = np.zeros(256, np.uint8)
CLASS[[9, 32]] = 1
CLASS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunk_grams(texts: pa.Array) -> tuple[int, pa.Array, list[tuple[list[np.ndarray], np.ndarray]]]:
    """(number of words, distinct words, [(columns of word numbers, counts)] of the distinct phrases of 1, 2 and 3 words)."""
    raw, off = buffers(texts)
    data = LOWER[raw]
    kind = CLASS[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = off[:-1][off[:-1] < off[1:]]  # of the texts that aren't empty
    begins[first] |= inside[first]
    at = np.flatnonzero(begins)
    if not len(at):
        return 0, pa.array([], pa.string()), []
    new_piece = kind == 2
    ends = np.zeros(len(at), np.int64)
    ends += np.searchsorted(np.flatnonzero(new_piece), at)
    doc = np.searchsorted(first, at, "right")
    sizes = np.bincount(np.cumsum(begins)[inside] - 1, minlength=len(at))
    flat = data[inside]
    spelled = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(flat)])
    coded = spelled.dictionary_encode()
    ids, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    v = len(names)
    n1 = np.bincount(ids, minlength=v)
    out = [([np.arange(v)], n1)]
    joined = (ends[1:] == ends[:-1]) & (doc[1:] == doc[:-1])
    i = np.flatnonzero(joined)
    if len(i):
        k, n = np.unique(ids[i] * v + ids[i + 1], return_counts=True)
        out.append(([k // v, k % v], n))
        i = np.flatnonzero(joined[1:] & joined[:-1])
        if len(i) and v < 1 << 21:
            t, n = np.unique((ids[i] * v + ids[i + 1]) * v + ids[i + 2], return_counts=True)
            out.append(([t // (v * v), t // v % v, t % v], n))
        elif len(i):
            t, n = np.unique(np.searchsorted(k, ids[i] * v + ids[i + 1]) * v + ids[i + 2], return_counts=True)
            out.append(([k[t // v] // v, k[t // v] % v, t % v], n))
    return len(at), names, out


def gram_hashes(lang: str, names: pa.Array, columns: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each phrase of a language."""
    h = np.full(len(columns[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + known[c])
    return h


def word_hashes(names: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in names.cast(pa.large_binary()).to_pylist()), np.uint64, len(names))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """(language, texts) of about ``CHUNK`` bytes, or of one longer text; at most four times as many bytes are held at once."""
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}

    def flushed(lang: str) -> tuple[str, pa.Array]:
        del size[lang]
        return lang, pa.concat_arrays(held.pop(lang))

    for b in batches:
        langs, texts = b.column(0).dictionary_encode(), b.column(1)
        codes = np.asarray(langs.indices)
        order = np.argsort(codes, kind="stable")
        cuts = np.r_[np.flatnonzero(np.diff(codes[order], prepend=-1)), len(codes)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            lang = langs.dictionary[int(codes[order[i]])].as_py()
            own = texts.take(pa.array(order[i:j]))
            held.setdefault(lang, []).append(own)
            size[lang] = size.get(lang, 0) + own.nbytes
            if size[lang] >= CHUNK:
                yield flushed(lang)
        while sum(size.values()) > 4 * CHUNK:
            yield flushed(max(size, key=size.get))
    for lang in list(held):
        yield flushed(lang)


MINED = "bucket int, shard int, entries binary, counts binary"


def mined(shards: int, support: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of each chunk by range of their hash: the bits below the range's, and the counts up to ``support``."""
    shard = TaskContext.get().partitionId() % shards
    for lang, texts in chunks(batches):
        _, names, grams = chunk_grams(texts)
        known = word_hashes(names)
        for columns, n in grams:
            h = gram_hashes(lang, names, columns, known) >> np.uint64(64 - ENTRY - bits)
            order = np.argsort(h)
            h, n = h[order], np.minimum(n[order], support).astype(np.uint8)
            bucket, at = np.unique(h >> np.uint64(ENTRY), return_index=True)
            low = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, : ENTRY // 8])
            cuts = [*at.tolist(), len(h)]
            rows = [(low[i:j].tobytes(), n[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(np.full(len(bucket), shard, np.int32)), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "shard", "entries", "counts"])


def frequent_somewhere(support: int, size: int, group: pa.Table) -> pa.Table:
    """The part of the bitmap that a range of hashes has: 2^size bits, set for what some shard has ``support`` times."""
    part = np.zeros(1 << size, bool)
    shard = np.asarray(group["shard"])
    for s in np.unique(shard):
        own = group.filter(pa.array(shard == s))
        low = np.frombuffer(b"".join(own["entries"].to_pylist()), np.uint8).reshape(-1, ENTRY // 8)
        entry = np.zeros((len(low), 8), np.uint8)
        entry[:, : ENTRY // 8] = low
        h = entry.view(np.uint64).ravel()
        n = np.frombuffer(b"".join(own["counts"].to_pylist()), np.uint8)
        order = np.argsort(h)
        h, n = h[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        found = h[at][np.add.reduceat(n, at) >= support]
        part[(found >> np.uint64(ENTRY - size)).astype(np.int64)] = True
    return pa.table({"bucket": group["bucket"].slice(0, 1), "part": pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())})


COUNTED = "lang string, words int, phrase string, a bigint"


def counted(bitmap, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, number of words, phrase, occurrences) of each chunk's candidates, and a row of 0 words with the number of all words."""
    bits = np.frombuffer(bitmap.value, np.uint8)
    for lang, texts in chunks(batches):
        total, names, grams = chunk_grams(texts)
        if not total:
            continue
        known = word_hashes(names)
        phrases, words, counts = [pa.array([""], pa.string())], [np.zeros(1, np.int32)], [np.array([total])]
        for columns, n in grams:
            place = (gram_hashes(lang, names, columns, known) >> np.uint64(64 - size)).astype(np.int64)
            keep = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            parts = [names.take(pa.array(c[keep])) for c in columns]
            phrases.append((pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if len(parts) > 1 else parts[0]).cast(pa.string()))
            words.append(np.full(len(keep), len(columns), np.int32))
            counts.append(n[keep])
        phrase, k, a = pa.concat_arrays(phrases), np.concatenate(words), np.concatenate(counts).astype(np.int64)
        for i in range(0, len(k), 1 << 16):
            j = min(len(k), i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (j - i)), pa.array(k[i:j]), phrase.slice(i, j - i), pa.array(a[i:j])], names=["lang", "words", "phrase", "a"])


def frequent_phrases(df: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, a): every phrase of 1 to 3 words with ``least`` or more occurrences in its language, and a row of 0 words with the language's number of words."""
    spark = df.sparkSession
    small_batches(spark)
    src = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    words = (src.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = min(24, max(0, (words * 2 // RANGE).bit_length()))
    size = max(bits + 3, min(MOST_BITS, max(10, words.bit_length())))
    support = -(-least // SHARDS)
    found = src.mapInArrow(partial(mined, SHARDS, support, bits), MINED)
    parts = found.groupBy("bucket").applyInArrow(lambda group: frequent_somewhere(support, size - bits, group), "bucket int, part binary")
    bitmap = np.zeros((1 << bits, 1 << (size - bits - 3)), np.uint8)
    for r in parts.toLocalIterator():
        bitmap[r.bucket] = np.frombuffer(r.part, np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())
    rows = src.mapInArrow(partial(counted, shared, size), COUNTED)
    out = materialise(rows.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a")).filter(f"words = 0 or a >= {int(least)}"))
    shared.destroy()
    return out


def collocations(df: DataFrame, least: int = 10, share: int = 50, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 and 3 words by score.

    a: occurrences, at least ``least``. l, r: those of the two parts of the cut with the least
    score floor(1000000 a a / (l r)), the first of equal ones; exact decimals. n: words of the
    language. A phrase goes if a longer candidate around it has ``share`` % of its occurrences.
    Null texts are empty and null languages ``und``; repeated rows count again; ties stand in
    the phrases' byte order; an empty table gives no row; other columns are not read.
    """
    found = frequent_phrases(df, least, text_col, lang_col)
    one = found.filter("words > 0").select("lang", "phrase", "a")
    word = F.split("phrase", " ")
    w = [F.get(word, F.lit(k)) for k in range(3)]
    cut = lambda k, a, b: F.struct(F.lit(k).alias("k"), a.alias("left"), b.alias("right"))
    two, three = found.filter("words = 2"), found.filter("words = 3")
    cuts = two.select("lang", "phrase", "a", cut(1, w[0], w[1]).alias("c")).unionByName(three.select("lang", "phrase", "a", F.explode(F.array(cut(1, w[0], F.concat_ws(" ", w[1], w[2])), cut(2, F.concat_ws(" ", w[0], w[1]), w[2]))).alias("c"))).select("lang", "phrase", "a", "c.*")
    both = cuts.join(one.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(one.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr("cast(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as bigint)")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.score", "s.l", "s.r")
    longer = three.select("lang", "a", F.explode(F.array(F.concat_ws(" ", w[0], w[1]), F.concat_ws(" ", w[1], w[2]))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
    some = kept.withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS))).withColumn("rank", part).filter(F.col("rank") <= top).drop("part")
    first = some.withColumn("rank", place).filter(F.col("rank") <= top)
    size = found.filter("words = 0").select("lang", F.col("a").alias("n"))
    return first.join(size, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
sized AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed WHERE len(w) > 0),
grams AS (SELECT lang, 1 AS k, w[i] AS phrase FROM placed UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w) UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
cuts AS (SELECT lang, phrase, a, 1 AS c, split_part(phrase, ' ', 1) AS x, substr(phrase, strpos(phrase, ' ') + 1) AS y FROM f WHERE k > 1
 UNION ALL SELECT lang, phrase, a, 2, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2), split_part(phrase, ' ', 3) FROM f WHERE k = 3),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, c, l.a AS l, r.a AS r, CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (SELECT lang, unnest([split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2), split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3)]) AS phrase, a FROM f WHERE k = 3),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = b.lang AND x.phrase = b.phrase AND 100 * x.a >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sized ON ranked.lang = sized.lang WHERE rank <= 2000
"""
