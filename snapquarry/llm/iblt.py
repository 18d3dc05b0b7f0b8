"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Only DataFrame functions run here. A text's paragraphs (lines, long ones cut every
``WORDS`` words) are digested to 40 bits, which are packed with a check of 23 bits into
one number. A sketch has three tables of cells; a digest goes to one cell of each, adding
1 to the cell's count and itself, by exclusive or, to the cell's sum.

Subtracting two sketches cancels what both texts have. Peeling then recovers the rest:
a cell whose count is 1 or -1 and whose sum passes its check holds one digest, which is
taken out of its other cells, which may free further ones. The digests recovered are the
differing paragraphs, and likeness is the shared part of all, (a + b - differing) / (a + b).

The fingerprint is the small sketch of fixed size (3 x ``SMALL`` cells). Where a pair of
fingerprints doesn't peel down to nothing, the pair is tried again larger: the digests are
dealt by their leading bits to as many sketches as keep each at a few digests, with 3 x 256
cells each. Those that still fail count the digests recovered and the cells left over.

Defined results: null and empty texts have an empty sketch; two empty sketches have
likeness 1, an empty and another 0; equal texts have equal fingerprints; a paragraph said
twice counts once. Documents go by ascending id, nulls first, then by text hash; repeated
rows are one document there and give as many equal result rows; an only document is its
own next. An empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapquarry.llm.common import materialise, table

WORDS, SMALL, LARGE, PER_SKETCH = 12, 8, 256, 8
PARAGRAPH = rf"\S++(?:[^\S\n]++\S++){{0,{WORDS - 1}}}+"
CHECK = (1 << 24) - 2  # the check's place in a packed digest; the last bit tells the side


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def check(p: Column) -> Column:
    """A packed digest whose lower 24 bits are the check of its upper 40."""
    top = F.shiftrightunsigned(p, 24)
    return F.shiftleft(top, 24).bitwiseOR(F.xxhash64(top).bitwiseAND(F.lit(CHECK)))


def digests(text: Column) -> Column:
    """Distinct packed digests of a text's paragraphs, ascending."""
    return F.sort_array(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: check(F.xxhash64(p)))))


def cell_of(p: Column, sub: int, size: int) -> Column:
    """Cell of a digest in table ``sub``: three parts of 8 bits of the packed digest."""
    return F.shiftrightunsigned(p, 24 + 8 * sub).bitwiseAND(F.lit(size - 1)).cast("int") + F.lit(sub * size)


def cell(at: Column, count: Column, total: Column) -> Column:
    return F.struct(at.alias("at"), count.cast("int").alias("n"), total.cast("bigint").alias("x"))


def total(packed: Column) -> Column:
    return F.aggregate(packed, F.lit(0).cast("bigint"), lambda s, p: s.bitwiseXOR(p))


def small_sketch(packed: Column) -> Column:
    """All 3 x SMALL cells, in order."""

    def one(sub: int) -> Column:
        def at(i: Column) -> Column:
            return let(F.filter(packed, lambda p: cell_of(p, sub, SMALL) == i), lambda own: cell(i, F.size(own), total(own)))

        return F.transform(F.sequence(F.lit(sub * SMALL), F.lit((sub + 1) * SMALL - 1)), at)

    return F.concat(*[one(sub) for sub in range(3)])


def subtracted(a: Column, b: Column) -> Column:
    """Cells of a less those of b (both whole, in order); empty cells go."""
    both = F.zip_with(a, b, lambda x, y: cell(x["at"], x["n"] - y["n"], x["x"].bitwiseXOR(y["x"])))
    return F.filter(both, filled)


def filled(c: Column) -> Column:
    return (c["n"] != 0) | (c["x"] != 0)


def large_sketch(signed: Column) -> Column:
    """Difference cells of packed digests whose last bit tells the side; only filled cells are kept."""

    def one(sub: int) -> Column:
        def added(c: Column, p: Column) -> Column:
            return cell(c["at"], c["n"] + 1 - 2 * p.bitwiseAND(F.lit(1)), c["x"].bitwiseXOR(p.bitwiseAND(F.lit(-2))))

        def at(i: Column) -> Column:
            return F.aggregate(F.filter(signed, lambda p: cell_of(p, sub, LARGE) == i), cell(i, F.lit(0), F.lit(0)), added)

        return F.transform(F.array_distinct(F.transform(signed, lambda p: cell_of(p, sub, LARGE))), at)

    return F.filter(F.concat(*[one(sub) for sub in range(3)]), filled)


def peeled(cells: Column, size: int, rounds: int) -> Column:
    """(cells left, digests recovered) after up to ``rounds`` turns through the three tables."""

    def turn(state: Column, t: Column) -> Column:
        sub = F.pmod(t, F.lit(3))
        low = sub * size

        def pure(c: Column) -> Column:
            return (c["at"] >= low) & (c["at"] < low + size) & (F.abs(c["n"]) == 1) & (check(c["x"]) == c["x"])

        def places(p: Column) -> Column:
            return F.struct(p["n"].alias("n"), p["x"].alias("x"), F.array(*[cell_of(p["x"], k, size) for k in range(3)]).alias("at"))

        def without(found: Column) -> Column:
            def taken(c: Column) -> Column:
                return F.aggregate(found, c, lambda acc, p: F.when(F.array_contains(p["at"], acc["at"]), cell(acc["at"], acc["n"] - p["n"], acc["x"].bitwiseXOR(p["x"]))).otherwise(acc))

            return F.struct(F.filter(F.transform(state["cells"], taken), filled).alias("cells"), F.concat(state["found"], F.transform(found, lambda p: p["x"])).alias("found"))

        one = F.filter(state["cells"], pure)
        return F.when(F.size(state["cells"]) == 0, state).otherwise(let(F.transform(one, places), lambda found: F.when(F.size(found) == 0, state).otherwise(without(found))))

    start = F.struct(cells.alias("cells"), F.array().cast("array<bigint>").alias("found"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(3 * rounds - 1)), start, turn)


def large_difference(a: Column, b: Column) -> Column:
    """Number of differing digests by sketches dealt by the digests' leading bits."""
    both = F.sort_array(F.concat(a, F.transform(b, lambda p: p.bitwiseOR(F.lit(1)))))

    def dealt(m: Column) -> Column:
        bits = F.least(F.lit(16), F.ceil(F.log2(F.greatest(F.lit(1.0), F.size(m) / F.lit(float(PER_SKETCH)))))).cast("int")

        def heads(shift: Column) -> Column:
            def sketch(i: Column) -> Column:
                return F.call_function("shiftrightunsigned", F.call_function("shiftrightunsigned", F.get(m, i), shift - 1), F.lit(1))

            starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (sketch(i) != sketch(i - 1)))
            return let(starts, lambda s: F.transform(s, lambda at, k: F.slice(m, at + 1, F.coalesce(F.get(s, k + 1), F.size(m)) - at)))

        parts = let(F.lit(64) - bits, heads)
        return F.aggregate(parts, F.lit(0), lambda n, part: n + let(peeled(large_sketch(part), LARGE, 4), lambda r: F.size(r["found"]) + F.ceil(F.size(r["cells"]) / 3).cast("int")))

    return let(both, lambda m: F.when(F.size(m) == 0, F.lit(0)).otherwise(dealt(m)))


def likeness(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """0 to 1: by the fingerprints' difference if it peels, else by the larger sketches."""
    small = let(peeled(subtracted(sketch_a, sketch_b), SMALL, 4), lambda r: F.when(F.size(r["cells"]) == 0, F.size(r["found"])))
    differing = let(small, lambda d: F.coalesce(d, large_difference(a, b)))
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise((n - F.least(n, differing)) / n.cast("double"))


def written(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda c: F.concat(F.hex(c["n"].cast("bigint")), F.lit(":"), F.hex(c["x"]))), ".")


def successors(rows: DataFrame) -> DataFrame:
    """(d0, h, copies, p_d0, p_h, p_n): each document's predecessor in the circle by ascending id.

    Only ids, hashes and lengths move. Spark deals them to ranges of about equal size,
    wherever the ids lie; each range is sorted by itself, and one row a range links the
    ends, so that the only window over all has as many rows as there are partitions.
    """
    one = rows.groupBy("doc_id", "d0", "h", "n").agg(F.count("*").alias("copies"))
    dealt = materialise(one.repartitionByRange(F.col("doc_id").isNotNull(), "d0", "h").withColumn("bucket", F.spark_partition_id()))
    me = F.struct("doc_id", "h", "d0", "n")
    ends = dealt.groupBy("bucket").agg(F.max(me).alias("last"))
    circle = Window.orderBy("bucket")
    ends = ends.select("bucket", F.coalesce(F.lag("last").over(circle), F.last("last").over(circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    within = dealt.withColumn("p", F.lag(me).over(Window.partitionBy("bucket").orderBy("doc_id", "h")))
    p = F.coalesce("p", "before")
    return within.join(F.broadcast(ends), "bucket").select("d0", "h", "copies", p["d0"].alias("p_d0"), p["h"].alias("p_h"), p["n"].alias("p_n"))


def neighbours(df: DataFrame) -> DataFrame:
    """Each distinct (doc_id, text) with its successor's paragraph digests and the head that replaces its own end.

    Texts are shuffled once, by key; heads (a quarter) and digests once, to their predecessor.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = df.select("doc_id", text.alias("text")).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("d0"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("h"), "text")
    order = materialise(successors(materialise(own.select("doc_id", "d0", "h", F.char_length("text").alias("n")))))
    if order.filter("copies > 1").limit(1).count():
        own = own.dropDuplicates(["d0", "h"])
    # The comparison is heavy on CPU, so rows are dealt evenly whatever the files' layout and the joins' kind.
    # Both uses of ``own`` need the same columns, so that Spark shuffles the texts once and reads that shuffle twice.
    own = own.repartition("d0", "h")
    heads = own.join(order, ["d0", "h"]).select(F.col("p_d0").alias("d0"), F.col("p_h").alias("h"), F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, p_n div 4)").alias("head"), digests(F.col("text")).alias("next"))
    return own.join(heads, ["d0", "h"]).join(order.select("d0", "h", "copies"), ["d0", "h"]).withColumn("n", F.char_length("text"))


def fingerprints(df: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id."""
    rows = neighbours(df).select("doc_id", "next_id", "copies", F.col("n").cast("bigint").alias("n_chars"), "text", "next", F.expr("concat(substring(text, 1, n - n div 4), head)").alias("edited"))

    def compared(v: Column) -> Column:
        """v: struct of the three digest lists."""

        def sketched(s: Column) -> Column:
            return F.struct(
                F.concat(F.size(v["a"]).cast("string"), F.lit("|"), written(s["a"])).alias("fingerprint"),
                F.concat(F.size(v["b"]).cast("string"), F.lit("|"), written(s["b"])).alias("edited_fingerprint"),
                likeness(v["a"], v["b"], s["a"], s["b"]).alias("near_edited"),
                likeness(v["a"], v["c"], s["a"], s["c"]).alias("near_next"),
            )

        return let(F.struct(*[small_sketch(v[k]).alias(k) for k in "abc"]), sketched)

    lists = F.struct(digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("b"), F.col("next").alias("c"))
    out = rows.select("doc_id", "next_id", "copies", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), let(lists, compared).alias("r"))
    out = out.select("doc_id", "n_chars", "edited_sha256", "r.*", "next_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.drop("copy")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
