"""Document fingerprints by consistent weighted sampling of words.

For sample ``k`` every word of a text gets three numbers that depend on the word and ``k`` alone:
``r`` and ``c`` from Gamma(2, 1) and ``b`` uniform in 0 to 1. With the word's weight ``w`` (how
often the text holds it) ``t = floor(ln w / r + b)``, and the word with the smallest
``ln c - r * (t - b + 1)`` is the sample. Two texts draw the same (word, t) with a probability
that is the sum of the smaller weights over the sum of the larger ones, their generalised Jaccard
similarity. The smallest value itself tells (word, t) apart and serves as the sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statera.llm.common import bound, words

#: A likeness has a standard error of 0.089 at most, at one half.
SAMPLES = 32
#: Hexadecimal digits of a sample in a fingerprint.
DIGITS = 8


def _value(k: int) -> Column:
    """The value of the word with hash ``h`` and logarithm of weight ``lw`` in sample ``k``.

    Two 64-bit hashes give five uniform numbers; a Gamma(2, 1) number is the negative logarithm of
    the product of two.
    """
    a, b = f"xxhash64(h, {2 * k})", f"xxhash64(h, {2 * k + 1})"
    part = lambda x, at: f"((shiftrightunsigned({x}, {at}) & 2097151) + 0.5D)"
    r = f"(29.112181583517703D - ln({part(a, 0)} * {part(a, 21)}))"
    ln_c = f"ln(29.112181583517703D - ln({part(a, 42)} * {part(b, 0)}))"
    uniform = f"(shiftrightunsigned({b}, 21) / 8796093022208.0D)"
    return F.expr(f"{ln_c} - {r} * (floor(lw / {r} + {uniform}) - {uniform} + 1.0D)")


def weighted_terms(text: Column) -> Column:
    """The distinct words of a text as (h, n): hash and number of times."""

    def runs(h: Column) -> Column:
        last = F.size(h) - 1
        ends = F.filter(
            F.sequence(F.lit(0), last), lambda i: (i == last) | (F.get(h, i) != F.get(h, i + 1))
        )
        return bound(
            ends,
            lambda e: F.transform(
                e,
                lambda at, j: F.struct(
                    h[at].alias("h"),
                    (at - F.when(j > 0, F.get(e, j - 1)).otherwise(-1)).alias("n"),
                ),
            ),
        )

    hashes = F.sort_array(F.transform(words(text), lambda word: F.xxhash64(word)))
    return bound(
        hashes,
        lambda h: F.when(F.size(h) > 0, runs(h)),
    )


def sampled(rows: DataFrame, keys: list[str], terms: str) -> DataFrame:
    """(keys, fingerprint) of rows with an array of (h, n): the samples in hexadecimal digits.

    Rows without terms have the empty fingerprint. The minima need no shuffle where the rows are
    already dealt by one of ``keys``.
    """
    drawn = rows.select(*keys, F.explode_outer(terms).alias("term")).select(
        *keys, F.col("term.h").alias("h"), F.ln(F.col("term.n").cast("double")).alias("lw")
    )
    least = drawn.groupBy(*keys).agg(*[F.min(_value(k)).alias(f"__m{k}") for k in range(SAMPLES)])
    digits = [
        F.substring(F.lpad(F.hex(F.xxhash64(f"__m{k}")), 16, "0"), 1, DIGITS)
        for k in range(SAMPLES)
    ]
    fingerprint = F.when(F.col("__m0").isNull(), F.lit("")).otherwise(F.concat(*digits))
    return least.select(*keys, fingerprint.alias("fingerprint"))


def likeness(left: Column, right: Column) -> Column:
    """The share of equal samples; 1 for two texts without words, 0 if only one has none."""
    same = F.lit(0)
    for k in range(SAMPLES):
        part = lambda x: F.substring(x, k * DIGITS + 1, DIGITS)  # noqa: B023, E731
        same = same + (part(left) == part(right)).cast("int")
    return (
        F.when((left == "") & (right == ""), 1.0)
        .when((left == "") | (right == ""), 0.0)
        .otherwise(same / F.lit(float(SAMPLES)))
    )


def _slice_bounds(docs: DataFrame, id_col: str, slices: int) -> tuple[list, object]:
    """Ids that end slices of about equal size, and the largest id.

    One row comes to the driver, or 16 ids to a slice where ids are no whole numbers.
    """
    kind = docs.schema[id_col].dataType
    most = F.max(id_col).alias("most")
    if isinstance(kind, T.IntegralType):
        shares = [i / slices for i in range(1, slices)]
        found = docs.agg(F.percentile_approx(id_col, shares, 20 * slices).alias("bounds"), most).first()
        return sorted({int(x) for x in found["bounds"] or []}), found["most"]
    # The ids with the least hashes are a sample of all ids; the order is Spark's own.
    ids = docs.select(id_col).dropna()
    drawn = ids.orderBy(F.xxhash64(id_col)).limit(16 * slices).distinct().orderBy(id_col)
    return [row[0] for row in drawn.collect()][15:-1:16], docs.agg(most).first()["most"]


def _slice_of(value: Column, bounds: list) -> Column:
    """How many bounds are smaller: a binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    sorted_bounds = F.array(*[F.lit(x) for x in bounds])
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def narrowed(seen: Column, _: Column) -> Column:
        middle = F.floor((seen["low"] + seen["high"]) / 2).cast("int")
        smaller = F.get(sorted_bounds, middle) < value
        open_ = seen["low"] < seen["high"]
        return F.struct(
            F.when(open_ & smaller, middle + 1).otherwise(seen["low"]).alias("low"),
            F.when(open_ & ~smaller, middle).otherwise(seen["high"]).alias("high"),
        )

    return F.aggregate(steps, start, narrowed, lambda seen: seen["low"])


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None
) -> DataFrame:
    """(__slice, __row, __extra, id, text, next): every text beside the next by descending id.

    The last text's next is the first. Ids are cut into slices by bounds that are ids themselves,
    so a slice's first document is known and sent to the slice above it as well. Texts are shuffled
    once, by slice. Ids are of any type that sorts. Rows of equal id follow each other in order of
    a hash of their text, in one slice; null ids come last. The default of ``slices`` is eight to a shuffle partition.
    """
    spark = docs.sparkSession
    slices = slices or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    bounds, most = _slice_bounds(own.select("id"), "id", slices)
    at = F.coalesce(_slice_of(F.col("id"), bounds), F.lit(0))
    copies = [F.struct(at.alias("slice"), F.lit(False).alias("extra"))]
    none = F.lit(None).cast("struct<slice:int,extra:boolean>")
    if bounds:
        copies.append(
            F.when(
                F.col("id").isin(bounds), F.struct((at + 1).alias("slice"), F.lit(True).alias("extra"))
            ).otherwise(none)
        )
    # The first document of all follows the last; without any id every text follows itself.
    first = F.lit(True) if most is None else F.col("id") == most
    copies.append(
        F.when(first, F.struct(F.lit(0).alias("slice"), F.lit(True).alias("extra"))).otherwise(none)
    )
    dealt = own.withColumn("__to", F.explode(F.array_compact(F.array(*copies)))).select(
        F.col("__to.slice").alias("__slice"), F.col("__to.extra").alias("__extra"), "id", "text"
    )
    in_order = Window.partitionBy("__slice").orderBy(
        "__extra", F.col("id").desc_nulls_last(), F.xxhash64("text")
    )
    return dealt.withColumns(
        {"__row": F.row_number().over(in_order), "next": F.lead("text").over(in_order)}
    )


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None
) -> DataFrame:
    """Fingerprints of texts and of their edited texts, by id.

    The edited text has the last half of a text's code points replaced by as many of the next
    text's first. Returns id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``. Equal texts have equal fingerprints.

    One shuffle of the texts, after which everything is done where the slice lies: terms, samples,
    and the fingerprint of the next document. Null texts count as empty; texts without words have
    the empty fingerprint. Repeated rows follow each other, an empty table gives an empty result.
    Rows that share an id, or have none, meet in one slice. Only the two named columns are read.
    """
    both = with_next(docs, id_col, text_col, slices)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), half),
    )
    texts = both.select(
        "__slice", "__row", "__extra", "id", n.cast("bigint").alias("n_chars"), "text",
        F.when(~F.col("__extra"), edited).alias("edited"),
    )
    variants = texts.select(
        "__slice", "__row", "__extra", "id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
                    F.when(
                        ~F.col("__extra"),
                        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
                    ),
                )
            )
        ).alias("v"),
    )
    keys = ["__slice", "__row", "__extra", "id", "n_chars", "edited_sha256", "which"]
    termed = variants.withColumn("which", F.col("v.which")).select(
        *keys, weighted_terms(F.col("v.text")).alias("terms")
    )
    prints = sampled(termed, keys, "terms")
    of = lambda which: F.max(F.when(F.col("which") == which, F.col("fingerprint")))
    rows = prints.groupBy(*keys[:-1]).agg(
        of(0).alias("fingerprint"), of(1).alias("edited_fingerprint")
    )
    in_order = Window.partitionBy("__slice").orderBy("__row")
    rows = rows.withColumn("__next", F.lead("fingerprint").over(in_order)).filter(~F.col("__extra"))
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )
