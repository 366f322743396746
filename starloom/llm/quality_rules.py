"""Quality rules whose cut-offs adapt to each language and source.

Every document is measured once (whole text, Arrow-batched). For documents that pass the base
rule, four ratios are counted in mergeable quantile sketches: per language, source and ratio a
histogram over bins that keep the leading six bits of the value, so a quantile is known within
1/32 of itself, a sketch has at most about two thousand bins whatever the data, and sketches
merge by adding counts. Spark adds them map-side before the shuffle, so a hot source costs no
more than its bins.

The cut-offs of a group are Tukey's outer fences of its sketch, ``q25 - 3 * spread`` and
``q75 + 3 * spread`` with ``spread = max(q75 - q25, the rule's least spread)``: they follow the
group's own habits, and a group without outliers loses nothing. A group below ``MIN_DOCUMENTS``
takes the merged sketch of its language, a small language that of all documents. The fences are
joined back to the measures (null languages and sources are groups of their own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import worker_state
from starloom.session import scratch_path

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_DOCUMENTS = 100
#: ratio -> (numerator, denominator, scale, least spread, lower fence, upper fence)
RATIOS = {
    "word_length": ("word_chars", "n_words", 100, 100, True, True),
    "symbols": ("n_symbols", "n_words", 1000, 60, False, True),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 150, False, True),
    "repeats": ("n_repeat_words", "n_words", 1000, 120, False, True),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def repeated_words(words: list) -> int:
    """Words that stand in a window of three words which occurs at least twice."""
    if len(words) < 4:
        return 0
    ids: dict = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 1 << 20:  # keep the next product within 64 bits
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * len(ids) + a[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    repeats = np.isin(window, twice)
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(repeats)] |= repeats
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """COUNTS of one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII spaces
    spaces = sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines, seen, dup = 0, set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return len(words), len(text) - spaces, symbols, dup, repeated_words(words), lines


@F.arrow_udf(COUNTS_TYPE)
def measures(texts: pa.Array) -> pa.Array:
    worker_state("quality_rules", dict)  # frees what an earlier stage's operator remembered
    columns = list(zip(*(measure(t.as_py() or "") for t in texts), strict=True)) or [[] for _ in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def base_failed(counts: str = "c") -> Column:
    n, r = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def ratio(name: str, counts: str = "c") -> Column:
    """The ratio as an integer; a zero denominator counts as 1."""
    top, bottom, scale, *_ = RATIOS[name]
    return F.floor(F.col(f"{counts}.{top}") * scale / F.greatest(F.col(f"{counts}.{bottom}"), F.lit(1)))


def sketch_bin(value: Column) -> Column:
    """The value with all but its leading six bits cleared (exact below 64)."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    step = F.pow(F.lit(2), drop).cast("long")
    return (F.floor(value / step) * step).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, ratio, bin, n``: the mergeable sketch of every group."""
    rows = measured.where(~base_failed()).select(
        "lang",
        "source",
        F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), sketch_bin(ratio(r)).alias("bin")) for r in RATIOS])).alias("x"),
    )
    return rows.groupBy("lang", "source", "x.ratio", "x.bin").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: counts of equal bins add up."""
    return sketch.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """``keys, ratio, docs, q25, q75`` of each sketch: the bin that holds the rank."""
    part = Window.partitionBy(*keys, "ratio")
    upto = F.sum("n").over(part.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketch.select(*keys, "ratio", "bin", upto.alias("upto"), F.sum("n").over(part).alias("docs"))
    return ranked.groupBy(*keys, "ratio").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("bin"))).alias("q25"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs") * 3, F.col("bin"))).alias("q75"),
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per language and source, with ``<ratio>_low`` and ``<ratio>_high``."""
    by_lang = quartiles(merge(sketch, "lang"), "lang").select(
        F.col("lang").alias("l"), F.col("ratio").alias("lr"), F.col("docs").alias("ld"), F.col("q25").alias("l25"), F.col("q75").alias("l75")
    )
    overall = quartiles(merge(sketch)).select(F.col("ratio").alias("ar"), F.col("q25").alias("a25"), F.col("q75").alias("a75"))
    q = quartiles(sketch, "lang", "source")
    q = q.join(by_lang, q.lang.eqNullSafe(F.col("l")) & (q.ratio == F.col("lr")), "left").join(overall, q.ratio == F.col("ar"), "left")
    own, language = F.col("docs") >= MIN_DOCUMENTS, F.col("ld") >= MIN_DOCUMENTS
    low = F.when(own, F.col("q25")).when(language, F.col("l25")).otherwise(F.col("a25"))
    high = F.when(own, F.col("q75")).when(language, F.col("l75")).otherwise(F.col("a75"))
    least = F.coalesce(*[F.when(F.col("ratio") == r, F.lit(RATIOS[r][3])) for r in RATIOS])
    q = q.select("lang", "source", "ratio", low.alias("q25"), high.alias("q75"), F.greatest(high - low, least).alias("spread"))
    pick = lambda r, c: F.max(F.when(F.col("ratio") == r, c))
    return q.groupBy("lang", "source").agg(
        *[pick(r, F.col("q25") - 3 * F.col("spread")).alias(f"{r}_low") for r in RATIOS],
        *[pick(r, F.col("q75") + 3 * F.col("spread")).alias(f"{r}_high") for r in RATIOS],
    )


def within(name: str) -> Column:
    """Whether the ratio lies inside its fences (no fence: yes)."""
    *_, low, high = RATIOS[name]
    ok, value = F.lit(True), F.col(f"r_{name}")
    if low:
        ok = ok & F.coalesce(value >= F.col(f"{name}_low"), F.lit(True))
    if high:
        ok = ok & F.coalesce(value <= F.col(f"{name}_high"), F.lit(True))
    return ok


def judge(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, COUNTS, ``base_failed, kept, failed_ratios`` per document.

    Null and empty texts have no words and fail the base rule. Null languages and sources form
    groups of their own. Repeated rows are judged each. Other columns are not carried. The
    measures are written once to the shared checkpoint folder (a few numbers per document) and
    read for the sketches and for the filter, so texts are read once.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "quality-measures")
    documents.select("doc_id", "lang", "source", measures(F.col("text")).alias("c")).write.parquet(path)
    measured = spark.read.parquet(path)
    limits = fences(sketches(measured)).withColumnRenamed("lang", "g_lang").withColumnRenamed("source", "g_source")
    rows = measured.select("*", *[ratio(r).alias(f"r_{r}") for r in RATIOS])
    joined = rows.join(limits, rows.lang.eqNullSafe(F.col("g_lang")) & rows.source.eqNullSafe(F.col("g_source")), "left")
    failed = F.array_compact(F.array(*[F.when(~within(r), F.lit(r)) for r in RATIOS]))
    return joined.select(
        "doc_id",
        "lang",
        "source",
        *[F.col(f"c.{c}").alias(c) for c in COUNTS],
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(failed) == 0)).alias("kept"),
        F.when(base_failed(), F.array().cast("array<string>")).otherwise(failed).alias("failed_ratios"),
    )


def accepted(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Measures stay beside each row in one pass; the fences are joined to them, so no text is
    shuffled and nothing is matched by id (repeated ids are judged by their own text).
    """
    sketch = sketches(documents.select("lang", "source", measures(F.col("text")).alias("c")))
    path = scratch_path(documents.sparkSession, "quality-fences")
    fences(sketch).write.parquet(path)
    limits = documents.sparkSession.read.parquet(path)
    names = documents.columns
    doc = F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")
    rows = documents.select(doc, measures(F.col("text")).alias("c"))
    rows = rows.select("*", *[ratio(r).alias(f"r_{r}") for r in RATIOS])
    joined = rows.join(
        limits, F.col("doc.lang").eqNullSafe(F.col("lang")) & F.col("doc.source").eqNullSafe(F.col("source")), "left"
    )
    keep = ~base_failed()
    for r in RATIOS:
        keep = keep & within(r)
    return joined.where(keep).select("doc.*")


def op4_quality_rules(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The contract's columns and the ratios that failed."""
    columns = ["doc_id", *COUNTS[:5], "base_failed", "kept", F.concat_ws(",", "failed_ratios").alias("failed_ratios")]
    return judge(documents).select(*columns)

