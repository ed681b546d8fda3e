"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key, made of its id, its text and its other columns. Within its source the documents are ordered by that key, the running sum of their
sizes is built from sums of key ranges, and the source is cut exactly at its budget: whole epochs first, then documents
in key order, the last one for the words that are still missing.

Rows that are equal in everything are one row with a count, summed before the shuffle, until their shares are known; so a group
of copies, or all rows without an id, are no single task's work. No task holds a source: a source is split into ranges of
its keys of about `RANGE_ROWS` distinct rows each, and only the table of ranges is summed in order, source by source. The table
of sources is ordered by one task: some millions of them at most.

Defined cases: a null text has size 0; a null source is one source, last in order; documents of size 0 are never taken;
equal rows are interchangeable and each gets its own place; rows of one id are documents of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import WORD, stored, table

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
RANGE_ROWS = 4096
KEY_SPAN = 1 << 32
COPIES = 1 << 16  # copies of a row that are made from one array


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(docs: DataFrame, seed: int) -> Column:
    """Hash-random key of a row: 32 hex digits, the same in every run, and for rows that are equal in all columns only."""
    others = [name for name in docs.columns if name not in ("doc_id", "text", "source")]
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))]
    if others:
        parts.append(F.md5(F.to_json(F.struct(*others))))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: its size, its target in words, and into how many key ranges it is split. `sized` has rows with a count n.

    The targets share the size of all sources by weight; none exceeds `most` times its source, and the excess goes to the
    others by weight. With the sources in the order of cap / weight, a source is at its cap if that ratio is at most what
    a unit of weight gets once all sources before it are at theirs.
    """
    sources = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # One row per source is left, so ordering them all in one task is a small step.
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weighted = sources.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int")).cast("double"))
    weighted = weighted.withColumn("cap", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = weighted.select(
        "*",
        ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))).alias("unit"),
    ).withColumn("free", F.col("cap") / F.col("w") > F.col("unit"))
    unit = F.max(F.when(F.col("free"), F.col("unit"))).over(whole)
    return level.withColumn("target", F.when(F.col("free"), unit * F.col("w")).otherwise(F.col("cap"))).select(
        "source", "source_size", "target", F.ceil(F.col("n_docs") / RANGE_ROWS).cast("long").alias("n_ranges")
    )


def _shares(docs: DataFrame, seed: int, weights: tuple[int, ...]) -> DataFrame:
    """(doc_id, source, size, key, n, source_size, target, epochs, left): each distinct row, how often it is there, and the words
    that the cut leaves for its copies, one after the other."""
    sized = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(docs, seed).alias("key"))
        .groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("n")),
        "mix-sizes",
    )
    sources = stored(source_targets(sized, weights), "mix-sources")
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = (
        sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("doc_id", "d.source", "size", "key", "n", "source_size", "target",
                F.floor(head * F.col("n_ranges") / KEY_SPAN).alias("range"))
    )
    words = F.col("size") * F.col("n")
    ranges = placed.groupBy("source", "range").agg(F.sum(words).alias("range_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    joined = running.alias("d").join(
        ranges.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.range") == F.col("r.range"))
    )
    source_size, budget = F.col("source_size"), F.floor(F.col("target") + 0.5)
    epochs = F.when(source_size > 0, F.floor(budget / source_size)).otherwise(0)
    left = budget - epochs * source_size - F.col("range_start") - F.col("before")
    return joined.select("doc_id", "d.source", "size", "key", "n", "source_size", "target", epochs.alias("epochs"), left.alias("left"))


def _each_copy(rows: DataFrame) -> DataFrame:
    """As many rows as `n` says, with `taken`: the words that the mix takes of each."""
    span = F.lit(COPIES).cast("long")
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))))
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * span, F.least(F.col("block") * span + span, F.col("n")) - 1)))
    size, left = F.col("size"), F.col("left") - F.col("copy") * F.col("size")
    taken = F.col("epochs") * size + F.least(size, F.greatest(left, F.lit(0).cast("long")))
    return copies.withColumn("taken", taken.cast("long"))


def mixed_shares(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of `docs`."""
    return _each_copy(_shares(docs, seed, weights)).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of `docs`: documents repeated, left out, or cut after the words still taken."""
    shares = _shares(docs, seed, WEIGHTS).where((F.col("epochs") > 0) | (F.col("left") > 0)).where("size > 0").select(
        "key", "size", "n", "epochs", "left")
    words = f"[\\x20\\x09-\\x0D]*{WORD}"
    # Rows of one key are equal in all columns, so any of them stands for all.
    rows = docs.select(mix_key(docs, seed).alias("key"), F.struct(*docs.columns).alias("row")).groupBy("key").agg(F.any_value("row").alias("row"))
    taken = _each_copy(rows.join(shares, "key")).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = taken.select("row", "size", "taken", F.explode(F.sequence(F.lit(1), copies)).alias("time"))
    text, keep = F.col("row.text"), F.least(F.col("taken") - (F.col("time") - 1) * F.col("size"), F.col("size"))
    parts = F.regexp_extract_all(text, F.lit(f"({words})"), F.lit(1))
    rows = rows.withColumn("new", F.when(
        keep < F.col("size"), F.array_join(F.slice(parts, F.lit(1), keep.cast("int")), "")).otherwise(text))
    columns = {"text": F.col("new")} | ({"n_chars": F.char_length("new").cast("long")} if "n_chars" in docs.columns else {})
    return rows.select(*[columns.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed_shares(docs).select("doc_id", "size", "source_size", "target", "taken")


_SOURCES = f"""
    SELECT source, source_size, w, cap, n_ranges,
           (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS unit
    FROM (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
                 CAST(source_size * {MOST_EPOCHS} AS DOUBLE) AS cap
          FROM (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, ceil(count(*) / {RANGE_ROWS}) AS n_ranges
                FROM sized GROUP BY source))
    WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

OP1_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS k,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
levels AS ({_SOURCES}),
targets AS (
    SELECT source, source_size,
           CASE WHEN cap / w > unit THEN max(CASE WHEN cap / w > unit THEN unit END) OVER () * w ELSE cap END AS target
    FROM levels),
running AS (
    SELECT doc_id, size, source_size, target, floor(target + 0.5) AS budget,
           CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END AS epochs,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(epochs * size + least(size, greatest(budget - epochs * source_size - before, 0)) AS BIGINT) AS taken
FROM running"""
