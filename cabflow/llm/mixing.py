"""Mixing sources to target weights by capped water-filling.

Every source gets a share of a word budget in proportion to its weight, but
at most ``max_epochs`` times its own size; what a source cannot take is
shared anew among the others by weight until no source is above its cap.
A source with target ``t`` and size ``s`` repeats every document
``floor(t / s)`` times whole; the remaining words are taken once more from
its documents in a seeded random order, and the last document of that pass
is taken in part, so the source meets its target to the word.

Scale: the only per-source work is on sums.  The seeded order needs no sort
of a source: documents fall into 4096 hash buckets per source, prefix sums run over
the bucket sums, and only the rows of the one bucket in which the pass ends
(1/4096 of a source) are ordered, as one row for each distinct document.

Defined cases: null text has size 0; a null source is a source of its own
that comes last; equal rows (same id, same text) share what they take
evenly, rounded down; an empty table gives an empty result; input columns
that clash with result columns are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm.common import require, stored

# What counts as a word of a text.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
#: Hex digits of the seeded key that name a bucket: 16 ** 3 buckets a source.
DIGITS = 3


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def keyed(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    """``size``, the seeded ``mix_key`` and the null-safe source columns."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                            F.md5(F.coalesce(F.col(text), F.lit("")))))
    return (docs.withColumns({"mix_null": F.col(source).isNull(), "mix_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
                              "mix_size": word_count(text), "mix_key": key})
                .withColumn("mix_bucket", F.substring("mix_key", 1, DIGITS)))


def ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 in code point order, null last: a range sort,
    then an offset for each sorted partition (no single-task window)."""
    order = ["mix_null", "mix_source"]
    placed = stored(sources.orderBy(*order).select("*", F.spark_partition_id().alias("part")))
    # One count per sorted partition: at most spark.sql.shuffle.partitions rows.
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    offsets = placed.sparkSession.createDataFrame(starts, "part int, start long")
    w = Window.partitionBy("part").orderBy(*order)
    return placed.join(offsets, "part").withColumn("rank", F.row_number().over(w) - 1 + F.col("start")).drop("part", "start")


def water_fill(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """Add ``weight`` and ``target`` to a table of sources (``rank``, ``source_size``).

    Sums of weights and of caps are whole numbers, so the level does not
    depend on the order of summing.  Each pass sends three numbers to the
    driver; a pass can only raise the level and cap more sources.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    s = stored(sources.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs))
    total = budget if budget is not None else (s.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("cap").cast("double") < F.col("weight").cast("double") * F.lit(level) if capped >= 0 else F.lit(False)
        n, fixed, free = s.agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
                               F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == capped:
            break
        capped = n
        if not free:
            level = float("inf") if n else 0.0
            break
        level = float(total - fixed) / float(free)
    share = F.col("weight").cast("double") * F.lit(level)
    return s.withColumn("target", F.least(share, F.col("cap").cast("double"))).drop("cap")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        max_epochs: int = MAX_EPOCHS, budget: int | None = None, seed: str = SEED) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken`` words."""
    require(docs, doc_id=doc_id, text=text, source=source)
    results = ["size", "source_size", "target", "taken"]
    docs = docs.drop(*[c for c in results if c not in (doc_id, text, source)])
    return _mix(keyed(docs, doc_id, text, source, seed), docs.columns, weights, max_epochs, budget)


def _mix(rows: DataFrame, keep: list[str], weights, max_epochs, budget) -> DataFrame:
    by = ["mix_null", "mix_source"]
    buckets = stored(rows.groupBy(*by, "mix_bucket").agg(F.sum("mix_size").alias("words")))
    sources = buckets.groupBy(*by).agg(F.sum("words").alias("source_size"))
    sources = water_fill(ranked(sources), weights, max_epochs, budget)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = (sources.withColumn("whole", whole)
                      .withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("long")))
    # At most 4096 rows a source: where in the seeded order does the last, partial pass end?
    before = F.sum("words").over(Window.partitionBy(*by).orderBy("mix_bucket")) - F.col("words")
    ends = (buckets.withColumn("before", before).join(sources, by)
            .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
            .groupBy(*by).agg(F.min("mix_bucket").alias("end_bucket"), F.max("before").alias("end_before")))
    plan = stored(sources.join(ends, by, "left").select(*by, "source_size", "target", "whole", "rest", "end_bucket",
                                                        (F.col("rest") - F.col("end_before")).alias("end_words")))
    # No bucket ends the pass when the rest is the whole source: all of it is taken.
    joined = rows.join(plan, by)
    at_end = F.col("mix_bucket") == F.col("end_bucket")
    base = F.col("whole") * F.col("mix_size")
    out = lambda d, taken: d.select(*keep, F.col("mix_size").alias("size"), "source_size", "target",
                                    taken.cast("long").alias("taken"))
    clear = joined.where(F.coalesce(~at_end, F.lit(True)))
    full = F.col("end_bucket").isNull() & (F.col("rest") > 0) | F.coalesce(F.col("mix_bucket") < F.col("end_bucket"), F.lit(False))
    clear = out(clear, base + F.when(full, F.col("mix_size")).otherwise(0))
    last = joined.where(at_end)
    group = (last.groupBy(*by, "mix_key").agg(F.count(F.lit(1)).alias("copies"), F.max("mix_size").alias("one"), F.max("end_words").alias("end_words_"))
                 .withColumn("all", F.col("copies") * F.col("one")))
    start = F.sum("all").over(Window.partitionBy(*by).orderBy("mix_key")) - F.col("all")
    group = (group.withColumn("part", F.greatest(F.lit(0), F.least(F.col("all"), F.col("end_words_") - start)))
                  .select(*by, "mix_key", F.floor(F.col("part") / F.col("copies")).cast("long").alias("part")))
    last = out(last.join(group, [*by, "mix_key"]), base + F.col("part"))
    return clear.unionByName(last)


def mix_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kw) -> DataFrame:
    """``mix`` without the texts: one pass over them, everything else on a
    narrow table (id, source, size, key).  Returns id and the result columns."""
    require(docs, doc_id=doc_id, text=text, source=source)
    narrow = stored(keyed(docs, doc_id, text, source, kw.pop("seed", SEED))
                    .select(F.col(doc_id).alias("doc_id"), "mix_null", "mix_source", "mix_size", "mix_key", "mix_bucket"))
    return _mix(narrow, ["doc_id"], kw.pop("weights", WEIGHTS), kw.pop("max_epochs", MAX_EPOCHS), kw.pop("budget", None))


def repeat(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **kw) -> DataFrame:
    """The mixed corpus itself: each document as many times as it is taken
    whole, and once more with its first words when it is taken in part.
    Columns are those of ``docs``; ``n_chars``, if there, is counted anew."""
    cols = docs.columns
    m = mix(docs.select(F.struct(*cols).alias("mix_row"), F.col(doc_id).alias("mix_id"), F.col(text).alias("mix_text"), F.col(source).alias("mix_src")),
            "mix_id", "mix_text", "mix_src", **kw)
    m = m.where("size > 0").withColumn("copies", F.floor(F.col("taken") / F.col("size")).cast("int")).withColumn("over", F.col("taken") % F.col("size"))
    whole = m.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    # The first `over` words, with the white space before and between them.
    part = m.where("over > 0")
    words = F.array_join(F.slice(F.regexp_extract_all("mix_text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("over").cast("int")), "")
    rows = whole.select("mix_row", "mix_text").unionByName(part.select("mix_row", words.alias("mix_text")))
    fixed = {text: F.col("mix_text")} | ({"n_chars": F.length("mix_text").cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in cols else {})
    return rows.select(*[fixed.get(c, F.col("mix_row")[c]).alias(c) for c in cols])


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM s),
t AS (SELECT sum(source_size)::DOUBLE AS total FROM r),
lv AS (
  WITH RECURSIVE fill(i, level) AS (
    SELECT 0, (SELECT total FROM t) / (SELECT sum(w) FROM r)
    UNION ALL
    SELECT any_value(f.i) + 1,
           (any_value(t.total) - coalesce(sum(r.cap) FILTER (r.cap::DOUBLE < r.w * f.level), 0)::DOUBLE)
           / sum(r.w) FILTER (r.cap::DOUBLE >= r.w * f.level)::DOUBLE
    FROM fill f, r, t WHERE f.i < 40 GROUP BY f.i)
  SELECT max(level) AS level FROM fill),
p AS (SELECT source, source_size, least(w * level, cap::DOUBLE) AS target FROM r, lv),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM p),
q2 AS (SELECT *, floor(target - whole * source_size + 0.5)::BIGINT AS rest FROM q),
g AS (SELECT source, k, count(*) AS copies, max(size) AS one, count(*) * max(size) AS words FROM d GROUP BY source, k),
o AS (SELECT *, (sum(words) OVER (PARTITION BY source ORDER BY k) - words)::BIGINT AS before FROM g)
SELECT d.doc_id, d.size, q2.source_size, q2.target,
       (q2.whole * d.size + greatest(0, least(o.words, q2.rest - o.before)) // o.copies)::BIGINT AS taken
FROM d JOIN q2 ON d.source IS NOT DISTINCT FROM q2.source
JOIN o ON d.source IS NOT DISTINCT FROM o.source AND d.k = o.k
"""
