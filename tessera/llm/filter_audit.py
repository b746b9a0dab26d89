"""What each filter of a corpus removes, in every order of the filters: one CUBE over failure flags.

A document is a row of five failure flags. Documents shrink to counts by part and flags, and a CUBE over part and
flags sums them for every subset of flags: the row of a grouping set whose selected flags are all false counts what
survives that subset of filters, in any order. A step of an order is a pair of subsets, before and after it, and a join of
the survivors with themselves has all 80 pairs of a part. Nothing but counts is kept of a document.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import picked, written

FILTERS = "ABCDE"
#: Each filter's bit in a subset's number, as grouping_id() has them: the first column is the highest.
BITS = {f: 1 << (len(FILTERS) - 1 - k) for k, f in enumerate(FILTERS)}
ALL = (1 << len(FILTERS)) - 1

#: Fixed values of the filters: least words, least percentage of distinct words, greatest percentage of capitals, signs.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 100, 80, 10, "[#$%&*|]"


def flagged(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, A, B, C, D): what the text alone decides, and its SHA-256 for E.

    Null texts are empty, null parts the empty string. Long texts count whole. Null ids and repeated rows stay.
    """
    rows = picked(docs, doc_id="doc_id", text="text", part=part)
    rows = rows.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumns({"n": F.size("words"), "distinct": F.size(F.array_distinct("words"))})
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.col("n") < LEAST_WORDS).alias("A"),
        (100 * F.col("distinct") < LEAST_DISTINCT * F.col("n")).alias("B"),
        (100 * capitals > MOST_CAPITALS * F.length("text")).alias("C"),
        F.col("text").rlike(SIGNS).alias("D"),
    )


def tallied(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A..E, n, good, toxic): documents by part and all flags, at most 32 rows a part.

    E: the text is that of a smaller doc_id, anywhere in the table. Rows with a null id neither fail it nor make others
    fail; rows that repeat the least id of their text don't fail. A document is good or toxic if any of its rows in ``labels``
    says so. Rows are counted before each shuffle, so that neither a text of many copies nor an id of many rows gathers.
    """
    own = ["part", "digest", "A", "B", "C", "D"]
    rows = flags.groupBy("doc_id", *own).agg(F.count("*").alias("n"))
    marks = picked(labels, doc_id="doc_id", quality="quality", toxic="toxic").where("doc_id is not null")
    marks = marks.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    named = F.col("doc_id").isNotNull()
    groups = rows.groupBy(*own, "good", "toxic").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(named, F.col("n"))), F.lit(0)).alias("named"), F.min(F.when(named, F.struct("doc_id", "n"))).alias("low")
    )
    least = groups.groupBy("digest").agg(F.min("low.doc_id").alias("least"))
    # a digest has a row for each part and label here, whatever the number of its copies
    groups = groups.join(least, "digest")
    fails = F.col("named") - F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(0)
    parts = groups.withColumn("f", F.coalesce(fails, F.lit(0))).withColumn("e", F.explode(F.array(F.struct(F.lit(False).alias("E"), (F.col("n") - F.col("f")).alias("k")), F.struct(F.lit(True).alias("E"), F.col("f").alias("k")))))
    parts = parts.select("part", "A", "B", "C", "D", "e.E", "e.k", "good", "toxic")
    return parts.groupBy("part", *FILTERS).agg(F.sum("k").alias("n"), F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("k")).otherwise(0)).alias("toxic"))


def survivors(tally: DataFrame) -> DataFrame:
    """(part, subset, n, good, toxic) for each part and all 32 subsets of filters, zeros included."""
    cube = tally.cube("part", *FILTERS).agg(F.grouping_id().alias("g"), F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    clear = cube.where((F.col("g") <= ALL) & ~F.greatest(*(F.coalesce(f, F.lit(False)) for f in FILTERS)))
    clear = clear.select("part", (F.lit(ALL) - F.col("g")).cast("int").alias("subset"), "n", "good", "toxic")
    every = tally.select("part").distinct().withColumn("subset", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
    return every.join(clear, ["part", "subset"], "left").fillna(0, ["n", "good", "toxic"])


def _bit(letter: Column) -> Column:
    return sum((F.when(letter == f, F.lit(b)).otherwise(F.lit(0)) for f, b in BITS.items()), start=F.lit(0))


def pairs(alive: DataFrame) -> DataFrame:
    """(part, before, filter, kept, removed, good_lost, toxic_lost): each subset beside itself with one filter more."""
    after = alive.select("part", F.col("subset").alias("after"), F.col("n").alias("kept"), F.col("good").alias("good_kept"), F.col("toxic").alias("toxic_kept"))
    more = F.array(*(F.struct(F.lit(f).alias("filter"), F.lit(b).alias("bit")) for f, b in BITS.items()))
    before = alive.withColumn("m", F.explode(more)).where(F.col("subset").bitwiseAND(F.col("m.bit")) == 0)
    before = before.select("part", F.col("subset").alias("before"), "m.filter", "m.bit", (F.col("subset") + F.col("m.bit")).alias("after"), "n", "good", "toxic")
    both = before.join(after, ["part", "after"])
    return both.select("part", "before", "filter", "bit", "kept", (F.col("n") - F.col("kept")).alias("removed"), (F.col("good") - F.col("good_kept")).alias("good_lost"), (F.col("toxic") - F.col("toxic_kept")).alias("toxic_lost"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row for each part, order of the five filters and step, with what the step keeps and removes.

    Nulls, empty and long texts, ties and repeated rows as in ``flagged`` and ``tallied``; other columns don't matter. A
    part with few documents has all its 600 rows, no documents give none; labels may be empty.
    """
    # texts are read once: all that follows reads counts, at most 32 rows a part, and then 80
    tally = written(tallied(flagged(docs, part), labels), "tally")
    found = written(pairs(survivors(tally)), "pairs")
    # an order puts the filters of a subset first, then this one: |S|! (4 - |S|)! orders
    ways = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS)))), F.bit_count("before") + 1)
    alone = found.groupBy("part", "filter").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.max(F.when(F.col("before") + F.col("bit") == ALL, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * ways).alias("shapley"),
    )
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = found.select("part").distinct().withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.col("filter_order").substr(F.col("step"), F.lit(1))
    earlier = F.col("filter_order").substr(F.lit(1), F.col("step") - 1)
    before = sum((F.when(F.instr(earlier, f) > 0, F.lit(b)).otherwise(F.lit(0)) for f, b in BITS.items()), start=F.lit(0))
    steps = steps.select("part", "filter_order", "step", letter.alias("filter"), before.alias("before"))
    rows = steps.join(found, ["part", "before", "filter"]).join(alone, ["part", "filter"])
    return rows.select("part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (SELECT w.part, w.doc_id,
        CASE WHEN len(ws) < 100 THEN 16 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 8 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 2 ELSE 0 END
        + CASE WHEN min(w.doc_id) OVER (PARTITION BY t) < w.doc_id THEN 1 ELSE 0 END AS flags,
        CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS good, CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END AS toxic
      FROM w LEFT JOIN labels l ON l.doc_id = w.doc_id),
c AS (SELECT part, flags, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
s AS (SELECT p.part, m.m AS subset, coalesce(sum(n), 0) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM (SELECT DISTINCT part FROM d) p CROSS JOIN (SELECT CAST(range AS INTEGER) AS m FROM range(32)) m
      LEFT JOIN c ON c.part = p.part AND (c.flags & m.m) = 0 GROUP BY ALL),
x AS (SELECT * FROM (VALUES ('A', 16), ('B', 8), ('C', 4), ('D', 2), ('E', 1)) v(f, b)),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM x a, x b, x c, x d, x e
      WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
t AS (SELECT filter_order, k.k AS step, CAST(coalesce(list_sum(bits[1:k.k - 1]), 0) AS INTEGER) AS before, bits[k.k] AS bit
      FROM o CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(1, 6)) k),
r AS (SELECT a.part, filter_order, step, bit, b.n AS kept, a.n - b.n AS removed, a.good - b.good AS good_lost, a.toxic - b.toxic AS toxic_lost
      FROM t JOIN s a ON a.subset = before JOIN s b ON b.part = a.part AND b.subset = before + bit)
SELECT r.part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(z.n - g.n - removed AS BIGINT) AS redundant,
       CAST(u.n - v.n AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY r.part, bit) AS BIGINT) AS shapley
FROM r JOIN s z ON z.part = r.part AND z.subset = 0 JOIN s g ON g.part = r.part AND g.subset = bit
JOIN s u ON u.part = r.part AND u.subset = 31 - bit JOIN s v ON v.part = r.part AND v.subset = 31
"""
