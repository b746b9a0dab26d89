"""Document fingerprints that tell what differs: invertible Bloom lookup sketches of paragraphs.

A text is a set of paragraph digests, a repeated paragraph counted by its occurrence. Each digest is added to three cells
of a sketch, one in each third; a cell holds a count, the sum of its digests and the sum of their checks. Two sketches
subtract cell by cell, which leaves what differs. Cells with one digest left are pure and give it away; taking it out of its
other cells makes more of them pure, until all are empty (the digests are recovered) or none is pure. In that case both texts are
sketched again with four times the cells, and so on. All texts of a batch are sketched and peeled together as arrays.

A paragraph is a run of text up to the end of a sentence or line, or of 160 characters, so that every character is in
one. Digests are found in the JVM; only they go to Python.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import hashed_sample, picked, written

#: Cells of a fingerprint (three times a power of two), and the factor by which a failed one grows.
CELLS, GROWTH = 48, 4

#: Cells of all sketches that are peeled at once.
AT_ONCE = 1 << 19

#: Waves of peeling after which a sketch counts as failed; a thousand times what a sketch that can be peeled takes.
MOST_WAVES = 100_000

PARAGRAPH = r"[^.!?\n]{0,160}[.!?\n]+|[^.!?\n]{1,160}"


def digests(text: Column) -> Column:
    """The digests of a text's paragraphs in order; of a null text none."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p))


# -- sketches as arrays -------------------------------------------------------------------------------


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all of ``x`` and on the seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _cells(keys: np.ndarray, cells: int) -> np.ndarray:
    """Each key's three cells, one in each third; other sizes deal keys anew."""
    third = cells // 3
    m = _mixed(keys, cells)
    return np.stack([((m >> np.uint64(21 * k)) % np.uint64(third)).astype(np.int64) + k * third for k in range(3)])


def _checks(keys: np.ndarray) -> np.ndarray:
    return _mixed(keys, 2).astype(np.uint32)


def told_apart(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Digests that are distinct within an owner: a repeated one is mixed with the number of times it came before."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    start = np.flatnonzero(fresh)
    times = np.arange(len(k)) - np.repeat(start, np.diff(np.append(start, len(k))))
    out = np.empty_like(keys)
    out[order] = np.where(times > 0, _mixed(k + times.astype(np.uint64), 1), k)
    return out


class Sketches:
    """Sketches of ``n`` texts: counts, sums of digests, sums of checks, flat by text and cell."""

    def __init__(self, n: int, cells: int) -> None:
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.total = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint32)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        at = (owner * self.cells + _cells(keys, self.cells)).ravel()
        sign = np.tile(np.broadcast_to(np.asarray(sign, np.int64), keys.shape), 3)
        np.add.at(self.count, at, sign)
        np.add.at(self.total, at, np.tile(keys, 3) * sign.astype(np.uint64))  # -1 wraps, as sums do
        np.add.at(self.check, at, np.tile(_checks(keys), 3) * sign.astype(np.uint32))

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells)
        out.count, out.total, out.check = self.count - other.count, self.total - other.total, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign, whether a text's sketch is empty now); empties the sketches as far as it goes."""
        owners, keys, signs = [], [], []
        live = np.flatnonzero(self.count)
        for _ in range(MOST_WAVES):
            if not len(live):
                break
            sign = self.count[live]
            one = np.abs(sign) == 1
            at, sign = live[one], sign[one]
            key = self.total[at] * sign.astype(np.uint64)
            pure = _checks(key) * sign.astype(np.uint32) == self.check[at]
            owner, key, sign = at[pure] // self.cells, key[pure], sign[pure]
            if not len(owner):
                break
            _, first = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1, return_index=True)
            owner, key, sign = owner[first], key[first], sign[first]
            self.add(owner, key, -sign)
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            live = np.unique((owner * self.cells + _cells(key, self.cells)).ravel())
            live = live[self.count[live] != 0]
        full = (self.count != 0) | (self.total != 0) | (self.check != 0)
        empty = ~full.reshape(self.n, self.cells).any(axis=1)
        joined = (np.concatenate(a) if a else np.empty(0, t) for a, t in ((owners, np.int64), (keys, np.uint64), (signs, np.int64)))
        return *joined, empty

    def texts(self) -> list[str]:
        """Each sketch as text: cells as count, sum and check in base 64."""
        packed = np.zeros((self.n, self.cells), [("count", "<i4"), ("total", "<u8"), ("check", "<u4")])
        for name in ("count", "total", "check"):
            packed[name] = getattr(self, name).reshape(self.n, self.cells)
        return [base64.b64encode(row.tobytes()).decode() for row in packed]


def parsed(fingerprints: list[str]) -> Sketches:
    """Fingerprints of one size back as sketches."""
    raw = [base64.b64decode(f) for f in fingerprints]
    cells = {len(r) // 16 for r in raw}
    if len(cells) != 1:
        raise ValueError(f"fingerprints of sizes {sorted(cells)}")
    packed = np.frombuffer(b"".join(raw), [("count", "<i4"), ("total", "<u8"), ("check", "<u4")])
    out = Sketches(len(raw), cells.pop())
    out.count, out.total, out.check = packed["count"].astype(np.int64), packed["total"].copy(), packed["check"].copy()
    return out


class Texts:
    """The digests of a batch of texts, flat, and how to sketch some of them."""

    def __init__(self, column: pa.ListArray) -> None:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.size = np.diff(column.offsets.to_numpy()).astype(np.int64)
        self.end = np.cumsum(self.size)
        self.keys = told_apart(column.flatten().to_numpy().astype(np.int64).view(np.uint64), np.repeat(np.arange(len(self.size)), self.size))

    def sketched(self, of: np.ndarray, cells: int) -> Sketches:
        size = self.size[of]
        begin = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.end[of] - size - begin, size)
        out = Sketches(len(of), cells)
        out.add(np.repeat(np.arange(len(of)), size), self.keys[at])
        return out


def differing(one: Texts, other: Texts, first: Sketches | None = None, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of all digests in one text of a pair and not in the other, from sketches that grow until they peel.

    ``first``: the pairs' sketches of the first size, subtracted.
    """
    found, open_ = [], np.arange(len(one.size))
    while len(open_):
        # so many more digests on one side than there are cells cannot be peeled
        due = np.abs(one.size[open_] - other.size[open_]) <= cells
        failed = [open_[~due]]
        todo = open_[due]
        for k in range(0, len(todo), max(1, AT_ONCE // cells)):
            part = todo[k : k + max(1, AT_ONCE // cells)]
            if first is not None and len(part) == first.n:
                left, first = first, None
            else:
                left = one.sketched(part, cells).minus(other.sketched(part, cells))
            owner, key, sign, done = left.peel()
            keep = done[owner]
            found.append((part[owner[keep]], key[keep], sign[keep]))
            failed.append(part[~done])
        open_, cells, first = np.concatenate(failed), cells * GROWTH, None
    return tuple(np.concatenate(a) for a in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))


def likeness(one: np.ndarray, other: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sets from their sizes and the number of members that differ; two empty sets are alike."""
    return (one + other - differ) / np.maximum(one + other + differ, 1) + (one + other == 0)


# -- tables -------------------------------------------------------------------------------------------


def _fingerprinted(cells: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch["digests"])
            prints = pa.array(texts.sketched(np.arange(batch.num_rows), cells).texts(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in ("doc_id", "mark")), pa.array(texts.size), prints], ["doc_id", "mark", "n", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """(doc_id, mark, n, fingerprint): a row's SHA-256, its number of paragraphs, and its sketch as text.

    Null texts are empty; an empty text's sketch is empty. Long texts count whole. Null ids, ties and repeated rows stay.
    """
    rows = picked(docs, doc_id="doc_id", text="text")
    rows = rows.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("mark"), digests(F.col("text")).alias("digests"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, t) for n, t in (("mark", T.StringType()), ("n", T.LongType()), ("fingerprint", T.StringType())))])
    return rows.mapInArrow(_fingerprinted(cells), schema)


def _peeled(cells: int):
    empty = Sketches(1, cells).texts()[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (parsed([f or empty for f in batch[c].to_pylist()]) for c in ("old_fp", "new_fp"))
            owner, key, sign, done = one.minus(other).peel()
            lists = []
            for s in (1, -1):
                at = np.flatnonzero((sign == s) & done[owner])
                at = at[np.lexsort((key[at].view(np.int64), owner[at]))]
                n = np.bincount(owner[at], minlength=batch.num_rows)
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(key[at].view(np.int64))))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["old_n"], batch["new_n"], pa.array(done), *lists], ["doc_id", "old_n", "new_n", "done", "removed", "added"])

    return run


def changes(old: DataFrame, new: DataFrame, cells: int = CELLS) -> DataFrame:
    """(doc_id, likeness, removed, added, cells): what paragraphs differ between two versions of a table, by their digests.

    Only sketches meet, joined by id; documents whose sketch could not be peeled are sketched again with four times the
    cells, the others are not read again in full. An id in one version only has an empty text in the other. Of rows that share an id the
    one with the least SHA-256 counts; null ids are one id. Null and empty texts, long texts and further columns as in
    ``fingerprints``. Two empty tables: no rows.
    """
    out = failed = None
    spark = old.sparkSession
    while failed is None or not failed.isEmpty():
        sides = []
        for docs, name in ((old, "old"), (new, "new")):
            rows = picked(docs, doc_id="doc_id", text="text")
            if failed is not None:
                again = failed.select(F.col("doc_id").alias("again"))
                rows = rows.join(again, F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
            best = fingerprints(rows, cells).groupBy("doc_id").agg(F.min(F.struct("mark", "n", "fingerprint")).alias("b"))
            sides.append(best.select(F.col("doc_id").alias(f"{name}_id"), F.col("b.n").alias(f"{name}_n"), F.col("b.fingerprint").alias(f"{name}_fp")))
        both = sides[0].join(sides[1], F.col("old_id").eqNullSafe(F.col("new_id")), "full_outer")
        both = both.select(F.coalesce("old_id", "new_id").alias("doc_id"), *(F.coalesce(n, F.lit(0)).alias(n) for n in ("old_n", "new_n")), "old_fp", "new_fp")
        schema = T.StructType([both.schema["doc_id"], *T._parse_datatype_string("old_n long, new_n long, done boolean, removed array<long>, added array<long>").fields])
        seen = written(both.mapInArrow(_peeled(cells), schema), "changes")
        differ = F.size("removed") + F.size("added")
        n = F.col("old_n") + F.col("new_n")
        done = seen.where("done").select("doc_id", F.when(n == 0, 1.0).otherwise((n - differ) / (n + differ)).alias("likeness"), "removed", "added", F.lit(cells).alias("cells"))
        out = done if out is None else out.unionByName(done)
        failed, cells = seen.where("not done").select("doc_id"), cells * GROWTH
    return out


# -- the next document --------------------------------------------------------------------------------


def _block(bounds: list, key: Column) -> Column:
    """Number of bounds at or below ``key``, in two steps of some square root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    shape = key_schema()

    def literal(rows: list) -> Column:
        return F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, shape, strict=True))) for r in rows))

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= key))

    coarse = below(literal(bounds[::step]))
    fine = F.array(*(literal(bounds[k : k + step]) for k in range(0, len(bounds), step)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + below(F.element_at(fine, F.greatest(coarse, F.lit(1)))))


def key_schema() -> T.StructType:
    return T._parse_datatype_string("none boolean, id bigint, mark bigint, row bigint")


#: Blocks for each shuffle partition, and sampled keys for each block.
BLOCKS, SAMPLE = 4, 16


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each document with the text of the one that follows by ascending id; the first follows the last.

    Null texts are empty, null ids come last. Rows with the same id stand in the order of their texts' hashes, rows that are the same in
    that of the table. A single row follows itself; no rows give none. Ids are integers.

    Documents are cut into blocks of the order, by bounds from a sample of keys, and each text is shuffled once, to its
    block; the first of a block goes to the block before too. Bounds steer only where rows go: blocks may differ in size, not the result.
    ``docs`` must give its rows in the same order when it is read again, as files do.
    """
    spark = docs.sparkSession
    rows = picked(docs, id="doc_id", text="text").select(F.col("id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row")))
    total = rows.count()
    blocks = min(BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, total // SAMPLE))
    sample = sorted(tuple(r[0]) for r in hashed_sample(rows.select("key"), SAMPLE * blocks, ["key"], total)) if blocks > 1 else []
    step = max(1, len(sample) // blocks)
    rows = rows.withColumn("block", _block(sorted(set(sample[step::step])), F.col("key")))
    # a row for each block
    firsts = sorted(tuple(r) for r in rows.groupBy("block").agg(F.min("key").alias("key")).select("block", "key.none", "key.id", "key.mark").collect())
    guests = [(b, *key, firsts[k - 1][0]) for k, (b, *key) in enumerate(firsts)]
    guests = spark.createDataFrame(guests, "at int, none boolean, id0 bigint, mark bigint, before int")
    heads = (F.col("key.none") == F.col("none")) & (F.col("key.id") == F.col("id0")) & (F.col("key.mark") == F.col("mark"))
    # as many rows as there are blocks
    sent = rows.join(F.broadcast(guests), (F.col("block") == F.col("at")) & heads, "left")
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    sent = sent.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("before").alias("block"), F.lit(True).alias("guest"))))))
    order = Window.partitionBy("to.block").orderBy("to.guest", "key")
    paired = sent.withColumn("next_text", F.lead("text").over(order))
    return paired.where(~F.col("to.guest")).select(F.when(~F.col("key.none"), F.col("key.id")).alias("doc_id"), "text", "next_text")


def _versions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        every = np.arange(batch.num_rows)
        own, edited, following = (Texts(batch[c]) for c in ("own", "edited", "following"))
        prints = [t.sketched(every, CELLS) for t in (own, edited, following)]
        near = []
        for other, sketch in ((edited, prints[1]), (following, prints[2])):
            pair, _, _ = differing(own, other, prints[0].minus(sketch))
            near.append(pa.array(likeness(own.size, other.size, np.bincount(pair, minlength=batch.num_rows))))
        yield pa.RecordBatch.from_arrays(
            [*(batch[n] for n in ("doc_id", "n_chars", "edited_sha256")), pa.array(prints[0].texts()), pa.array(prints[1].texts()), *near],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def edited_versions(docs: DataFrame) -> DataFrame:
    """Each document beside a version whose second half is the beginning of the next document, both fingerprinted and compared.

    Rows as in ``with_next``; lengths are in code points. Empty texts are alike.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited_text", edited)
    rows = rows.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), *(digests(F.col(c)).alias(n) for c, n in (("text", "own"), ("edited_text", "edited"), ("next_text", "following"))))
    return rows.mapInArrow(_versions, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
