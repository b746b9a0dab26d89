"""Mixing sources to target weights, in fixed-length blocks of tokens.

A source is the stream of its documents' tokens, cut into blocks of
``block`` tokens, of a source with few tokens into shorter ones of one length. The mix is a
number of output shards with the same number of slots. Each shard draws how many of its slots go to
each source from a multinomial over what the sources have still to give, so that the draws vary from
shard to shard while the totals meet the targets. A source's slots are numbered through all shards;
slot ``j`` shows block ``perm(j mod n)`` of pass ``j div n``, with a keyed pseudorandom permutation of
the source's ``n`` block numbers for each pass. Slots and blocks are joined by source and number.

The driver holds a few sums and the table of draws among at most ``TEAMS`` teams of sources: a number for
every team and million slots. All that grows with the sources stays in tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .support import picked, place, plain, written

#: 1 for the bytes between words, ``[^\x20\x09-\x0D]+``.
_GAP = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)], np.int8)
WEIGHTS = (3, 1, 2)
#: Size of the mix in all sources' tokens, and the most passes over a source.
SHARE, MOST = 1.5, 2.0
BLOCK = 256
#: Blocks that a source has at least, if it has as many tokens: small sources are cut into shorter blocks.
LEAST_BLOCKS = 100
#: Output shards at least, and slots of a shard at most, about.
SHARDS, SHARD_SLOTS = 256, 1 << 20
#: Teams of sources that shards draw among at the driver.
TEAMS = 64
#: A table of sources up to this size goes to every task; a larger one is joined by source and one of so many salts.
BROADCAST_BYTES, SALTS = 4 << 20, 64
#: Characters of output text that a task holds, about.
OUT_CHARS = 2 << 20


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources(size, weight, ...)`` with ``target``: ``share`` of all sizes by weight, none above ``most`` times its size.

    A source takes ``weight`` times one level common to all, or its limit if that is less. The level rises, round by
    round, to what the sources below their limit have to share: a few numbers at the driver, whatever the sources.
    """
    limit = most * F.col("size")
    first = sources.where("size > 0").agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    level = share * first["size"] / first["weight"] if first["size"] else 0.0
    while level:
        full = limit < level * F.col("weight")
        sums = sources.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        above = (share * first["size"] - sums["full"]) / sums["weight"] if sums["weight"] else level
        if above <= level:
            break
        level = above
    return sources.withColumn("target", F.least(limit, level * F.col("weight")))


def take(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """``n`` of what is left, by multinomial draws until none asks for more than there is; ``left`` is lowered."""
    out = np.zeros(len(left), np.int64)
    while n > 0 and left.sum() > 0:
        c = np.minimum(rng.multinomial(n, left / left.sum()), left)
        out += c
        left -= c
        n -= int(c.sum())
    return out


def draws(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Multinomial counts, a row for each shard; a column adds up to its slots."""
    rng = np.random.Generator(np.random.Philox(seed))
    left = np.array(slots, np.int64)
    return np.array([take(rng, left, int(round(left.sum() / (shards - k)))) for k in range(shards)], np.int64).reshape(shards, len(slots))


def permute(x: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A keyed permutation of ``range(size)`` for each element: a Feistel network that walks until it is back below size."""
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, key = x.astype(np.uint64), key.astype(np.uint64)
    go = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(go):
            h, m = half[go], mask[go]
            left, right = out[go] >> h, out[go] & m
            for r in range(rounds):
                f = (right + key[go] + np.uint64(r * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
            out[go] = (left << h) | right
            go = go[out[go] >= size[go].astype(np.uint64)]
    return out.astype(np.int64)


def begins(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """``rows`` with ``begin``: the sum of ``value`` over the rows of the same group that stand earlier in ``order``.

    Rows are dealt by ranges of group and order, so that a group is spread over as many tasks as its rows ask for. A task
    adds up what it holds, and a table with a row for each task and group shifts its sums.
    """
    names = [*rows.columns, "part", "local"]
    g, v = rows.columns.index(group), rows.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, total = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            own, add = b.column(g).to_numpy(), b.column(v).to_numpy()
            before = np.cumsum(add) - add
            starts = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
            local = before - np.repeat(before[starts], np.diff(np.append(starts, len(own))))
            if own[0] == now:
                local[: starts[1] if len(starts) > 1 else len(own)] += total
            now, total = own[-1], int(local[-1] + add[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(own), pa.int32()), pa.array(local, pa.int64())], names=names)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = written(dealt.mapInArrow(run, f"{kinds}, part int, local bigint"), "places")
    sums = placed.groupBy("part", group).agg(F.sum(value).alias("sum"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = written(sums.select("part", group, F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("shift")), "shifts")
    return placed.join(shift, ["part", group]).withColumn("begin", F.col("shift") + F.col("local")).drop("part", "local", "shift")


def _numbered(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return picked(docs, id=id_col, text=text_col, source=source_col).withColumn("row", F.monotonically_increasing_id())


def _sized(rows: DataFrame) -> DataFrame:
    """``rows(row, id, text, source)`` to (row, id, key, source, size); key is a hash of the others, for their order only."""
    base = rows.select("row", "id", F.col("source").cast("string").alias("source"), "text")
    base = base.select("row", "id", F.xxhash64("id", F.isnull("text"), "text", F.isnull("source"), "source").alias("key"), "source", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # bytes.split() cuts at the six white-space bytes of WORD
            n = [len((t.as_py() or "").encode().split()) for t in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64())], names=["row", "id", "key", "source", "size"])

    return base.mapInArrow(run, f"row bigint, id {base.schema['id'].dataType.simpleString()}, key bigint, source string, size bigint")


def _sources(base: DataFrame, block: int) -> tuple[DataFrame, dict]:
    """A row for each source with its number, weight, target, blocks and slots; and what all of them add up to."""
    found = base.groupBy("source").agg(F.sum("size").alias("size")).select("source", F.isnull("source").alias("last"), "size", F.lit(0).alias("all"), F.lit(1).alias("one"))
    found = begins(found, "all", ["last", "source"], "one").select("source", F.col("begin").alias("sid"), "size")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("sid", F.lit(len(WEIGHTS))) + 1).cast("int"))
    found = targets(found.withColumn("weight", weight), SHARE, MOST)
    found = found.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("size") / LEAST_BLOCKS))).cast("bigint"))
    found = found.withColumn("blocks", F.ceil(F.col("size") / F.col("block")).cast("bigint"))
    slots = F.when(F.col("size") > 0, F.least(F.round(F.col("blocks") * F.col("target") / F.col("size")), int(MOST) * F.col("blocks"))).otherwise(0)
    found = written(found.withColumn("slots", slots.cast("bigint")).withColumn("team", F.pmod("sid", F.lit(TEAMS)).cast("int")), "sources")
    sums = found.agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length("source"), F.lit(0)) + 64).alias("bytes"), F.coalesce(F.sum("slots"), F.lit(0)).alias("slots")).first()
    return found, sums.asDict()


def _drawn(spark: SparkSession, sources: DataFrame, slots: int, shards: int | None, seed: int) -> DataFrame:
    """(shard, sid, slot, done, n, blocks): how many slots of a shard, from which slot on, show which source.

    Shards draw among ``TEAMS`` teams of sources at the driver; a task then draws among each team's own sources.
    """
    teams = [r.asDict() for r in sources.groupBy("team").agg(F.sum("slots").alias("slots")).where("slots > 0").orderBy("team").collect()]  # TEAMS rows at most
    shards = shards or max(SHARDS, -(-slots // SHARD_SLOTS))
    table = draws([t["slots"] for t in teams], shards, seed)
    inner = np.cumsum(table, axis=1) - table
    shard, team = np.nonzero(table)
    names = np.array([t["team"] for t in teams], np.int32)
    plan = pa.table({"shard": pa.array(shard, pa.int32()), "team": pa.array(names[team] if len(names) else team, pa.int32()), "n": pa.array(table[shard, team]), "slot": pa.array(inner[shard, team])})

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        own, ask = left.sort_by("sid"), right.sort_by("shard")
        sid, blocks = own["sid"].to_numpy(), own["blocks"].to_numpy()
        rest, out = own["slots"].to_numpy().copy(), []
        done = np.zeros(len(sid), np.int64)
        rng = np.random.Generator(np.random.Philox(key=[seed, int(left["team"][0].as_py()) + 1 if len(left) else 0]))
        for k, n, slot in zip(ask["shard"].to_pylist(), ask["n"].to_pylist(), ask["slot"].to_pylist(), strict=True):
            c = take(rng, rest, n)
            at = np.flatnonzero(c)
            out.append((np.full(len(at), k), sid[at], slot + (np.cumsum(c) - c)[at], done[at], c[at], blocks[at]))
            done += c
        cols = [np.concatenate([np.empty(0, np.int64), *(o[j] for o in out)]) for j in range(6)]
        return pa.table(dict(zip(("shard", "sid", "slot", "done", "n", "blocks"), (pa.array(x, pa.int32() if not j else pa.int64()) for j, x in enumerate(cols)), strict=True)))

    asked = spark.createDataFrame(plan)
    return sources.select("team", "sid", "slots", "blocks").where("slots > 0").groupBy("team").cogroup(asked.groupBy("team")).applyInArrow(deal, "shard int, sid bigint, slot bigint, done bigint, n bigint, blocks bigint")


def _mix(rows: DataFrame, block: int, shards: int | None, seed: int) -> tuple[DataFrame, DataFrame]:
    spark = rows.sparkSession
    base = written(_sized(rows), "sizes")
    sources, sums = _sources(base, block)
    facts = sources.select(F.col("source").alias("name"), "sid", F.col("size").alias("source_size"), "target", "block")
    if sums["bytes"] is not None and sums["bytes"] <= BROADCAST_BYTES:
        keyed = base.join(F.broadcast(facts), base["source"].eqNullSafe(facts["name"]))
    else:  # too many sources to send to every task; a source with many rows is dealt to SALTS parts
        left = base.withColumn("salt", F.pmod("key", F.lit(SALTS)))
        right = facts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keyed = left.join(right, left["source"].eqNullSafe(right["name"]) & (left["salt"] == right["part"])).drop("salt", "part")
    placed = begins(keyed.drop("name"), "sid", ["key", "row"], "size")

    first, last = F.floor(F.col("begin") / F.col("block")), F.floor((F.col("begin") + F.col("size") - 1) / F.col("block"))
    parts = placed.where("size > 0").select("sid", "row", "begin", "size", "block", F.explode(F.sequence(first, last)).alias("index"))
    start = F.greatest("begin", F.col("index") * F.col("block"))
    stop = F.least(F.col("begin") + F.col("size"), (F.col("index") + 1) * F.col("block"))
    parts = parts.select("sid", "index", "row", "size", (start - F.col("begin")).alias("from"), (stop - start).alias("words"))

    spans = _drawn(spark, sources, sums["slots"], shards, seed)
    tasks = max(spark.sparkContext.defaultParallelism, sums["slots"] // SHARD_SLOTS)
    drawn = spans.repartition(tasks).withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    drawn = drawn.select("shard", (F.col("slot") + F.col("k")).alias("slot"), "sid", "blocks", (F.col("done") + F.col("k")).alias("j"))

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, size, j = (b.column(c).to_numpy().astype(np.int64) for c in (2, 3, 4))
            turn = j // size
            key = (sid * 1_000_003 + turn) * 7_919 + seed
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(turn), pa.array(permute(j % size, size, key))], names=["shard", "slot", "sid", "pass", "index"])

    shown_slots = drawn.mapInArrow(shown, "shard int, slot bigint, sid bigint, pass bigint, index bigint")
    # Slots grow with the corpus, whatever the size of the plan they are made from: never broadcast.
    pieces = shown_slots.hint("merge").join(parts, ["sid", "index"]).select("row", "sid", "shard", "slot", "pass", "from", "words", "size")
    return placed.select("row", "id", "sid", "source", "size", "source_size", "target"), pieces


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int | None = None, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """``(documents, pieces)`` of the mix.

    documents: (row, id, sid, source, size, source_size, target), one row for each row of ``docs``; row is a
    number of its own, so that repeated rows stay apart.
    pieces: (row, sid, shard, slot, pass, from, words, size): one for each document within each drawn block;
    ``from`` counts the document's words before it, ``size`` all of its words.

    Sources sort by code point, null last as a source of its own, with the weights 3, 1, 2 in turn.
    Null and wordless texts have size 0 and give no piece; a source without words has target 0.
    Null ids are values like any other. A document's place in its source's stream comes from a hash of its id, text
    and source; of rows equal in all of these it can't be told, and doesn't matter, which comes first. Reruns agree.
    Long texts span as many blocks as they need. Extra columns are ignored. No rows: empty tables.
    """
    return _mix(_numbered(docs, id_col, text_col, source_col), block, shards, seed)


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int | None = None, seed: int = 20) -> DataFrame:
    """(id_col, size, source_size, target, taken) for each row: the words that the mix takes of it, repeats counted.

    What holds for nulls, empty and long texts, ties, repeated rows, no rows and extra columns is said at ``mix``.
    """
    rows, pieces = mix(docs, id_col, text_col, source_col, block, shards, seed)
    sums = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    out = rows.join(sums, "row", "left")
    return out.select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")).toDF(id_col, "size", "source_size", "target", "taken")


def word_edges(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in UTF-8 bytes."""
    gap = _GAP[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(gap, prepend=np.int8(1), append=np.int8(1)))
    return edges[::2], edges[1::2]


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shards: int | None = None, seed: int = 20) -> DataFrame:
    """The mix as documents, with all columns of ``docs``: a row for each document and pass that takes words of it.

    A document taken whole keeps its text; of others the text has the taken stretches in their order, each
    as it stands in the document, with a line break between. All other columns are those of the document's own row,
    repeated rows included, whatever the columns are called. Documents that the mix takes nothing of, null and
    wordless ones among them, don't appear. No rows: no rows.
    """
    columns = docs.columns
    at_text = int(place(docs, text_col)[1:])
    kept = written(plain(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    _, pieces = _mix(kept.select("row", *(F.col(place(docs, c)).alias(own) for own, c in (("id", id_col), ("text", text_col), ("source", source_col)))), block, shards, seed)
    # bounded by a document's length and the passes over it
    by_row = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pass", "from", "words"))).alias("parts"), F.first("size").alias("size"))
    # Texts are shuffled once and stream past a table of their pieces; nothing sorts them.
    joined = kept.join(by_row.hint("shuffle_hash"), "row").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists, sizes = b.column(at_text), b.column(len(columns)), b.column(len(columns) + 1)
            at: list[int] = []
            out: list[str] = []
            held = 0

            def flush() -> pa.RecordBatch:
                cols = [c.take(pa.array(at, pa.int64())) if i != at_text else pa.array(out, b.schema.field(at_text).type) for i, c in enumerate(b.columns[: len(columns)])]
                return pa.RecordBatch.from_arrays(cols, names=b.schema.names[: len(columns)])

            for i in range(b.num_rows):
                text, size, edges = texts[i].as_py(), sizes[i].as_py(), None
                for _, own in groupby(lists[i].as_py(), key=lambda p: p["pass"]):
                    stretches: list[list[int]] = []
                    for p in own:
                        if stretches and stretches[-1][1] == p["from"]:
                            stretches[-1][1] += p["words"]
                        else:
                            stretches.append([p["from"], p["from"] + p["words"]])
                    if stretches != [[0, size]]:
                        if edges is None:
                            raw = text.encode()
                            edges = word_edges(raw)
                        part = b"\n".join(raw[edges[0][s] : edges[1][e - 1]] for s, e in stretches).decode()
                    else:
                        part = text
                    at.append(i)
                    out.append(part)
                    held += len(part)
                    if held >= OUT_CHARS:
                        yield flush()
                        at, out, held = [], [], 0
            yield flush()

    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return joined.mapInArrow(run, schema).toDF(*columns)
