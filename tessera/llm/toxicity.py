"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lowers case, maps homoglyphs and compatibility forms to plain letters, drops loose marks, undoes digit and sign
substitutions inside words, and turns everything else into spaces. The lexicon is learned from
labelled rows: whole words and word beginnings are candidates. A candidate must be met in toxic rows so much oftener
than in clean ones that chance would not bring forth a single such one among all candidates; the rows that the entries
chosen before it explain don't count again. Log-odds are the weights. Two-word phrases around an entry that are met in
clean rows alone, too often for chance, are exceptions: a match inside one doesn't count. The summed
weight is normalised by the text's length, and a logistic curve fitted on the same rows turns it
into a score.

Words are counted where the texts are. The driver gets a fingerprint and a density for each row of the bounded
sample, the candidates that pass the test, and where these occur in toxic rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .simhash import fingerprints_of
from .support import hashed_sample, picked, written

#: Bounds of the training sample: rows of each label, in the order of a hash of their id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
#: Lengths of word beginnings that can become entries.
STEM = (3, 10)
#: Chance that any candidate, or any exception, passes its test without meaning anything.
CHANCE = 0.05
#: Added to the number of words before the weights' sum is divided by it.
SMOOTH = 30

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "η": "n", "ω": "w",
}
#: Digits and signs written for letters.
SUBSTITUTES = str.maketrans("0134578@$!|", "oieastbasil")

_SIGN = r"[0134578@$!|]"
_INSIDE = re.compile(rf"(?<=[^\W\d_]){_SIGN}{{1,2}}(?=[^\W\d_])|(?<![^\s]){_SIGN}(?=[^\W\d_]{{2}})")
_LEFT = re.compile(r"[0-9@$!|]")


class _Folding(dict):
    """One folded string for each code point, filled as they occur."""

    def __missing__(self, point: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFKC", chr(point)).casefold():
            c = HOMOGLYPHS.get(c, c)
            if c.isalpha() or c in "0123456789@$!|":
                out += c
            elif not unicodedata.combining(c):
                out += " "
        self[point] = out
        return out


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """Folded text: letters and spaces only, a space at either end."""
    s = (text or "").translate(_FOLDING)
    if _LEFT.search(s):
        s = _LEFT.sub(" ", _INSIDE.sub(lambda m: m.group().translate(SUBSTITUTES), s))
    return f" {s} "


@dataclass(frozen=True)
class Lexicon:
    """entries: pattern (a leading space: a word's beginning; one at the end too: a whole word) to weight."""

    entries: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float
    offset: float

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for p, w in self.entries.items():
            a.add_word(p, (len(p), w))
        for p in self.exceptions:
            a.add_word(p, (len(p), a.get(p)[1] if p in a else None))
        a.make_automaton()
        return a


def density(folded: str, automaton: ahocorasick.Automaton | None, protected: bool) -> tuple[float, int]:
    """(weights' sum over smoothed length in hundreds of words, counted matches)."""
    if automaton is None:
        return 0.0, 0
    found = [(end - size + 1, end, w) for end, (size, w) in automaton.iter(folded)]
    if protected and found:
        cover: list[tuple[int, int]] = []  # exceptions by start, each reaching further than those before it
        for s, e in sorted((s, e) for s, e, w in found if w is None):
            if not cover or e > cover[-1][1]:
                cover.append((s, e))
        starts = [s for s, _ in cover]
        found = [x for x in found if x[2] is not None and not ((k := bisect_right(starts, x[0])) and cover[k - 1][1] >= x[1])]
    if not found:
        return 0.0, 0
    best: dict[int, float] = {}  # one match for each word: the weightiest of those that begin at its space
    for s, _, w in found:
        best[s] = max(w, best.get(s, w))
    return 100 * sum(best.values()) / (len(folded.split()) + SMOOTH), len(best)


def _unlike(fp: np.ndarray, bits: int = 6) -> np.ndarray:
    """Rows without near copies among earlier ones; a copy's every rare word would look telling."""
    keep: list[int] = []
    seen = np.empty(len(fp), np.uint64)
    for i, x in enumerate(fp):
        if not (np.bitwise_count(seen[: len(keep)] ^ x) <= bits).any():
            seen[len(keep)] = x
            keep.append(i)
    return np.array(keep, np.int64)


def _candidates(words: Iterable[str]) -> set[str]:
    out = {f" {w} " for w in words}
    for w in words:
        out.update(f" {w[:k]}" for k in range(STEM[0], min(STEM[1], len(w)) + 1))
    return out


def surprise(bad: np.ndarray, good: np.ndarray, rate: float) -> np.ndarray:
    """Logarithm of one over the chance (Chernoff's bound) that so many of the rows or more are toxic, at a toxic share ``rate``."""
    n = np.maximum(bad + good, 1)
    f = bad / n
    with np.errstate(divide="ignore", invalid="ignore"):
        each = np.where(f > 0, f * np.log(f / rate), 0) + np.where(f < 1, (1 - f) * np.log((1 - f) / (1 - rate)), 0)
    return np.where(f > rate, n * each, 0.0)


def least_surprise(rows: dict[int, int], rate: float) -> float:
    """What a candidate must exceed, given how many candidates are met in how many rows: those in so few rows that they
    could never pass are not counted as tried."""
    tried, level = 0, math.inf
    for n in sorted(rows, reverse=True):
        tried += rows[n]
        if -n * math.log(rate) < math.log(tried / CHANCE):
            break
        level = math.log(tried / CHANCE)
    return level


def cover(counts: dict[str, tuple[int, int]], pairs: dict[str, set[tuple[int, str]]], bad: int, good: int, least: float) -> dict[str, float]:
    """Entries and weights, chosen one after the other, the most telling first, among rows and words not explained yet."""
    rate = bad / (bad + good)
    weight = {c: math.log((a + 0.5) / (bad + 1)) - math.log((b + 0.5) / (good + 1)) for c, (a, b) in counts.items()}
    left = {c: set(p) for c, p in pairs.items()}
    entries: dict[str, float] = {}
    while left:
        news = {c: len({i for i, _ in p}) for c, p in left.items()}
        names = list(left)
        sure = surprise(np.array([news[c] for c in names], float), np.array([counts[c][1] for c in names], float), rate)
        # of equal ones the whole word, then the longer beginning: what is sure to be meant
        k = max(range(len(names)), key=lambda k: (round(float(sure[k]), 9), names[k].endswith(" "), len(names[k]), names[k]))
        if sure[k] <= least:
            break
        c = names[k]
        entries[c] = weight[c]
        new = left.pop(c)
        left = {x: p - new for x, p in left.items()}
    return entries


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a ridge that keeps separable data finite."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + ridge * a, (p - y).sum() + ridge * b])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + ridge]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _counts(sample: DataFrame, features, names: str) -> DataFrame:
    """(name, bad, good): in how many toxic and clean rows each feature of ``sample(toxic, text)`` is met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                b = whole.slice(k, 64)
                sides = (Counter(), Counter())
                for y, t in zip(b.column(0), b.column(1), strict=True):
                    sides[y.as_py()].update(features(fold(t.as_py())))
                found = list(sides[0].keys() | sides[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([sides[1][x] for x in found], pa.int64()), pa.array([sides[0][x] for x in found], pa.int64())], names=["name", "bad", "good"])

    return written(sample.select("toxic", "text").mapInArrow(run, "name string, bad bigint, good bigint").groupBy("name").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), names)


def learn(sample: DataFrame, bad: int, good: int) -> Lexicon:
    """A lexicon from ``sample(n, toxic, text)``, which has so many toxic and clean rows. Without both labels: no entries, and the base rate as every score."""
    rate = (bad + 1) / (bad + good + 2)
    flat = Lexicon({}, (), 0.0, math.log(rate / (1 - rate)))
    if not bad or not good:
        return flat
    rate = bad / (bad + good)
    met = _counts(sample, lambda f: _candidates(set(f.split())), "met")
    rows = {r["m"]: r["n"] for r in met.groupBy((F.col("bad") + F.col("good")).alias("m")).agg(F.count("*").alias("n")).collect()}  # a row for each number of sampled rows
    least = least_surprise(rows, rate)
    if math.isinf(least):
        return flat
    m, f = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    sure = F.when(f >= 1, -m * math.log(rate)).when(f > rate, m * (f * F.log(f / rate) + (1 - f) * F.log((1 - f) / (1 - rate)))).otherwise(0.0)
    # by the test, one candidate more than there should be in twenty samples; those that mean something are a language's insults
    counts = {r["name"]: (r["bad"], r["good"]) for r in met.where(sure > least).collect()}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, t in zip(b.column(0), b.column(1), strict=True):
                own = [(n.as_py(), w, c) for w in set(fold(t.as_py()).split()) for c in _candidates((w,)) if c in counts]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], t) for k, t in enumerate((pa.int32(), pa.string(), pa.string()))], names=["n", "word", "name"])

    where: dict[str, set[tuple[int, str]]] = {c: set() for c in counts}
    for r in sample.where("toxic = 1").select("n", "text").mapInArrow(pairs, "n int, word string, name string").collect():
        where[r["name"]].add((r["n"], r["word"]))
    entries = cover(counts, where, bad, good, least)
    stems = tuple(x for x in entries if not x.endswith(" "))
    whole = {x.strip() for x in entries if x.endswith(" ")}

    def phrases(folded: str) -> set[str]:
        w = folded.split()
        own: set[str] = set()
        for i, x in enumerate(w):
            if x in whole or (stems and f" {x}".startswith(stems)):
                own.update(f" {' '.join(w[k : k + 2])} " for k in (i - 1, i) if 0 <= k < len(w) - 1)
        return own

    # Of a phrase without meaning of its own, as many rows are toxic as of the entries' rows on the whole.
    around = _counts(sample, phrases, "around")
    sums = around.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("n")).first()
    clean = ((sums["good"] or 0) + 0.5) / ((sums["bad"] or 0) + (sums["good"] or 0) + 1)
    often = math.log(max(sums["n"], 1) / CHANCE) / -math.log(clean)
    exceptions = tuple(sorted(r["name"] for r in around.where((F.col("bad") == 0) & (F.col("good") > often)).collect()))
    rough = Lexicon(entries, exceptions, 1.0, 0.0)
    dense = _scored(sample.select("toxic", "text"), rough).select(F.col("id").alias("toxic"), "density").collect()  # a number for each sampled row
    slope, offset = _logistic(np.log1p([r["density"] for r in dense]), np.array([r["toxic"] for r in dense], float))
    return Lexicon(entries, exceptions, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic_rows: int = SAMPLE_TOXIC, clean_rows: int = SAMPLE_CLEAN) -> Lexicon:
    """Learn from a sample of labelled rows, bounded for each label; the whole texts of the sampled rows are read.

    Labels other than 0 and 1 and null ids don't count; an id with both labels counts as toxic. Of documents with the
    same id the sample has as many as it has room for. No labels: the base rate of one half as every score.
    """
    known = picked(labels, id=id_col, toxic=label_col).where("id is not null").select("id", F.col("toxic").cast("int").alias("toxic"))
    known = written(known.where("toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic")), "labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = [r for y, n in ((1, toxic_rows), (0, clean_rows)) for r in hashed_sample(known.where(F.col("toxic") == y), n, ["id"], totals.get(y, 0))]
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["id"], r["toxic"]) for r in chosen], known.schema) if chosen else known.limit(0)
    # toxic_rows + clean_rows ids at most, a proven bound; texts stay in a table
    rows = picked(docs, id=id_col, text=text_col).join(F.broadcast(wanted), "id").withColumn("row", F.monotonically_increasing_id())
    sample = written(rows.select("row", "toxic", "text"), "sample")

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fingerprints_of(b.column(2).to_pylist()).view(np.int64))], names=["row", "toxic", "fp"])

    marked = sample.mapInArrow(prints, "row bigint, toxic int, fp bigint").orderBy("fp", "toxic", "row").limit(2 * (toxic_rows + clean_rows)).collect()
    once = _unlike(np.array([r["fp"] for r in marked], np.int64).view(np.uint64)) if marked else []
    kept = [(int(marked[i]["row"]), k, int(marked[i]["toxic"])) for k, i in enumerate(once)]
    bad = sum(y for _, _, y in kept)
    if not kept:
        return Lexicon({}, (), 0.0, 0.0)
    numbers = spark.createDataFrame([x[:2] for x in kept], "row bigint, n int")
    return learn(written(sample.join(F.broadcast(numbers), "row").select("n", "toxic", "text"), "sample"), bad, len(kept) - bad)


def _scored(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(first column, text) to (id, density, score, matches)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton() if lexicon.entries else None
        protected = bool(lexicon.exceptions)
        for b in batches:
            out = [density(fold(t.as_py()), automaton, protected) for t in b.column(1)]
            d = np.array([d for d, _ in out], float)
            p = 1 / (1 + np.exp(-np.clip(lexicon.slope * np.log1p(d) + lexicon.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(d), pa.array(p), pa.array([n for _, n in out], pa.int64())], names=["id", "density", "score", "matches"])

    return texts.mapInArrow(run, f"id {texts.schema[0].dataType.simpleString()}, density double, score double, matches bigint")


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, matches) for each row; null and empty texts get the score of no match.

    Long texts are read whole, null ids and repeated rows stay, extra columns are ignored. No rows: no rows.
    """
    return _scored(picked(docs, id=id_col, text=text_col), lexicon).select("id", "score", "matches").toDF(id_col, "score", "matches")
