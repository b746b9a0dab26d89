"""Language identification by a byte convolutional network, trained and applied in numpy.

Bytes are embedded; filters of widths 2 to 5 slide over fixed-length windows of a text's UTF-8 bytes;
each filter's maximum over the window feeds a softmax layer. All widths are one matrix product:
narrower filters are zero in the columns beyond their width. A text's score is the softmax of its
windows' mean log-probabilities; the windows cover all of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .support import picked, place, plain

WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBED = 6
WINDOW = 256
UNKNOWN = "und"
#: Bound of the training sample: labelled rows of each language.
SAMPLE_ROWS = 500
#: Windows that go through the network together.
BATCH = 48

_WORDLY = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Numbers that are no decimal digits, such as fractions, match the pattern too and are no letters."""
    return any(m.group().isalpha() for m in _WORDLY.finditer(text))


def _columns(width: int = max(WIDTHS)) -> np.ndarray:
    """1 where a filter may look: (width * EMBED, filters)."""
    seen = np.zeros((width, EMBED, len(WIDTHS) * FILTERS), np.float32)
    for k, w in enumerate(WIDTHS):
        seen[:w, :, k * FILTERS : (k + 1) * FILTERS] = 1
    return seen.reshape(width * EMBED, -1)


@dataclass
class ByteCnn:
    languages: list[str]
    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray
    seen: np.ndarray = field(default_factory=_columns)

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteCnn:
        seen = _columns()
        n = seen.shape[1]
        kernel = (rng.normal(0, 0.3, seen.shape) * seen).astype(np.float32)
        return cls(languages, rng.normal(0, 1, (256, EMBED)).astype(np.float32), kernel, np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        width = max(WIDTHS)
        e = self.embed[windows]
        n, length, d = e.shape
        flat = np.ascontiguousarray(e).reshape(n, length * d)
        return np.lib.stride_tricks.as_strided(flat, (n, length - width + 1, width * d), (flat.strides[0], d * 4, 4))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self._patches(windows)
        return p, p.reshape(-1, p.shape[2]) @ self.kernel

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        p, z = self.pooled(windows)
        top = z.reshape(p.shape[0], p.shape[1], -1).max(axis=1) + self.bias
        y = np.maximum(top, 0) @ self.dense + self.offset
        y = y - y.max(axis=1, keepdims=True)
        return y - np.log(np.exp(y).sum(axis=1, keepdims=True))

    def train(self, windows: np.ndarray, labels: np.ndarray, rng: np.random.Generator, epochs: int = 12, rate: float = 0.01) -> None:
        """Adam on the cross entropy; the maximum passes its gradient to one place a filter."""
        names = ("embed", "kernel", "bias", "dense", "offset")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(windows))
            for s in range(0, len(order), 64):
                rows = order[s : s + 64]
                x, y = windows[rows], labels[rows]
                p, z = self.pooled(x)
                z = z.reshape(p.shape[0], p.shape[1], -1)
                place = z.argmax(axis=1)
                top = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0] + self.bias
                act = np.maximum(top, 0)
                out = act @ self.dense + self.offset
                out = np.exp(out - out.max(axis=1, keepdims=True))
                out /= out.sum(axis=1, keepdims=True)
                out[np.arange(len(y)), y] -= 1
                out /= len(y)
                g_top = (out @ self.dense.T) * (top > 0)
                picked = p[np.arange(len(y))[:, None], place]  # (rows, filters, patch)
                grads = {"dense": act.T @ out, "offset": out.sum(axis=0), "bias": g_top.sum(axis=0), "kernel": np.einsum("bf,bfk->kf", g_top, picked) * self.seen}
                g_patch = (g_top[:, :, None] * self.kernel.T[None]).reshape(len(y), -1, max(WIDTHS), EMBED)
                g_embed = np.zeros_like(self.embed)
                for k in range(max(WIDTHS)):
                    np.add.at(g_embed, x[np.arange(len(y))[:, None], place + k], g_patch[:, :, k])
                grads["embed"] = g_embed
                step += 1
                lr = rate * (1 - 0.9 * epoch / epochs)
                for k in names:
                    g = grads[k].astype(np.float32)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    getattr(self, k)[...] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)


def windows_of(raw: bytes, size: int = WINDOW) -> np.ndarray:
    """Consecutive windows that cover the bytes; a short end is the text's last ``size`` bytes, a short text is padded with spaces."""
    n = len(raw)
    if n <= size:
        return np.frombuffer(raw.ljust(size), np.uint8)[None]
    body = np.frombuffer(raw, np.uint8)
    whole = body[: n - n % size].reshape(-1, size)
    return whole if n % size == 0 else np.concatenate([whole, body[None, -size:]])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = SAMPLE_ROWS, windows: int = 4, seed: int = 2) -> ByteCnn | None:
    """Train on a sample of labelled rows, bounded by ``rows`` for each language; None without labelled rows.

    Every language that occurs is learned. A row gives up to ``windows`` windows from hashed places of its whole text.
    """
    known = picked(docs, id=id_col, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    # a share of each language's rows by a hash: half as many again as wanted, cut to the bound before they meet
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    mark = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    spots = [F.substring("text", (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1))) + 1).cast("int"), WINDOW) for k in range(windows)]
    marked = known.withColumn("mark", mark).join(F.broadcast(counts), "lang").where(F.col("mark") < F.lit(1.5 * rows) / F.col("n"))  # a row for each class of the model
    marked = marked.select(F.col("lang").cast("string").alias("lang"), "mark", F.array(*spots).alias("parts"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "parts"))
    found = marked.withColumn("place", first).where(F.col("place") <= rows).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["mark"], r["lang"], r["parts"]))
    languages = sorted({r["lang"] for r in found})
    number = {name: k for k, name in enumerate(languages)}
    x, y = [], []
    for r in found:
        for part in dict.fromkeys(r["parts"]):
            if has_letter(part):
                x.append(windows_of(part.encode())[0])
                y.append(number[r["lang"]])
    rng = np.random.default_rng(seed)
    model = ByteCnn.fresh(languages, rng)
    if len(languages) > 1 and x:
        model.train(np.stack(x), np.array(y), rng)
    return model


def _judged(docs: DataFrame, model: ByteCnn | None, columns: list[str], text_col: str) -> DataFrame:
    """Some columns of ``docs`` as c0, c1, ..., then lang and score."""
    own = plain(docs)
    base = own.select(*(F.col(place(docs, c)).alias(f"c{i}") for i, c in enumerate(columns)), F.col(place(docs, text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = classify((t.as_py() for t in b.column(b.num_columns - 1)), model)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "lang", "score"])

    return base.mapInArrow(run, "".join(f"c{i} {base.schema[i].dataType.simpleString()}, " for i in range(len(columns))) + "lang string, score double")


def predict(docs: DataFrame, model: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for each row.

    Null texts and texts without a letter, and all texts without a model, are ``und`` with score 0. Of equal
    probabilities the language first by code point wins. Long texts are read whole, repeated rows and null ids stay,
    extra columns are ignored. No rows: no rows.
    """
    return _judged(docs, model, [id_col], text_col).toDF(id_col, "lang_pred", "score")


def accepted(docs: DataFrame, model: ByteCnn | None, least: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` in a learned language, named by ``lang_col`` from now on.

    Of ``k`` languages a score is 1 / k at least; a row stays if its score is the share ``least`` of the way from there to
    one, or more. All other columns stay as they are, whatever they are called; scores are those of ``predict``.
    """
    chance = 1 / len(model.languages) if model else 1.0
    found = _judged(docs, model, docs.columns, text_col).where((F.col("lang") != UNKNOWN) & (F.col("score") >= chance + least * (1 - chance)))
    at = int(place(docs, lang_col)[1:])
    return found.select(*(F.col("lang" if i == at else f"c{i}") for i in range(len(docs.columns)))).toDF(*docs.columns)


def classify(texts, model: ByteCnn | None) -> tuple[list[str], list[float]]:
    langs, scores = [], []
    held: list[np.ndarray] = []
    owner: list[int] = []
    sums: list[np.ndarray | None] = []
    count: list[int] = []

    for i, text in enumerate(texts):
        sums.append(None)
        count.append(0)
        if text is not None and model is not None and has_letter(text):
            w = windows_of(text.encode())
            count[i] = len(w)
            for k in range(0, len(w), BATCH):
                held.append(w[k : k + BATCH])
                owner.append(i)
                if sum(map(len, held)) >= BATCH:
                    _drain(held, owner, sums, model)
    _drain(held, owner, sums, model)
    for s, n in zip(sums, count, strict=True):
        if s is None:
            langs.append(UNKNOWN)
            scores.append(0.0)
        else:
            p = np.exp(s / n - (s / n).max())
            p /= p.sum()
            langs.append(model.languages[int(p.argmax())])
            scores.append(float(p.max()))
    return langs, scores


def _drain(held: list[np.ndarray], owner: list[int], sums: list, model: ByteCnn | None) -> None:
    """Run what is held through the network, adding each text's log-probabilities up."""
    if not held:
        return
    lp = model.log_probabilities(np.concatenate(held))
    begin = np.concatenate(([0], np.cumsum([len(h) for h in held])[:-1]))
    for i, part in zip(owner, np.add.reduceat(lp, begin, axis=0), strict=True):
        sums[i] = part if sums[i] is None else sums[i] + part
    held.clear()
    owner.clear()
