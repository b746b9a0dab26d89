"""Secret scans whose false positives a random forest removes.

Candidates come from patterns: values assigned to credential-like names, tokens with a known prefix,
key blocks, and any run of 16 letters, digits and joining signs or more, each to the end of its run of characters,
however long. Each is described by its length, the mean log-probability of its character transitions under a model of
words and one of random keys, its share covered by dictionary words, its classes of characters, its path, and the words
before it. A forest of shallow trees, grown in numpy on labelled findings, gives the share of trees that call it a
secret. The rest, long words, numbers, paths and placeholders, are the false positives that it removes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import hashed_sample, place, plain

TREES, DEPTH = 40, 8
#: Bound of the labelled findings that the forest is grown on.
SAMPLE_FINDINGS = 20_000
THRESHOLD = 0.5
MASK = "[SECRET]"

# Parts of names that credentials are assigned to.
NAMES = ("token", "secret", "passw", "pwd", "api_key", "apikey", "api-key", "access_key", "access-key", "auth", "credential", "private_key")
# Prefixes of issued tokens, with the least length of what follows.
PREFIXES = {"AKIA": 16, "ASIA": 16, "ghp_": 30, "gho_": 30, "ghs_": 30, "glpat-": 20, "sk_live_": 20, "xoxb-": 20, "xoxp-": 20, "AIza": 30, "npm_": 30, "eyJ": 30}
# Words for the dictionary coverage, common ones and those of placeholders.
DICTIONARY = frozenset(
    """about access account admin after again all and any api application are auth base before build button cache call change changeme
    check class client code column commit config content context count create current data database date default delete demo development
    document dummy else enter error event example fake field file filter first foo for format from function get group hash have header
    hello here home host html http https image import index info input insert instance item key kind label lang last length level line
    link list local log login main manager map message method mock model module more must my name new next node none not null number
    object only open option order page param parameter parse pass password path place placeholder please point port print private process
    production project public query random read record redacted release remove replace request required reset response result return root
    row sample save schema search secret select server service session set setting simple size some sort source spec start state status
    store string style system table target temp template test text that the this time title todo token tool true type undefined update
    upload url use user username value variable version view wait was web when width window with word work world write xxx you your""".split()
)
# Words near a candidate or in its path that speak for or against a secret.
NEAR_FOR = frozenset(("token", "secret", "password", "passwd", "pwd", "apikey", "key", "credential", "credentials", "bearer", "authorization", "auth", "private", "access", "api", "login"))
NEAR_AGAINST = frozenset(("example", "sample", "dummy", "placeholder", "fake", "commit", "sha", "sha1", "sha256", "md5", "checksum", "hash", "digest", "uuid", "guid", "integrity", "revision", "version", "id", "etag"))
PATH_AGAINST = ("test", "example", "sample", "doc", "mock", "fixture", "spec", "lock", "vendor", "readme", "demo")
PATH_FOR = ("config", ".env", "secret", "deploy", "settings", "credential", "prod")

_LEAD = re.compile(r"[\w.\-]*[\"'\]]{0,2}\s{0,4}(?::=|=>|==?|:)\s{0,4}(?:(?:bearer|basic|token)\s{1,4})?", re.I)
_QUOTED = {q: re.compile(rf"{q}((?:\\.|[^{q}\\\n]){{6,}}){q}") for q in "\"'`"}
_BARE = re.compile(r"[^\s\"'`<>|]{6,}")
_IN_URL = re.compile(r"(?<=://)[^\s:/@\"'<>]*:([^\s@\"'<>]{3,})@")
_RUN = re.compile(r"[\w.\-]*")
_PREFIXED = re.compile("(?<![A-Za-z0-9])(?:" + "|".join(f"{re.escape(p)}[A-Za-z0-9_\\-]{{{n},}}" for p, n in PREFIXES.items()) + ")")
_BEGIN, _END = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}-----"), re.compile(r"-----END [A-Z0-9 ]{0,40}-----")
#: A line of a key block: encoded bytes, a header, or nothing.
_KEY_LINE = re.compile(r"[ \t]*(?:[A-Za-z0-9+/=]+|[A-Za-z][A-Za-z0-9\-]*:[^\n]*)?[ \t\r]*(?:\n|\Z)")
_MIXED = re.compile(r"[A-Za-z0-9+/_=\-]{16,}")
_WORD = re.compile(r"[^\W_]+")
_NAMED = re.compile("|".join(map(re.escape, NAMES)), re.I)


def _blocks(text: str) -> list[tuple[int, int, str]]:
    """Key blocks: from a BEGIN line to its END line, or over all lines that look like a key's if it is cut off."""
    found, at = [], 0
    while m := _BEGIN.search(text, at):
        at = m.end()
        if "PRIVATE KEY" not in m.group():
            continue
        end, following = _END.search(text, at), _BEGIN.search(text, at)
        if end and not (following and following.start() < end.start()):
            at = end.end()
        else:
            stop = following.start() if following else len(text)
            while at < stop and (line := _KEY_LINE.match(text, at)) and line.end() > at:
                at = min(line.end(), stop)
        if text[m.end() : at].strip():  # a BEGIN line alone is none
            found.append((m.start(), m.start() + len(text[m.start() : at].rstrip()), "block"))
    return found


def _value(text: str, at: int) -> tuple[int, int] | None:
    """The span of the value that begins at ``at``: to the closing quote of a quoted one, else to the end of its run of characters."""
    quote = text[at : at + 1]
    if quote in _QUOTED:
        if m := _QUOTED[quote].match(text, at):
            return m.span(1)
        at += 1
    m = _BARE.match(text, at)
    if not m:
        return None
    value = m.group().rstrip(",;.:)]}")  # what ends a list or a sentence isn't the value's
    return (at, at + len(value)) if len(value) >= 6 else None


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), in order, without overlaps; of overlapping ones the earlier kind in the list below stays."""
    found: list[tuple[int, int, str]] = []
    if "-----BEGIN" in text:
        found += _blocks(text)
    if "://" in text:
        found += [(*m.span(1), "assigned") for m in _IN_URL.finditer(text)]
    found += [(*m.span(), "prefix") for m in _PREFIXED.finditer(text)] if any(p in text for p in PREFIXES) else []
    at = 0
    while m := _NAMED.search(text, at):  # what follows a name, to the end of its run of characters if nothing is assigned
        lead = _LEAD.match(text, m.end())
        hit = lead and _value(text, lead.end())
        if hit:
            found.append((*hit, "assigned"))
        at = hit[1] if hit else _RUN.match(text, m.end()).end()
    found += [(*m.span(), "mixed") for m in _MIXED.finditer(text)]
    kept: list[tuple[int, int, str]] = []
    rank = {"block": 0, "prefix": 1, "assigned": 2, "mixed": 3}
    for kind in rank:  # a kind's own candidates don't overlap, so one sweep beside those kept settles it
        own, k = [], 0
        for s, e in sorted((s, e) for s, e, x in found if x == kind):
            while k < len(kept) and kept[k][1] <= s:
                k += 1
            if (k == len(kept) or kept[k][0] >= e) and (not own or own[-1][1] <= s):
                own.append((s, e, kind))
        kept = sorted(kept + own)
    return kept


_CLASS = {c: 0 for c in "abcdefghijklmnopqrstuvwxyz"} | {c: 1 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: 2 for c in "0123456789"} | {c: 3 for c in "_-./+="}


def _symbols(value: str) -> list[int]:
    """Letters by themselves whatever their case, digits together, other signs in two groups."""
    out = []
    for c in value:
        k = _CLASS.get(c, 4)
        out.append(ord(c.lower()) - 97 if k < 2 else 26 + k - 2 if k < 4 else 28)
    return out


def coverage(value: str) -> float:
    """Share of the letters and digits that dictionary words of three letters or more cover, longest first."""
    s = "".join(c for c in value.lower() if c.isalnum())
    i = done = 0
    while i < len(s):
        for n in range(min(12, len(s) - i), 2, -1):
            if s[i : i + n] in DICTIONARY:
                done += n
                i += n
                break
        else:
            i += 1
    return done / len(s) if s else 0.0


FEATURES = ("length", "words", "keys", "coverage", "digits", "upper", "signs", "distinct", "repeats", "path_for", "path_against", "near_for", "near_against", "assigned", "prefix")


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1: a leaf), threshold, left, right, value; and the two transition models."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    words: np.ndarray
    keys: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        trees = len(self.feature)
        at = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees)[None], np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            f = self.feature[tree, at]
            go_left = x[row, np.maximum(f, 0)] <= self.threshold[tree, at]
            at = np.where(f < 0, at, np.where(go_left, self.left[tree, at], self.right[tree, at]))
        return self.value[tree, at].mean(axis=1)


def words_before(text: str, end: int, count: int = 6) -> str:
    """The last ``count`` words before ``end``, whole however long, joined by spaces."""
    size = 128
    while True:
        start = max(0, end - size)
        words = _WORD.findall(text, start, end)
        if not start or len(words) > count:  # the first one may be cut
            return " ".join(words[-count:])
        size *= 4


def describe(value: str, path: str | None, before: str, kind: str, words: np.ndarray, keys: np.ndarray) -> list[float]:
    s = _symbols(value)
    pairs = list(zip(s, s[1:], strict=False))
    n = max(len(value), 1)
    near = [w.lower() for w in _WORD.findall(before)[-6:]]
    low = (path or "").lower()
    return [
        math.log(n),
        sum(words[a, b] for a, b in pairs) / max(len(pairs), 1),
        sum(keys[a, b] for a, b in pairs) / max(len(pairs), 1),
        coverage(value),
        sum(c.isdigit() for c in value) / n,
        sum(c.isupper() for c in value) / n,
        sum(not c.isalnum() for c in value) / n,
        len(set(value)) / min(n, 64),
        sum(a == b for a, b in pairs) / n,
        float(any(p in low for p in PATH_FOR)),
        float(any(p in low for p in PATH_AGAINST)),
        float(any(w in NEAR_FOR for w in near)),
        float(any(w in NEAR_AGAINST for w in near)),
        float(kind == "assigned"),
        float(kind in ("prefix", "block")),
    ]


def _transitions(values: list[str]) -> np.ndarray:
    counts = np.full((29, 29), 0.5)
    for v in values:
        s = _symbols(v)
        for a, b in zip(s, s[1:], strict=False):
            counts[a, b] += 1
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def grow(findings: list[tuple[str, str | None, str, str, int]], seed: int = 4) -> Forest:
    """A forest from labelled findings (value, path, words before, kind, 1 for a secret)."""
    words = _transitions([v for v, _, _, _, y in findings if not y] + sorted(DICTIONARY))
    keys = _transitions([v for v, _, _, _, y in findings if y])
    x = np.array([describe(v, p, b, k, words, keys) for v, p, b, k, _ in findings])
    y = np.array([f[4] for f in findings], float)
    rng = np.random.default_rng(seed)
    size = 2 ** (DEPTH + 1)
    shape = (TREES, size)
    f, t, lft, rgt, val = np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape)
    for k in range(TREES):
        rows = rng.integers(0, len(x), len(x))
        todo, used = [(0, rows, 0)], 1
        while todo:
            node, own, depth = todo.pop()
            val[k, node] = y[own].mean()
            if depth == DEPTH or len(own) < 4 or val[k, node] in (0.0, 1.0):
                continue
            best = None
            for j in rng.choice(x.shape[1], max(2, int(x.shape[1] ** 0.5)), replace=False):
                order = np.argsort(x[own, j], kind="stable")
                v, yy = x[own[order], j], np.cumsum(y[own[order]])
                cut = np.flatnonzero(v[1:] > v[:-1])
                if not len(cut):
                    continue
                n = cut + 1.0
                a, b = yy[cut] / n, (yy[-1] - yy[cut]) / (len(own) - n)
                impurity = n * a * (1 - a) + (len(own) - n) * b * (1 - b)
                i = int(impurity.argmin())
                if best is None or impurity[i] < best[0]:
                    best = (impurity[i], j, (v[cut[i]] + v[cut[i] + 1]) / 2)
            if best is None:
                continue
            _, j, at = best
            side = x[own, j] <= at
            f[k, node], t[k, node], lft[k, node], rgt[k, node] = j, at, used, used + 1
            todo += [(used, own[side], depth + 1), (used + 1, own[~side], depth + 1)]
            used += 2
    return Forest(f, t, lft, rgt, val, words, keys)


# Syllables of invented words.
SYLLABLES = ("the", "er", "ing", "tion", "an", "re", "st", "en", "ou", "ly", "sch", "ung", "ado", "mente", "eau", "que", "heit", "keit", "lich", "ge", "ver", "ble", "ment", "ness", "and", "on", "os", "as", "ie", "ch", "ein", "der", "ique", "elle", "aux", "able", "is", "ha", "nd", "wh", "ed", "or", "zu", "ber", "au", "al", "ra", "to", "ne")


def labelled_findings(n: int = 6000, seed: int = 4) -> list[tuple[str, str | None, str, str, int]]:
    """Invented findings with their labels, for use where a team has no labelled ones of its own.

    Secrets are random keys in the usual alphabets and lengths. The rest are what patterns trip over:
    placeholders, identifiers, words run together, hashes and ids that are named as such, repeated signs, long words of
    several languages, numbers of cards and accounts, dates, paths and addresses.
    """
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    words = sorted(DICTIONARY)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = (digits + "abcdef", digits + "ABCDEF", lower + upper + digits, lower + upper + digits + "+/", upper + digits, lower + digits, lower + upper + digits + "_-")

    def random(alphabet: str, length: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), length))

    def filler() -> str:
        return " ".join(pick(words) if rng.random() < 0.3 else random(lower, int(rng.integers(2, 11))) for _ in range(int(rng.integers(0, 6))))

    out = []
    for _ in range(n):
        path = pick((None, None, "src/main.py", "config/settings.yml", ".env", "deploy/prod.sh", "src0", f"src{int(rng.integers(100))}", "tests/test_api.py", "docs/readme.md", "package-lock.json", "examples/demo.js"))
        if rng.random() < 0.5:
            kind = pick(("assigned", "assigned", "assigned", "prefix", "mixed"))
            if kind == "prefix":
                p = pick(tuple(PREFIXES))
                value = p + random(pick(alphabets[2:3]), PREFIXES[p] + int(rng.integers(0, 20)))
            else:
                value = random(pick(alphabets), int(pick((16, 20, 24, 32, 32, 40, 40, 40, 48, 64, 64, 86))))
            before = f"{filler()} {pick(('token', 'TOKEN', 'secret', 'password', 'api_key', 'API_KEY', 'apikey', 'access_token', 'auth_token', 'Authorization Bearer', 'client_secret'))} = "
            if kind == "mixed" and rng.random() < 0.5:
                before = f"Authorization: Bearer {filler() if rng.random() < 0.2 else ''}"
            if path and rng.random() < 0.7 and any(p in path for p in PATH_AGAINST):
                path = "src/main.py"
            out.append((value, path, before, kind, 1))
            continue
        case = int(rng.integers(12))
        before, kind = f"{filler()} {pick(('token', 'password', 'secret', 'api_key', 'auth', 'TOKEN'))} = ", "assigned"
        if case == 0:
            value = pick(("your_api_key_here", "changeme", "<token>", "YOUR_TOKEN_HERE", "xxxxxxxxxxxxxxxx", "********", "example_secret_value", "replace_with_password", "undefined", "placeholder", "REDACTED_TOKEN"))
        elif case == 1:
            value = pick(("_", "-", ".", "")).join(pick(words) for _ in range(int(rng.integers(2, 6))))
        elif case == 2:
            value = f"{pick(('process.env', 'os.environ', 'config', 'self', 'request.headers'))}.{pick(words)}_{pick(words)}".replace("_", pick(("_", "")))
        elif case == 3:
            before, kind = f"{filler()} {pick(('commit', 'sha256', 'md5', 'checksum', 'sha1', 'digest', 'revision', 'integrity', 'hash'))} {pick(('', ': ', '= '))}", "mixed"
            value = random(alphabets[0], int(pick((32, 40, 64))))
        elif case == 4:
            before, kind = f"{filler()} {pick(('uuid', 'id', 'guid', 'request id'))} ", "mixed"
            value = "-".join(random(alphabets[0], k) for k in (8, 4, 4, 4, 12))
        elif case == 5:
            value = pick((lower, upper, digits, "x*#0"))[int(rng.integers(4))] * int(rng.integers(8, 40))
        elif case == 6:
            value = "".join(pick(SYLLABLES) for _ in range(int(rng.integers(3, 9)))) + pick((".", ",", "", "", ""))
        elif case in (7, 8):  # long words, compounds and inflections, of natural languages
            kind, before = "mixed", filler()
            value = pick(("", "", "", "-")).join("".join(pick(SYLLABLES) for _ in range(int(rng.integers(2, 6)))) for _ in range(int(rng.integers(2, 4))))
            value = pick((value, value, value.upper(), value.capitalize()))
        elif case == 9:  # numbers of cards, accounts and parcels, dates with times
            kind, before = "mixed", filler()
            value = pick((random(digits, int(rng.integers(16, 24))), "-".join(random(digits, 4) for _ in range(4)), f"20{random(digits, 2)}-0{random(digits[1:], 1)}-1{random(digits, 1)}-{random(digits, 6)}"))
        elif case == 10:  # paths and routes
            kind, before = "mixed", filler()
            value = "/".join(pick((pick(words), "".join(pick(SYLLABLES) for _ in range(2)), random(digits, 2))) for _ in range(int(rng.integers(4, 8))))
        else:
            kind, before = "mixed", filler()
            value = "_".join(pick(words) for _ in range(int(rng.integers(3, 7)))) + f"_{int(rng.integers(1000, 10**6))}"
        out.append((value, path, before, kind, 0))
    return out


def fit(findings: DataFrame | None = None, rows: int = SAMPLE_FINDINGS) -> Forest:
    """A forest from ``findings(value, path, before, kind, label)``, bounded by ``rows`` in hash order; without a table
    from ``labelled_findings()``."""
    if findings is None:
        return grow(labelled_findings())
    labelled = findings.where("value is not null and label is not null")
    known = hashed_sample(labelled, rows, ["value", "before"], labelled.count())
    return grow([(r["value"], r["path"], r["before"] or "", r["kind"] or "assigned", int(r["label"])) for r in known])


def judge(texts: list[str | None], paths: list[str | None], forest: Forest) -> list[list[tuple[int, int, str, float]]]:
    """(start, end, kind, score) of every candidate of every text."""
    found, x = [], []
    for text, path in zip(texts, paths, strict=True):
        own = candidates(text) if text else []
        found.append(own)
        x += [describe(text[s:e], path, words_before(text, s), k, forest.words, forest.keys) for s, e, k in own]
    p = iter(forest.probability(np.array(x)).tolist() if x else ())
    return [[(s, e, k, next(p)) for s, e, k in own] for own in found]


def masked(text: str | None, spans: list[tuple[int, int]], mask: str = MASK) -> str | None:
    """``text`` with the spans, in order and without overlaps, replaced by ``mask``."""
    if not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        out += (text[at:s], mask)
        at = e
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each candidate: (id_col, start, end, kind, value_sha1, score, is_secret), places in characters.

    Null and empty texts have none; a null path speaks neither way. Long texts and values are read whole. Of overlapping
    candidates the surer kind stays, of equal kinds the first. Repeated rows give repeated findings, null ids stay, extra
    columns are ignored. No rows: no findings.
    """
    own = plain(docs)
    base = own.select(F.col(place(docs, id_col)).alias("id"), F.col(place(docs, text_col)).alias("text"), (F.col(place(docs, path_col)) if path_col else F.lit(None)).cast("string").alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                texts = b.column(1).to_pylist()
                at, rows = [], []
                for i, own in enumerate(judge(texts, b.column(2).to_pylist(), forest)):
                    for s, e, kind, p in own:
                        at.append(i)
                        rows.append((s, e, kind, texts[i][s:e], p, p >= threshold))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())
                cols = [pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *cols], names=["id", "start", "end", "kind", "value", "score", "is_secret"])

    schema = f"id {base.schema['id'].dataType.simpleString()}, start bigint, end bigint, kind string, value string, score double, is_secret boolean"
    found = base.mapInArrow(run, schema).withColumn("value", F.sha1("value"))
    return found.toDF(id_col, "start", "end", "kind", "value_sha1", "score", "is_secret")


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = "source", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with every accepted finding of the text replaced by ``mask``; other rows and columns stay as they are.

    Null and empty texts stay so, long ones are masked whole, repeated rows and null ids stay, columns may be called
    anything. No rows: no rows.
    """
    columns = docs.columns
    at = int(place(docs, text_col)[1:])
    base = plain(docs).withColumn("path", (F.col(place(docs, path_col)) if path_col else F.lit(None)).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, own in enumerate(judge(texts, b.column(len(columns)).to_pylist(), forest)):
                texts[i] = masked(texts[i], [(s, e) for s, e, _, p in own if p >= threshold], mask)
            cols = list(b.columns[:-1])
            cols[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    return base.mapInArrow(run, schema).toDF(*columns)
