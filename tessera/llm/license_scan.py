"""License scans by template markup compiled into token automata.

A template is wording with markup: ``<<optional>>...<<end>>`` may be left out, and
``<<any:PATTERN:LOW-HIGH>>`` stands for LOW to HIGH words that each match PATTERN. It is compiled into a
non-deterministic automaton over words; a text is accepted at a place if the automaton runs from its
start to its end there, that is if all mandatory wording stands there exactly, in order, with nothing
between but what the markup allows. Runs start only at the template's anchors, the longest stretch of
mandatory words, so that most texts cost one substring search a template.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .license_texts import TEMPLATES
from .support import picked

#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_NOT_WORD = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NOT_WORD).split()


@dataclass(frozen=True)
class Automaton:
    """States are numbers from 0; ``steps`` has (from, test, to), a test of None being free. ``anchor`` stands
    ``before`` (fewest, most) words behind the start of an accepted run."""

    steps: tuple[tuple[int, bytes | re.Pattern | None, int], ...]
    end: int
    anchor: bytes
    before: tuple[int, int]

    @property
    def moves(self) -> dict[int, list]:
        out: dict[int, list] = {}
        for a, test, b in self.steps:
            out.setdefault(a, []).append((test, b))
        return out


def compile_template(template: str) -> Automaton:
    """Parse the markup; raises ValueError where it doesn't nest, or if nothing is mandatory.

    Wording is cut into words as texts are, so its punctuation doesn't count.
    """
    steps: list[tuple[int, bytes | re.Pattern | None, int]] = []
    state, open_at = 0, []
    low = high = 0  # words since the start
    run: list[bytes] = []
    run_at = (0, 0)
    best: tuple[int, bytes, tuple[int, int]] = (0, b"", (0, 0))
    count = [(0, 0)]

    def close() -> None:
        nonlocal run, best
        if len(run) > best[0]:
            best = (len(run), b" ".join(run), run_at)
        run = []

    for token in (t for piece in re.split(r"(<<[^>]*>>)", template) for t in ([piece] if piece.startswith("<<") else words_of(piece))):
        if token == "<<optional>>":
            close()
            open_at.append(state)
            count.append((low, high))
        elif token == "<<end>>":
            if not open_at:
                raise ValueError(f"nothing to end in {template!r}")
            close()
            low = count.pop()[0]
            steps.append((open_at.pop(), None, state))
        elif isinstance(token, str) and token.startswith("<<any:"):
            close()
            pattern, _, span = token[6:-2].rpartition(":")
            a, b = map(int, span.split("-"))
            test = re.compile(pattern.encode())
            for k in range(b):
                steps.append((state, test, state + 1))
                if k >= a:
                    steps.append((state, None, state + b - k))
                state += 1
            low, high = low + a, high + b
        elif isinstance(token, str):
            raise ValueError(f"unknown markup {token}")
        else:
            if not open_at:
                if not run:
                    run_at = (low, high)
                run.append(token)
            steps.append((state, token, state + 1))
            state += 1
            low, high = low + 1, high + 1
    close()
    if open_at or not best[0]:
        raise ValueError(f"unclosed or without mandatory wording: {template!r}")
    return Automaton(tuple(steps), state, best[1], best[2])


def run_from(automaton: Automaton, moves: dict[int, list], words: list[bytes], start: int) -> int | None:
    """Where the longest accepted run from ``start`` ends, or None."""

    def free(states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for test, to in moves.get(todo.pop(), ()):
                if test is None and to not in states:
                    states.add(to)
                    todo.append(to)
        return states

    states, at, found = free({0}), start, None
    while states:
        if automaton.end in states:
            found = at
        if at >= len(words):
            break
        w = words[at]
        states = free({to for s in states for test, to in moves.get(s, ()) if test is not None and (test == w if isinstance(test, bytes) else test.fullmatch(w))})
        at += 1
    return found


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which the phrase starts; ``joined`` has a space before, between and after its words."""
    needle, out = b" " + phrase + b" ", []
    at, seen, word = joined.find(needle), 0, 0
    while at >= 0:
        word += joined.count(b" ", seen, at)
        out.append(word)
        seen = at
        at = joined.find(needle, at + 1)
    return out


@lru_cache(maxsize=8)
def _compiled(templates: tuple[tuple[str, tuple[str, ...]], ...]) -> tuple[tuple[str, Automaton, dict[int, list]], ...]:
    return tuple((label, a := compile_template(t), a.moves) for label, ts in templates for t in ts)


def matches(joined: bytes, words: list[bytes], templates: tuple[tuple[str, tuple[str, ...]], ...]) -> list[tuple[str, int, int]]:
    """(label, first word, word after the last) of accepted runs: for each template and anchor the earliest, longest."""
    out = []
    for label, automaton, moves in _compiled(templates):
        if b" " + automaton.anchor + b" " not in joined:
            continue
        for at in places(joined, automaton.anchor):
            fewest, most = automaton.before
            for start in range(max(0, at - most), at - fewest + 1):
                end = run_from(automaton, moves, words, start)
                if end is not None and end > at:
                    out.append((label, start, end))
                    break
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row for each row of ``docs``: (id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    n_base counts all places of the phrases; first_word and last_word are the least and largest of them,
    null without one. labels has the phrases' and the accepted templates' labels, distinct, sorted and
    comma-joined, empty without one. score is 1 - 2**-n for n accepted runs, or 0.25 with phrases alone, or 0. spans lists
    the accepted runs; of runs from one anchor the earliest start counts, to its last possible end. Null and empty texts
    have no words, long texts are read whole. Repeated rows and null ids stay, extra columns are ignored. No rows: no rows.
    """
    base_phrases = tuple((k.encode(), v) for k, v in (PHRASES if phrases is None else phrases).items())
    marked = tuple((k, tuple(v)) for k, v in (TEMPLATES if templates is None else templates).items())

    def one(text: str | None) -> tuple:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        starts, base = [], set()
        for phrase, label in base_phrases:
            found = places(joined, phrase)
            if found:
                base.add(label)
                starts += found
        runs = matches(joined, words, marked)
        labels = base | {x for x, _, _ in runs}
        score = 1 - 0.5 ** len(runs) if runs else 0.25 if base else 0.0
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, [{"label": a, "start": b, "end": c} for a, b, c in runs]

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(t.as_py()) for t in b.column(1)]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=names)

    base = picked(docs, id=id_col, text=text_col)
    schema = f"id {base.schema['id'].dataType.simpleString()}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint>>"
    return base.mapInArrow(run, schema).toDF(id_col, *names[1:])
