"""Licence scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

Every text goes through one multi-keyword automaton; a rule's regex runs only where all its literal words occur. Detections are taken
in priority order; one that lies inside the interval of a detection taken before is suppressed. Beside them stand the base
phrases: places where a phrase's words stand consecutively, counted over all words of the text in array operations.

Defined results: null text counts as empty and gives zero counts, null places and empty labels; a null doc_id is passed on;
repeated rows are scanned each; texts are scanned whole, whatever their length; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from framewise.llm.common import slices, texts_of, tidy_batches, tune
from framewise.llm.hashing import NOT_ALNUM, Words
from framewise.llm.license_rules import rules

#: Base phrases, given by the query's contract.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


class Scanner:
    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.compiled: dict[int, re.Pattern] = {}
        # A rule waits for its longest word, and then asks for its other ones.
        self.by_word: dict[str, list[int]] = {}
        self.always: list[int] = []
        for k, r in enumerate(self.rules):
            self.by_word.setdefault(max(r.words, key=len), []).append(k) if r.words else self.always.append(k)
        self.automaton = ahocorasick.Automaton()
        for word in {w for r in self.rules for w in r.words}:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()
        # Rules without a sure word run where one of these occurs; every pattern of theirs holds one.
        self.gate = re.compile(r"licen[sc]|creative|commons|cc|spdx|unlicense|rail|bsd|mulan|\.org|\.com|\.net|\.info|\.co/|\.eu/").search

    def pattern(self, k: int) -> re.Pattern:
        if k not in self.compiled:
            self.compiled[k] = self.rules[k].compiled()
        return self.compiled[k]

    def asked(self, low: str) -> set[int]:
        """The rules whose words the text holds."""
        words = {w for _, w in self.automaton.iter(low)}
        asked = {k for w in words for k in self.by_word.get(w, ()) if words.issuperset(self.rules[k].words)}
        if self.always and self.gate(low):
            asked.update(self.always)
        return asked

    def matches(self, low: str, asked) -> list[tuple[int, int, int, int]]:
        """(rule, -length, start, end) in priority order; of a tag the identifier counts, as one tag can hold several."""
        spans = ((k, *m.span("at" if self.rules[k].kind == "tag" else 0)) for k in asked for m in self.pattern(k).finditer(low))
        return sorted((k, a - b, a, b) for k, a, b in spans)

    def detections(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) of what stays after suppression, in priority order."""
        low = text.lower()
        found = self.matches(low, self.asked(low))
        return [(a, b, k) for k, a, b in suppress([(k, a, b) for k, _, a, b in found])]


def suppress(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(rule, start, end) in priority order without those inside an interval taken before. Taken intervals that hold one
    another don't occur, so sorted starts have sorted ends and one look finds a holder."""
    import bisect

    starts: list[int] = []
    ends: list[int] = []
    out = []
    for k, a, b in found:
        at = bisect.bisect_right(starts, a) - 1
        if at >= 0 and ends[at] >= b:
            continue
        out.append((k, a, b))
        # The new interval may hold older ones; they are no longer needed as holders.
        lo = bisect.bisect_left(starts, a)
        hi = lo
        while hi < len(starts) and ends[hi] <= b:
            hi += 1
        starts[lo:hi], ends[lo:hi] = [a], [b]
    return out


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def base_places(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, phrase) of all places of the base phrases, words counted from the text's first."""
    data = words.data.tobytes()
    places = []
    for p, phrase in enumerate(PHRASES):
        parts = phrase.encode().split()
        pattern = rb"(?<![0-9a-z\x80-\xff])" + rb"[^0-9a-z\x80-\xff\n]*(?:\n[^0-9a-z\x80-\xff\n]*)*".join([b"%s(?![0-9a-z\x80-\xff])" % x for x in parts])
        if parts[-1] in data:
            places += [(m.start(), m.end(), p) for m in re.finditer(pattern, data)]
    if not places:
        return (np.zeros(0, np.int64),) * 3
    start, end, phrase = np.array(places, np.int64).T
    text = np.searchsorted(words.offsets, start, "right") - 1
    inside = end <= words.offsets[text + 1]  # a phrase doesn't run on into the next text
    start, text, phrase = start[inside], text[inside], phrase[inside]
    return text, np.searchsorted(words.starts, start) - words.first[text], phrase


COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, spans: bool = False) -> DataFrame:
    """documents -> the columns above and, if asked for, spans: the detections (start, end, label) in code points of the
    lower-cased text."""
    tune(docs.sparkSession)

    def run(batches):
        names = list(PHRASES.values())
        for b in batches:
            texts = texts_of(b["text"])
            for a, z in slices(texts):
                part = texts.slice(a, z - a)
                words = Words(part, lower=True, gap=NOT_ALNUM)
                n = len(part)
                text, at, phrase = base_places(words)
                n_base = np.bincount(text, minlength=n)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(first, text, at)
                np.maximum.at(last, text, at)
                base: list[set] = [set() for _ in range(n)]
                for t, p in zip(text.tolist(), phrase.tolist(), strict=True):
                    base[t].add(names[p])
                labels, score, found = [], [], []
                for k, t in enumerate(part):
                    kept = scanner().detections(t.as_py()) if len(t.as_py()) else []
                    mine = [(scanner().rules[r], s, e) for s, e, r in kept]
                    labels.append(",".join(sorted(base[k] | {r.label for r, _, _ in mine})))
                    missed = 0.3 if base[k] else 1.0
                    for weight in {(r.label, r.weight) for r, _, _ in mine}:
                        missed *= 1 - weight[1]
                    score.append(1 - missed)
                    found.append([{"start": s, "end": e, "label": r.label} for r, s, e in mine])
                none = n_base == 0
                out = [b["doc_id"].slice(a, n).cast(pa.int64()), pa.array(words.counts, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none), pa.array([",".join(sorted(x)) for x in base], pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())]
                fields = [c.split()[0] for c in COLUMNS.split(", ")]
                if spans:
                    out.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))))
                    fields.append("spans")
                yield pa.record_batch(out, names=fields)

    schema = COLUMNS + (", spans array<struct<start:int,end:int,label:string>>" if spans else "")
    return docs.select("doc_id", "text").mapInArrow(tidy_batches(run), schema)
