"""Licence scan by ordered signature rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.license_rules import RULES

#: Phrases whose places are counted, and their labels.
BASE = {" mit license ": "mit", " apache license ": "apache", " general public license ": "gpl"}

#: A-Z folded; bytes of words, which are digits, letters and all beyond ASCII, as they are; others blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Rule(NamedTuple):
    priority: int
    confidence: float
    label: str
    keyword: str
    pattern: re.Pattern


def rules(text: str = RULES) -> list[Rule]:
    found = []
    for line in text.strip().splitlines():
        head, keyword, pattern = line.split(" | ", 2)
        priority, confidence, label = head.split()
        found.append(Rule(int(priority), int(confidence) / 100, label, keyword, re.compile(f" (?:{pattern})(?= )")))
    return found


class Scanner:
    def __init__(self, signatures: list[Rule] | None = None):
        self.rules = rules() if signatures is None else signatures
        self.gate = ahocorasick.Automaton()
        self.by_keyword: dict[str, list[Rule]] = {}
        for r in self.rules:
            self.by_keyword.setdefault(r.keyword, []).append(r)
        for k in [*self.by_keyword, *(b.strip() for b in BASE)]:
            self.gate.add_word(f" {k}", k)
        self.gate.make_automaton()

    def detections(self, words: str, keywords: set[str]) -> list[tuple[int, int, Rule]]:
        """Spans of the rules whose keyword stands, without those that another one overrules.

        Overruled: a span inside that of a rule of higher priority, inside a longer one of the same
        priority, or equal to one of an earlier rule of that priority.
        """
        every = []
        for k in keywords & self.by_keyword.keys():
            for r in self.by_keyword[k]:
                every += [(m.start(), m.end(), r) for m in r.pattern.finditer(words)]
        order = {id(r): i for i, r in enumerate(self.rules)}
        every.sort(key=lambda d: (-d[2].priority, d[0] - d[1], order[id(d[2])], d[0]))
        kept: list[tuple[int, int, Rule]] = []
        # kept spans in the order of their starts; of those that begin no later than a span, the farthest end decides
        starts = sorted({d[0] for d in every})
        place = {s: i + 1 for i, s in enumerate(starts)}
        farthest = [0] * (len(starts) + 1)
        for a, b, r in every:
            i, end = place[a], 0
            while i:
                end = max(end, farthest[i])
                i &= i - 1
            if end >= b:
                continue
            kept.append((a, b, r))
            i = place[a]
            while i < len(farthest):
                farthest[i] = max(farthest[i], b)
                i += i & -i
        return sorted(kept, key=lambda d: d[:2])

    def scan(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score and the spans as (label, first word, words)."""
        split = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
        # bytes as characters: a word beyond ASCII is none of any pattern
        words = f" {b' '.join(split).decode('latin-1')} "
        keywords = {k for _, k in self.gate.iter(words)}
        if not keywords:
            return len(split), 0, None, None, "", "", 0.0, []
        base, labels, at = [], set(), 0
        for phrase, label in BASE.items():
            at = words.find(phrase)
            while at >= 0:
                base.append(at)
                labels.add(label)
                at = words.find(phrase, at + 1)
        found = self.detections(words, keywords)
        spans = [(r.label, words.count(" ", 0, a), words.count(" ", a, b)) for a, b, r in found]
        return (
            len(split),
            len(base),
            words.count(" ", 0, min(base)) if base else None,
            words.count(" ", 0, max(base)) if base else None,
            ",".join(sorted(labels)),
            ",".join(sorted(labels | {r.label for _, _, r in found})),
            max([r.confidence for _, _, r in found], default=0.0),
            spans,
        )


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first_word: long, n_words: long>>"
)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The licence marks of each row of docs, by the rules of license_rules.RULES.

    A text's words are its maximal runs of digits, letters (A-Z folded) and characters beyond ASCII.
    The base columns are of the phrases in BASE: places, smallest and largest first word, labels.
    The rules' keywords are looked for in one pass; only rules whose keyword stands are tried, and
    spans that another rule overrules are dropped (see Scanner.detections). labels has base labels
    and those of the spans left; score is the highest confidence among these, 0 without any.

    Null or empty text: no words. Null doc_ids and repeated rows get a row each. An empty table gives
    an empty table. Other columns, whatever their names, are ignored. No row leaves its partition.
    """
    spans = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))
    kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), spans]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        keys = ("label", "first_word", "n_words")
        for batch in batches:
            rows = [scanner.scan(t.as_py()) for t in batch.column(1)]
            cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in kinds]
            cols[-1] = [[dict(zip(keys, s, strict=True)) for s in x] for x in cols[-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *map(pa.array, cols, kinds)], names=names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)
