"""Licence scans: texts compared with licence templates by the Dice coefficient of their word bigrams.

Method.  Texts and templates are normalised alike: A-Z lower-cased; words are runs of a-z, digits, ``.``,
``-`` and characters beyond ASCII, without full stops at their end.  Each line of a text is a candidate,
and so is the whole text.  Two sets of m and n bigrams have a Dice coefficient of at most
2 min(m, n) / (m + n), so a template is compared only with candidates whose number of bigrams is
within [t / (2 - t), (2 - t) / t] times its own for the threshold t: these size bounds leave nearly
every line without a template to compare with.  A candidate of one word has one bigram, the word.

With ``spans`` every run of a text's words within the upper size bound is a candidate too, whatever its
lines (words of hyphens only, as comment marks, are left out).  A span that reaches t holds at least
a t / (2 - t) of a template's a bigrams, so it holds one of any a - ceil(a t / (2 - t)) + 1 of them: a text
without one of the template's rarest so many (its anchors) is not compared.  In the others the best span
is found from every start; starts that cannot reach the score to beat are passed over, by how little the
score can rise from one start to the next.  A match inside a match of a template at least twice as large
is a part of that (the first sentence of a BSD text, the notice in a GPL header) and does not count.

Results for special inputs: null and empty texts have no licence; equal scores go to the earlier template
of the list; repeated rows get a row each; an empty table gives an empty result; an input column with
the name of an output column is replaced.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import quoted, without

THRESHOLD = 0.8
OUTPUTS = ("license", "license_score", "n_license_lines")

# Short licence notices, as (name, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)

# Whole licence texts and file headers, as (name, text): NAME.txt and NAME.header.txt.
FULL_TEXTS = tuple((p.name.removesuffix(".txt").removesuffix(".header"), p.read_text())
                   for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))

WORDS = r"[a-z0-9.\-\u0080-\U0010FFFF]+"
CAPITALS = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    found = (w.rstrip(".") for w in re.findall(WORDS, text.translate(CAPITALS)))
    return [w for w in found if w]


def bigrams_of(words: list[str]) -> set[str]:
    return set(words) if len(words) == 1 else {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


class Templates:
    """Bigram sets of the templates, by the numbers of bigrams that a match may have."""

    def __init__(self, templates, threshold: float):
        self.threshold, self.by_size = threshold, {}
        for nth, (name, text) in enumerate(templates):
            own = bigrams_of(words_of(text))
            for size in range(1, int(len(own) * (2 - threshold) / threshold) + 2):
                if 2 * min(size, len(own)) / (size + len(own)) >= threshold:
                    self.by_size.setdefault(size, []).append((nth, name, own))

    def reached(self, words: list[str]) -> list:
        """(-score, number, name, bigrams) of the templates that reach the threshold."""
        if not words:
            return []
        own = bigrams_of(words)
        scored = ((-2 * len(own & b) / (len(own) + len(b)), nth, name, len(b)) for nth, name, b in self.by_size.get(len(own), ()))
        return [s for s in scored if -s[0] >= self.threshold]

    def best(self, words: list[str]):
        """(-score, number, name) of the best template that reaches the threshold, or None."""
        top = min(self.reached(words), default=None)
        return top and top[:3]


class Spans:
    """Templates compared with every span of a text."""

    def __init__(self, templates, threshold: float):
        self.threshold, self.single, self.sets = threshold, {}, []
        for nth, (name, text) in enumerate(templates):
            words = spoken(words_of(text))
            if len(words) == 1:
                self.single.setdefault(words[0], (-1.0, nth, name))
            if len(words) < 2:
                continue
            own = bigrams_of(words)
            need = math.ceil(len(own) * threshold / (2 - threshold) - 1e-9)
            anchors = frozenset(sorted(own, key=lambda g: (-len(g), g))[:len(own) - need + 1])
            widest = math.floor((len(words) - 1) * (2 - threshold) / threshold + 1e-9)
            self.sets.append((len(own), nth, name, own, need, anchors, widest))
        self.sets.sort(key=lambda x: (-x[0], x[1]))
        self.anchors = frozenset().union(*[x[5] for x in self.sets])

    def found(self, words: list[str]) -> tuple[list, list]:
        """[(-score, number, name)] of the spans that reach the threshold and are no part of a larger match;
        [(first bigram, end, bigrams of the template)] of all."""
        import numpy as np
        hits = [self.single[w] for w in set(words) & self.single.keys()] if self.single else []
        grams = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        known = set(grams)
        if self.anchors.isdisjoint(known):
            return hits, []
        here = [x for x in self.sets if len(known) >= x[4] and not x[5].isdisjoint(known) and len(x[3] & known) >= x[4]]
        if not here:
            return hits, []
        last, prev = {}, np.empty(len(grams), dtype=np.int64)
        for i, g in enumerate(grams):
            prev[i] = last.get(g, -1)
            last[g] = i
        taken = []
        for size, nth, name, own, need, _, widest in here:
            member = np.fromiter((g in own for g in grams), dtype=bool, count=len(grams))
            for lo, hi, other in taken:
                if other >= 2 * size:
                    member[lo:hi] = False
            for score, lo, hi in best_spans(prev, member, size, need, widest, self.threshold):
                hits.append((-score, nth, name))
                taken.append((lo, hi, size))
        return hits, taken


def best_spans(prev, member, size: int, need: int, widest: int, threshold: float):
    """(Dice, first, end) of spans of bigrams that reach the threshold, one of each overlapping group, the best
    span among them.  ``prev``: place of the same bigram before, or -1; ``member``: whether the template has it."""
    import numpy as np
    at = np.flatnonzero(member)
    starts = at[np.searchsorted(at, at + widest) - np.arange(len(at)) >= need]
    held, next_start = None, 0
    for s in starts.tolist():
        if held and s >= held[2]:
            yield held
            held = None
        if s < next_start:
            continue
        fresh = prev[s:s + widest] < s
        shared = np.cumsum(fresh & member[s:s + widest])
        dice = 2 * shared / (np.cumsum(fresh) + size)
        k = int(dice.argmax())
        top = float(dice[k])
        if top >= threshold and (held is None or top > held[0]):
            held = (top, s, s + k + 1)
        if held and held[0] == 1.0:
            next_start = held[2]
        else:  # one start further on, a score is greater by at most 3 / (size + need)
            beat = held[0] if held else threshold
            next_start = min(s + max(1, math.floor((beat - top) * (size + need) / 3 - 1e-9)), held[2] if held else 1 << 62)
    if held:
        yield held


def spoken(words: list[str]) -> list[str]:
    return [w for w in words if w.strip("-")]


def scan_licenses(docs: DataFrame, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD,
                  spans: bool = False) -> DataFrame:
    """``docs`` with license (the template of greatest Dice coefficient that reaches ``threshold``, or
    null), license_score and n_license_lines (lines that reach it with some template).  Candidates are
    the lines and the whole text, with ``spans`` every span of words."""
    keep = without(docs, OUTPUTS)
    docs = docs.select(*[quoted(c) for c in keep])
    schema = T.StructType([*docs.schema.fields, T.StructField("license", T.StringType()),
                           T.StructField("license_score", T.DoubleType()), T.StructField("n_license_lines", T.LongType())])

    def scan(batches):
        import pyarrow as pa
        known = Templates(templates, threshold)
        inside = Spans(templates, threshold) if spans else None
        for batch in batches:
            name, score, lines = [], [], []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                words = [words_of(x) for x in (t or "").split("\n")]
                hits = [h for h in map(known.reached, words) if h]
                lines.append(len(hits))
                whole = known.reached([w for x in words for w in x]) if len(words) > 1 else []
                if spans:
                    words = [spoken(x) for x in words]
                    more, taken = inside.found([w for x in words for w in x])
                    if taken and hits:
                        hits = uncovered(known, words, taken)
                    hits.append(more)
                top = min((h for x in [*hits, whole] for h in x), default=None)
                name.append(top and top[2])
                score.append(top and -top[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(name, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(lines, pa.int64())], names=schema.names)

    return docs.mapInArrow(scan, schema)


def uncovered(known: Templates, lines: list[list[str]], taken: list) -> list:
    """What the lines reach, without lines inside a match of a template at least twice as large."""
    out, lo = [], 0
    for words in lines:
        hi = lo + len(words) - 1  # bigrams of the line
        out.append([h for h in known.reached(words) if not any(a <= lo and hi <= b and n >= 2 * h[3] for a, b, n in taken)])
        lo += len(words)
    return out
