"""License scans: fuzzy search for short notices, with exact phrases beside it.

A text is reduced to its words (A-Z lower-cased; letters, digits and every
non-ASCII byte; joined by one space).  A notice may differ from its wording by a
few edits.  Split into more pieces than that, all but as many as there are edits
stand there unchanged (pigeonhole), so one automaton over all pieces finds every
place that can hold a notice.  Where enough pieces meet, the ``regex`` library
searches the notice with bounded errors, from word boundary to word boundary, and
the best fits become spans.  A notice's ``head`` must stand unchanged: an edit in the few
letters that tell one license from another would change its meaning.

Each text is scanned whole in the task that reads it: no row is shuffled.

Defined cases: a null text counts as empty; an empty text has no span; a very
long text is scanned whole, alone in its step; rows that repeat an id are judged
row by row; ids of any type, null too, pass through; other columns are dropped;
an empty table gives no rows.  An edit is one UTF-8 byte.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import ship
from driftgate.llm.words import slices


class Notice(NamedTuple):
    label: str
    head: str  # stands unchanged
    tail: str  # may differ by ``edits``
    edits: int

    @property
    def wording(self) -> str:
        return self.head + self.tail


#: Wordings of public license notices, as normalised words.
NOTICES = [
    Notice("mit", "mit ", "license", 1),
    Notice("mit", "", "permission is hereby granted free of charge to any person obtaining a copy", 8),
    Notice("apache", "", "apache license", 1),
    Notice("apache", "", "licensed under the apache license version 2 0", 4),
    Notice("gpl", "", "general public license", 2),
    Notice("gpl", "", "this program is free software you can redistribute it and or modify it under the terms of the gnu", 9),
    Notice("lgpl", "", "gnu lesser general public license", 2),
    Notice("agpl", "", "gnu affero general public license", 2),
    Notice("bsd", "bsd ", "license", 1),
    Notice("bsd", "", "redistribution and use in source and binary forms with or without modification are permitted", 9),
    Notice("mpl", "", "mozilla public license", 2),
    Notice("epl", "", "eclipse public license", 2),
    Notice("isc", "isc ", "license", 1),
    Notice("isc", "", "permission to use copy modify and or distribute this software for any purpose", 7),
    Notice("cc-by-nc", "", "cc by nc", 0),
    Notice("cc-by-sa", "", "cc by sa", 0),
    Notice("cc-by", "", "creative commons attribution", 2),
    Notice("unlicense", "", "this is free and unencumbered software released into the public domain", 6),
]

PIECE = 7

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return [w for w in text.translate(_FOLD).split(b" ") if w]


def pieces(wording: str, edits: int) -> list[tuple[int, str]]:
    """(place, piece): the wording cut into more pieces than edits, of about ``PIECE`` characters where it is long enough."""
    n = max(edits + 1, len(wording) // PIECE)
    cut = [round(i * len(wording) / n) for i in range(n + 1)]
    return [(a, wording[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


class Scanner:
    """Finds notices in normalised texts."""

    def __init__(self, notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.notices = [Notice(n.label, *(x.encode().decode("latin-1") for x in (n.head, n.tail)), n.edits) for n in notices]
        self.patterns = [regex.compile(f"(?e)(?<= ){regex.escape(n.head)}(?:{regex.escape(n.tail)}){{e<={n.edits}}}(?= )") for n in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.needed = []  # pieces that stand unchanged in every place of a notice
        for i, n in enumerate(self.notices):
            cut = pieces(n.wording, n.edits)
            self.needed.append(len(cut) - n.edits)
            for place, piece in cut:
                seeds.setdefault(piece, []).append((i, place))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        if seeds:
            self.seeds.make_automaton()

    def windows(self, text: str) -> dict[int, list[tuple[int, int, set[int]]]]:
        """For each notice the stretches of the text around its pieces, apart from each other, with the pieces seen there."""
        found: dict[int, list[tuple[int, int, set[int]]]] = {}
        if not len(self.seeds):
            return found
        for last, (size, uses) in self.seeds.iter(text):
            for i, place in uses:
                n = self.notices[i]
                lo = last + 1 - size - place - n.edits - 1
                hi = lo + len(n.wording) + 2 * n.edits + 3
                held, seen = found.setdefault(i, []), {place}
                # pieces come by their ends; a stretch may still reach back before the one before
                while held and lo <= held[-1][1]:
                    a, b, before = held.pop()
                    lo, hi, seen = min(a, lo), max(b, hi), before | seen
                held.append((lo, hi, seen))
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) by place of the text's characters."""
        out = []
        for i, held in self.windows(text).items():
            for lo, hi, seen in held:
                if len(seen) < self.needed[i]:
                    continue
                stop = text.find(" ", min(max(hi - 1, 0), len(text) - 1))
                for m in self.patterns[i].finditer(text, max(lo, 0), len(text) if stop < 0 else stop + 1):
                    out.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
        return sorted(out)


def _places(text: str, phrase: str) -> list[int]:
    """Where the words of a phrase stand one after another."""
    out, at = [], text.find(f" {phrase} ")
    while at >= 0:
        out.append(at + 1)
        at = text.find(f" {phrase} ", at + 1)
    return out


SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("edits", pa.int64())])
_OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string, first_word:long, words:long, edits:long>>"


def _scan(scanner: Scanner, phrases: Sequence[tuple[str, str]]):
    def judge(raw: bytes) -> tuple:
        listed = words_of(raw)
        text = b" ".join([b"", *listed, b""]).decode("latin-1") if listed else " "
        base = [(at, label) for phrase, label in phrases for at in _places(text, phrase)]
        spans = scanner.spans(text)
        if not base and not spans:
            return len(listed), 0, None, None, "", "", 0.0, []
        gaps = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        word = lambda at: int(np.searchsorted(gaps, at)) - 1  # noqa: E731  the space before word i is gap i
        starts = [word(at) for at, _ in base]
        named = [scanner.notices[i] for i, *_ in spans]
        score = max([1.0 if base else 0.0, *(1 - e / len(n.wording) for n, (_, _, _, e) in zip(named, spans, strict=True))])
        labels = {label for _, label in base}
        rows = [{"label": n.label, "first_word": word(a), "words": word(b) - word(a) + 1, "edits": e} for n, (_, a, b, e) in zip(named, spans, strict=True)]
        return (
            len(listed),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(labels)),
            ",".join(sorted(labels | {n.label for n in named})),
            score,
            rows,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                raw = batch.column(1).slice(lo, hi - lo).cast(pa.large_binary())
                rows = [judge(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in raw]
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(SPAN)]
                cols = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
                names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *cols], ["id", *names])

    return run


def scan_notices(docs: DataFrame, phrases: Sequence[tuple[str, str]], notices: Sequence[Notice] = NOTICES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the exact ``phrases`` (words, label) as base, the notices' labels and spans, and how near the best one is (1: unchanged, 0: none)."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    folded = [(" ".join(w.decode("latin-1") for w in words_of(p.encode())), label) for p, label in phrases]

    def run(batches):
        yield from _scan(Scanner(notices), folded)(batches)

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {_OUT}")
    return out.withColumnRenamed("id", id_col)
