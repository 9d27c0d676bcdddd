"""Fuzzy search for short license notices: exact seeds by the pigeonhole rule, then bounded-error matching."""

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_rows

#: Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    errors: int


#: Notices in lower case, with the edits (insertions, deletions, substitutions) each may have.
NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted, free of charge, to any person", 5),
    Notice("apache", "licensed under the apache license, version 2.0", 4),
    Notice("gpl", "licensed under the gnu general public license, version 3", 5),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by", "licensed under cc by 4.0", 1),
    Notice("cc-by-nc", "licensed under cc by-nc 4.0", 1),
    Notice("cc-by-sa", "licensed under cc by-sa 4.0", 1),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("all-rights-reserved", "all rights reserved", 1),
)
SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, spans array<string>"
)
WORD = rb"[0-9a-z\x80-\xff]"


def seeds(notice: Notice) -> list[tuple[str, int]]:
    """The notice cut into one piece more than its errors, with their offsets: a match must hold one piece unedited."""
    borders = [round(i * len(notice.text) / (notice.errors + 1)) for i in range(notice.errors + 2)]
    return [(notice.text[a:b], a) for a, b in zip(borders, borders[1:])]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        held: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            for piece, at in seeds(notice):
                held.setdefault(piece, []).append((n, at))
        for piece, places in held.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(x.text)}){{e<={x.errors}}}") for x in notices]
        between, edge = rb"[^0-9a-z\x80-\xff]+", (rb"(?<!" + WORD + rb")", rb"(?!" + WORD + rb")")
        self.phrases = [
            (label, re.compile(edge[0] + between.join(x.encode() for x in phrase.split()) + edge[1]))
            for phrase, label in PHRASES.items()
        ]
        self.is_word = np.zeros(256, dtype=bool)
        self.is_word[48:58] = self.is_word[97:123] = self.is_word[128:] = True

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """Matches in a lower-case text: label, start, end (characters), errors, score."""
        windows: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.seeds.iter(text):
            for n, at in places:
                notice = self.notices[n]
                start = max(0, end + 1 - length - at - notice.errors)
                stop = end + 1 - length - at + len(notice.text) + notice.errors
                windows.setdefault(n, []).append([start, stop])
        found = []
        for n, spans in sorted(windows.items()):
            merged: list[list[int]] = []
            for start, stop in sorted(spans):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            notice = self.notices[n]
            for start, stop in merged:
                for m in self.patterns[n].finditer(text, start, min(stop, len(text))):
                    errors = sum(m.fuzzy_counts)
                    found.append((notice.label, m.start(), m.end(), errors, 1 - errors / len(notice.text)))
        return found

    def scan(self, doc_id, text: str | None):
        data = (text or "").encode("utf-8").lower()
        inside = self.is_word[np.frombuffer(data, dtype="u1")]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        places: list[int] = []
        base = set()
        if b"license" in data:
            number = np.cumsum(starts) - 1
            for label, pattern in self.phrases:
                hits = [int(number[m.start()]) for m in pattern.finditer(data)]
                places += hits
                base |= {label} if hits else set()
        found = self.fuzzy(data.decode("utf-8"))
        score = max([float(bool(places)), *(x[4] for x in found)])
        yield (
            doc_id, int(starts.sum()), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {x[0] for x in found})), score,
            [f"{label}:{a}-{b}:{errors}" for label, a, b, errors, _ in found],
        )


def scan_licenses(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """License notices of every whole text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans (label:start-end:errors, in characters).

    Letters A-Z are lower-cased; words are runs of digits, letters a-z and characters beyond ASCII. Base labels
    come from exact phrases of consecutive words; the fuzzy search adds labels for notices within their
    error bound, and misses none: a match with e errors leaves one of e + 1 pieces intact. The score is 1 for an
    exact phrase or notice, else the share of the best match's characters that needed no edit, 0 without a match.
    A null or empty text has no words, empty labels and score 0; a null doc_id stays null; repeated rows give a row
    each; other columns are ignored; an empty table gives no rows.
    """

    def make():
        return Scanner(notices).scan

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(narrow, make, SCHEMA, ["doc_id", "text"])
