"""Token counts of sections: a document is encoded once and its tokens are allotted by character spans."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_rows
from replyscope.llm.encoding import byte_letters, default_tokenizer, encoder

SCHEMA = "doc_id bigint, section bigint, start bigint, end bigint, n_tokens bigint, n_crossing bigint"


def token_bytes(vocabulary: dict[str, int], special: list[str]) -> np.ndarray:
    """Bytes that each id stands for in a byte-level vocabulary."""
    letters, size = set(byte_letters()), max(vocabulary.values()) + 1
    lengths = np.zeros(size, dtype="i8")
    for token, i in vocabulary.items():
        lengths[i] = len(token) if token not in special and set(token) <= letters else len(token.encode("utf-8"))
    return lengths


def spans(ids: np.ndarray, lengths: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one character of each token; a token that holds part of a character has it whole."""
    char = np.cumsum((np.frombuffer(text, dtype="u1") & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    return char[ends - lengths[ids]], char[ends - 1] + 1


def allot(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and tokens that touch it and another one.

    ``borders`` are the sections' first characters and the text's end; sections tile the text. A token
    belongs to the section that holds most of its characters, the earliest of equals.
    """
    n = len(borders) - 1
    first = np.searchsorted(borders, starts, side="right") - 1
    last = np.searchsorted(borders, ends, side="left") - 1
    home, crossing = first.copy(), np.zeros(n, dtype="i8")
    for k in np.flatnonzero(last > first):
        touched = np.arange(first[k], last[k] + 1)
        held = np.minimum(borders[touched + 1], ends[k]) - np.maximum(borders[touched], starts[k])
        home[k] = touched[np.argmax(held)]
        crossing[touched] += 1
    return np.bincount(home, minlength=n), crossing


def section_token_counts(docs: DataFrame, tokenizer: str | None = None, separator: str = "\n") -> DataFrame:
    """Tokens of every section of every text: doc_id, section (from 0), start, end (characters), n_tokens, n_crossing.

    A section ends after each ``separator`` and at the end of the text, so sections tile the text and their
    counts add up to the tokens of the whole document, which is encoded once. A token across a border counts
    for the section with most of its characters, the earliest of equals; n_crossing counts the tokens
    that touch a section and another one. A null or empty text gives one empty section without tokens; a
    null doc_id stays null; repeated rows are counted each; other columns are ignored; an empty table gives
    no rows. The tokenizer must be byte-level.
    """
    path = tokenizer or default_tokenizer()

    def make():
        known = encoder(path)
        lengths = token_bytes(known.tokenizer.get_vocab(with_added_tokens=True), known.special)

        def count(doc_id, text):
            if not text:
                yield doc_id, 0, 0, 0, 0, 0
                return
            ids = known.ids(text)
            starts, ends = spans(ids, lengths, text.encode("utf-8"))
            sizes = [len(x) + len(separator) for x in text.split(separator)]
            borders = np.concatenate([[0], np.cumsum(sizes)])
            borders[-1] = len(text)
            if len(borders) > 2 and borders[-1] == borders[-2]:
                borders = borders[:-1]
            n_tokens, crossing = allot(starts, ends, borders)
            for k in range(len(n_tokens)):
                yield doc_id, k, int(borders[k]), int(borders[k + 1]), int(n_tokens[k]), int(crossing[k])

        return count

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(narrow, make, SCHEMA, ["doc_id", "text"])
