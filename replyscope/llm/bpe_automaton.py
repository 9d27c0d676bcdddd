"""Tokenization automaton: merges compiled one by one into a deterministic automaton over tokens."""

import hashlib
import json
import re
from functools import cached_property

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import map_rows
from replyscope.llm.encoding import WORD_PATTERN, Pieces, Words, byte_letters, default_tokenizer

MOVES_KEPT = 1_000_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class MergeAutomaton:
    """Accepts exactly the token sequences that applying the merges in order can leave behind.

    It starts as one state with a loop for each byte token. The gadget of merge (u, v) -> w acts on all
    states at once: arcs labelled u now lead to a copy of their old target that lacks the arc v; beside
    each arc u that remains stands an arc w, which leads where v led. Which state an arc leads to depends on
    its label only, so the automaton is deterministic and its tables are short:

    ``lost[u, v]``  step at which the state behind u lost its arc v;
    ``source[w]``   the token whose state w took over, ``born[w]`` the step at which it did;
    ``beside[w]``   the token whose arcs w was put beside: w starts only where that one did then.

    Copies are not written out: what a copied state lacks is what its source had lost by then.
    """

    def __init__(self, size: int, merges: list[tuple[int, int, int]]):
        self.size = size
        self.lost: dict[int, int] = {}
        self.source, self.beside, self.born = [-1] * size, [-1] * size, [0] * size
        self.moves: dict[int, bool] = {}
        self.alive = [True] * size
        for _, _, w in merges:
            self.alive[w] = False
        for step, (u, v, w) in enumerate(merges, 1):
            self._gadget(step, u, v, w)

    def _gadget(self, step: int, u: int, v: int, w: int) -> None:
        if not (self.alive[u] and self.alive[v] and self._has_arc(u, v)):  # no path u v is left: nothing to merge
            return
        self.alive[w] = True
        self.lost[u * self.size + v] = step
        self.source[w], self.beside[w], self.born[w] = v, u, step

    def _has_arc(self, state: int, token: int) -> bool:
        """Whether the state behind ``state`` has an arc ``token``: neither the state nor one it was copied
        from had lost the arc, or the one it was put beside, by the step of the copy."""
        until = 1 << 60
        while state >= 0:
            arc, seen = token, 1 << 60
            while arc >= 0:
                step = self.lost.get(state * self.size + arc)
                if step is not None and step <= until and step <= seen:
                    return False
                seen, arc = self.born[arc], self.beside[arc]
            until, state = min(until, self.born[state] - 1), self.source[state]
        return True

    def move(self, state: int, token: int) -> bool:
        """The transition table, filled as transitions are met and bounded."""
        key = state * self.size + token
        known = self.moves.get(key)
        if known is None:
            if len(self.moves) >= MOVES_KEPT:
                self.moves.clear()
            known = self.moves[key] = self._has_arc(state, token)
        return known


class AutomatonTokenizer:
    """Encodes and decodes by the automaton; reads vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary = told["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in told.get("added_tokens", [])}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.labels = [b""] * size
        for token, i in vocabulary.items():
            self.labels[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode("utf-8")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        self.automaton = MergeAutomaton(size, [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        self.arcs = {
            label: i for i, label in enumerate(self.labels)
            if label and self.automaton.alive[i] and i not in self.special.values()
        }
        _ = self.sizes, self.begins, self.shorter  # made here, not with the first word
        self.packed_ids = [i.to_bytes(4, "little") for i in range(size)]
        self.numbers = [str(i) for i in range(size)]
        self.split = regex.compile(WORD_PATTERN).findall
        self.apart = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words, self.pieces = Words(self), Pieces(self)

    @cached_property
    def sizes(self) -> list[int]:
        return list(map(len, self.labels))

    @cached_property
    def _nested(self) -> tuple[dict[bytes, int], list[int]]:
        """For each beginning of a label the longest arc that it begins with, and for each arc the next shorter one."""
        begins, shorter = {}, [-1] * len(self.labels)
        for label, i in sorted(self.arcs.items()):  # a label's own beginnings stand before it
            found = -1
            for end in range(1, len(label)):
                beginning = label[:end]
                found = begins.setdefault(beginning, self.arcs.get(beginning, found))
            shorter[i] = found
            begins[label] = i
        return begins, shorter

    @cached_property
    def begins(self) -> dict[bytes, int]:
        return self._nested[0]

    @cached_property
    def shorter(self) -> list[int]:
        return self._nested[1]

    def word_ids(self, data: bytes) -> list[int]:
        """The one accepted path that spells ``data``, searched from its start: at each place the longest arc first, then shorter ones.

        Every start of ``data`` has one accepted path too, so a place from which no arc leads on is on no path to the end and
        is not tried again.
        """
        whole = self.arcs.get(data)
        if whole is not None:
            return [whole]
        automaton, sizes, shorter, longest, n = self.automaton, self.sizes, self.shorter, self._longest, len(data)
        size, known, move = automaton.size, automaton.moves.get, automaton.move
        path, at, last, dead = [], 0, -1, set()
        arc = longest(data, 0)
        while True:
            while arc >= 0:
                if not dead or at + sizes[arc] not in dead:
                    fits = last < 0 or known(last * size + arc)
                    if fits or (fits is None and move(last, arc)):
                        break
                arc = shorter[arc]
            if arc >= 0:
                path.append(arc)
                at, last = at + sizes[arc], arc
                if at >= n:
                    return path
                arc = longest(data, at)
            else:
                if not path:
                    raise ValueError(f"no path spells {data!r}")
                dead.add(at)
                arc = path.pop()
                at, last = at - sizes[arc], path[-1] if path else -1
                arc = shorter[arc]

    def _longest(self, data: bytes, at: int) -> int:
        """The longest arc whose label stands at a place; -1 if there is none."""
        begins = self.begins
        end = at + 3
        found = begins.get(data[at:end])  # most places have three bytes that begin a label
        if found is None:
            return begins.get(data[at : at + 2], begins.get(data[at : at + 1], -1))
        for end in range(end + 1, len(data) + 1):
            arc = begins.get(data[at:end])
            if arc is None:
                break
            found = arc
        return found

    def word(self, word: str) -> bytes:
        packed = self.packed_ids
        return b"".join([packed[i] for i in self.word_ids(word.encode("utf-8"))])

    def words_of(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def _plain(self, text: str) -> bytes:
        if "\0" in text:
            return self.words_of(text)
        cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        try:
            return b"".join(map(self.pieces.__getitem__, cut))
        except TypeError:  # a piece without ids of its own
            return self.words_of(text)

    def encode(self, text: str) -> list[int]:
        if self.apart is None or not any(s in text for s in self.special):
            data = self._plain(text) if text else b""
        else:
            data = b"".join(
                np.array([self.special[x]], dtype="<u4").tobytes() if x in self.special else self._plain(x)
                for x in self.apart.split(text) if x
            )
        return np.frombuffer(data, dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The labels along the arcs, read as UTF-8; broken sequences become replacement characters."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


_TOKENIZERS: dict[str, AutomatonTokenizer] = {}


def tokenizer(path: str) -> AutomatonTokenizer:
    """Compiled once a worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = AutomatonTokenizer(path)
    return _TOKENIZERS[path]


def encode_and_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids (decimal, comma-joined) and of the decoded text (and ids, if asked for).

    A null text counts as empty and has no tokens; special tokens in a text become their ids; a null
    doc_id stays null; repeated rows give a row each; other columns are ignored; an empty table gives no
    rows. Texts are encoded whole, whatever their length.
    """
    path = path or default_tokenizer()

    def make():
        known = tokenizer(path)

        def digest(doc_id, text):
            ids = known.encode(text or "")
            listed = ",".join(map(known.numbers.__getitem__, ids))
            row = (
                doc_id, len(ids), hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(known.decode(ids).encode("utf-8")).hexdigest(),
            )
            yield (*row, ids) if with_ids else row

        return digest

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(narrow, make, SCHEMA + ", ids array<bigint>" if with_ids else SCHEMA, ["doc_id", "text"])
