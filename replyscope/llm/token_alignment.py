"""Cross-tokenizer alignment: common byte ends of two tokenizations by galloping search, linked tokens counted over all documents."""

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from replyscope.llm.chunks import ChunkNumbers, keep_in_buckets
from replyscope.llm.common import small_batches
from replyscope.llm.encoding import MARKS, WORD_PATTERN, byte_letters, default_tokenizer, plain_letters

#: A stretch ends before a blank that stands alone between other characters: no token of either kind spans that place.
STRETCH = re.compile(r"\s*\S*(?:(?! \S)\s+\S*)*")
STRETCHES_KEPT = 200_000
WORDS_KEPT = 150_000
LONGEST_KEPT = 64
CHUNK_BYTES = 4 << 20


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def gallop_places(short: np.ndarray, long: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the first, in the second array) of the values that two ascending arrays share.

    Each value of the first, shorter array is searched from its place ``low`` in the second one, no later than its own: steps
    double until they pass the value, and a binary search in the last step finds it. All values make their steps together.
    """
    low, high, step, n = low.copy(), low.copy(), 1, len(long)
    left = np.arange(len(short))
    while len(left):
        left = left[high[left] < n]
        left = left[long[high[left]] < short[left]]
        low[left] = high[left] + 1
        high[left] += step
        step *= 2
    np.minimum(high, n, out=high)
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        less = long[middle] < short[left]
        low[left] = np.where(less, middle + 1, low[left])
        high[left] = np.where(less, high[left], middle)
        left = left[low[left] < high[left]]
    found = np.flatnonzero(low < n)
    found = found[long[low[found]] == short[found]]
    return found, low[found]


def gallop(short: list[int], long: list[int]) -> list[tuple[int, int]]:
    """``gallop_places`` of two lists, searched from the first place on."""
    a, b = np.array(short, dtype=np.int64), np.array(long, dtype=np.int64)
    i, j = gallop_places(a, b, np.zeros(len(a), dtype=np.int64))
    return list(zip(i.tolist(), j.tolist()))


def common_ends(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int]]:
    if len(ends_a) <= len(ends_b):
        return gallop(ends_a, ends_b)
    return [(i, j) for j, i in gallop(ends_b, ends_a)]


def gathered(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``table`` from ``starts`` on, end to end."""
    ends = np.cumsum(lengths)
    return table[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


class Joined:
    """Byte strings end to end, so that many of them are laid side by side at once."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(x) for x in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def of(self, which: np.ndarray) -> np.ndarray:
        return gathered(self.bytes, self.starts[which], self.lengths[which])


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of the first side, the first and last token of the second whose bytes overlap its bytes: the rank
    of its start among the second ends, and that of its end."""
    starts = np.concatenate([[0], ends_a[:-1]]) if len(ends_a) else ends_a
    return np.searchsorted(ends_b, starts, "right"), np.searchsorted(ends_b, ends_a, "left")


class Words(dict):
    """Words to their ids as bytes; all are given up when there are too many."""

    def __init__(self, ids: Callable[[str], bytes]):
        super().__init__()
        self.ids = ids

    def __missing__(self, word: str) -> bytes:
        found = self.ids(word)
        if len(self) >= WORDS_KEPT:
            self.clear()
        if len(word) <= LONGEST_KEPT:
            self[word] = found
        return found


class Aligner:
    """Both tokenizers, and what is known of stretches met before: two generations, of which the older is given up."""

    def __init__(self, path_a: str, path_b: str):
        self.model = Tokenizer.from_file(path_a).model
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.letters = "".join(letters)
        byte_of = {c: b for b, c in enumerate(letters)}
        words = Tokenizer.from_file(path_a).get_vocab(with_added_tokens=False)
        self.bytes_a = {i: bytes(byte_of[c] for c in w) for w, i in words.items() if all(c in byte_of for c in w)}
        self.bytes_b = [self._piece(i) for i in range(self.pieces.vocab_size())]
        self.joined_a = Joined([self.bytes_a.get(i, b"") for i in range(max(self.bytes_a) + 1)])
        self.joined_b = Joined(self.bytes_b)
        self.lengths_a, self.lengths_b = self.joined_a.lengths, self.joined_b.lengths
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.lengths_a))]
        self.numbers = Joined([b"%d," % i for i in range(max(len(self.lengths_a), len(self.lengths_b)))])
        self.split = regex.compile(WORD_PATTERN).findall
        self.words = Words(self.word_a)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        words = self.words
        if text[1:].isalpha() and text[0] == " ":  # one word, as most stretches
            return words[text]
        if text[-1] in MARKS and text[0] == " " and plain_letters(text[1:-1]):
            return words[text[:-1]] + words[text[-1]]
        return b"".join(map(words.__getitem__, self.split(text)))

    def word_a(self, word: str) -> bytes:
        latin = word if word.isascii() else word.encode().decode("latin-1")
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(latin.translate(self.letters))])

    def known(self, stretches: list[str]) -> list[tuple | None]:
        """What ``aligned`` gives for each stretch."""
        young, old = self.young, self.old
        new = [s for s in stretches if s not in young and s not in old]
        made = dict(zip(new, self.aligned(new)))
        out = [made[s] if s in made else young[s] if s in young else old[s] for s in stretches]
        young.update(x for x in zip(stretches, out) if len(x[0]) <= LONGEST_KEPT)
        if len(young) > STRETCHES_KEPT:
            self.young, self.old = {}, young
        return out

    def aligned(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes] | None]:
        """Of each stretch: tokens of each kind, groups, the groups as text, the linked ids (a << 32 | b, as bytes); None if the bytes differ.

        The stretches are laid end to end, as each one ends with an end of both kinds, and searched together.
        """
        a, b = [self.ids_a(t) for t in texts], self.pieces.encode([t[1:] for t in texts], num_threads=1)
        n_a, n_b = [len(x) // 4 for x in a], list(map(len, b))
        flat_a = np.frombuffer(b"".join(a), dtype="<u4").astype(np.int64)
        flat_b = np.fromiter(chain.from_iterable(b), np.int64, sum(n_b))
        fits = self._fits(texts, n_a, n_b, flat_a, flat_b)
        if fits is not None:
            flat_a, flat_b = flat_a[np.repeat(fits, n_a)], flat_b[np.repeat(fits, n_b)]
            n_a, n_b = ([x for x, fit in zip(n, fits) if fit] for n in (n_a, n_b))
        ends_a, ends_b = np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])
        # where each stretch ends among the tokens of either kind
        size_a, size_b = np.array(n_a, dtype=np.int64), np.array(n_b, dtype=np.int64)
        last_a, last_b = np.cumsum(size_a), np.cumsum(size_b)
        if len(flat_a) <= len(flat_b):  # a token's end is searched from the first token of its stretch
            common = np.stack(gallop_places(ends_a, ends_b, np.repeat(last_b - size_b, size_a)), axis=1) + 1
        else:
            common = np.stack(gallop_places(ends_b, ends_a, np.repeat(last_a - size_a, size_b))[::-1], axis=1) + 1
        low, last = overlaps(ends_a, ends_b)
        n = last - low + 1
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        links = ((np.repeat(flat_a, n) << 32) | flat_b[at]).tobytes()
        # and among the groups, their text and the links
        last_group = np.searchsorted(common[:, 0], last_a, "right").tolist()
        last_link = (8 * np.concatenate([[0], np.cumsum(n)])[last_a]).tolist() if len(last_a) else []
        shown, last_shown = self._shown(flat_a, flat_b, common, last_a + last_b)
        made, group, text, link = [], 0, 0, 0
        for x, y, group_end, text_end, link_end in zip(n_a, n_b, last_group, last_shown, last_link):
            made.append((x, y, group_end - group, shown[text : text_end - 1], links[link:link_end]))
            group, text, link = group_end, text_end, link_end
        if fits is None:
            return made
        rest = iter(made)
        return [next(rest) if fit else None for fit in fits]

    def _fits(self, texts: list[str], n_a: list[int], n_b: list[int], flat_a: np.ndarray, flat_b: np.ndarray) -> list[bool] | None:
        """Whether the bytes of both kinds of tokens are those of the text, stretch by stretch; None if they are in all of them."""
        sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
        last = [np.cumsum(n, dtype=np.int64) for n in (n_a, n_b)]
        lengths = [self.lengths_a[flat_a], self.lengths_b[flat_b]]
        same = all(np.array_equal(np.concatenate([[0], np.cumsum(x)])[at], np.cumsum(sizes)) for x, at in zip(lengths, last))
        whole = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
        if same and np.array_equal(self.joined_a.of(flat_a), whole) and np.array_equal(self.joined_b.of(flat_b), whole):
            return None
        sides = [list(map(self.bytes_a.__getitem__, flat_a.tolist())), list(map(self.bytes_b.__getitem__, flat_b.tolist()))]
        cuts = zip(*[(at - n).tolist() for at, n in zip(last, (n_a, n_b))], *[at.tolist() for at in last])
        return [
            b"".join(sides[0][i:k]) == b"".join(sides[1][j:m]) == t.encode() for t, (i, j, k, m) in zip(texts, cuts)
        ]

    def _shown(self, a: np.ndarray, b: np.ndarray, common: np.ndarray, last: np.ndarray) -> tuple[str, list[int]]:
        """The groups as text, a mark behind each, and where it ends for the first ``last`` tokens of both kinds; ``common`` has
        the ends of the groups among the tokens of each side."""
        ends_a, ends_b = common[:, 0], common[:, 1]
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        ids = np.empty(len(a) + len(b), dtype=np.int64)  # group after group, its first side before its second
        ids[np.arange(len(a)) + np.repeat(ends_b - n_b, n_a)] = a
        ids[np.arange(len(b)) + np.repeat(ends_a, n_b)] = b
        ends = np.concatenate([[0], np.cumsum(self.numbers.lengths[ids])])
        text = self.numbers.of(ids)
        text[ends[ends_a + ends_b - n_b] - 1] = ord("|")
        text[ends[ends_a + ends_b] - 1] = ord(";")
        return text.tobytes().decode("ascii"), ends[last].tolist()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One a worker process, kept from task to task."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


class ChunkLinks:
    """The alignments of one chunk's texts. ``pairs``: the linked id pairs in order, ``held``: how many documents hold each;
    of a document ``first`` to ``last`` in ``bag`` and ``times``: which pairs it holds, and how often."""

    def __init__(self, texts: list[str | None], tools: Aligner):
        cut = [STRETCH.findall(" " + t)[:-1] if t else [] for t in texts]  # the last match is empty, at the end
        names = list(dict.fromkeys(chain.from_iterable(cut)))
        code = {s: k for k, s in enumerate(names)}
        facts = tools.known(names)
        bad = {k for k, x in enumerate(facts) if x is None}
        codes = [np.fromiter(map(code.__getitem__, stretches), np.int64, len(stretches)) for stretches in cut]
        if bad:
            codes = [c if bad.isdisjoint(c.tolist()) else c[:0] for c in codes]
        facts = [x or (0, 0, 0, "", b"") for x in facts]
        shown = [x[3] for x in facts]
        self.groups = [";".join([shown[k] for k in c.tolist()]) for c in codes]
        lengths = np.array([len(c) for c in codes], dtype=np.int64)
        every = np.concatenate([*codes, np.empty(0, np.int64)])
        doc = np.repeat(np.arange(len(texts)), lengths)
        n = np.array([(x[0], x[1], x[2], len(x[4]) // 8) for x in facts], dtype=np.int64).reshape(-1, 4)
        before = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(n[every], axis=0)])
        ends = np.cumsum(lengths)
        self.counts = before[ends] - before[ends - lengths]
        self._links(doc, every, [x[4] for x in facts], n[:, 3], len(texts))

    def _links(self, doc: np.ndarray, every: np.ndarray, links: list[bytes], n_links: np.ndarray, n_texts: int) -> None:
        met, times = np.unique(doc * max(1, len(links)) + every, return_counts=True)
        doc, code = np.divmod(met, max(1, len(links)))
        flat = np.frombuffer(b"".join(links), dtype=np.int64)
        self.pairs, which = np.unique(flat, return_inverse=True)
        n, first = n_links[code], (np.cumsum(n_links) - n_links)[code]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        key = np.repeat(doc, n) * max(1, len(self.pairs)) + which[at]
        held, place = np.unique(key, return_inverse=True)
        self.times = np.bincount(place, np.repeat(times, n), len(held)).astype(np.int32)
        doc, bag = np.divmod(held, max(1, len(self.pairs)))
        self.bag = bag.astype(np.int32)
        self.last = np.searchsorted(doc, np.arange(n_texts), "right")
        self.first = np.searchsorted(doc, np.arange(n_texts), "left")
        self.held = np.bincount(bag, minlength=len(self.pairs))


def _documents(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int, with_groups: bool) -> DataFrame:
    """A row per document with counts and its bag of pairs, and a row per chunk with its pairs (pairs, held)."""
    small_batches(docs.sparkSession)
    fields = {
        "chunk": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
        "n_links": pa.int64(), "groups_sha256": pa.string(), "groups": pa.string(), "bag": pa.binary(), "times": pa.binary(),
        "pairs": pa.list_(pa.int64()), "held": pa.list_(pa.int64()),
    }

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), fields.values())], names=list(fields))

    def made(chunk: int, ids: list[int | None], texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        links = ChunkLinks(texts, aligner(path_a, path_b))
        rows = []
        for k, (doc_id, groups, a, b) in enumerate(zip(ids, links.groups, links.first.tolist(), links.last.tolist())):
            digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
            shown = groups if with_groups else None
            rows.append((chunk, doc_id, *links.counts[k].tolist(), digest, shown, links.bag[a:b].tobytes(), links.times[a:b].tobytes(), None, None))
            if len(rows) >= 500:
                yield table(rows)
                rows = []
        if len(links.pairs):
            rows.append((chunk, *[None] * 9, links.pairs.tolist(), links.held.tolist()))
        if rows:
            yield table(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, now, ids, texts = None, None, [], []
        for batch in batches:
            chunks = chunks or ChunkNumbers(chunk_bytes)
            got = batch.column(1).to_pylist()
            numbers = chunks.of(np.array([len(t) if t else 0 for t in got])).tolist()
            for chunk, doc_id, text in zip(numbers, batch.column(0).to_pylist(), got):
                if texts and chunk != now:
                    yield from made(now, ids, texts)
                    ids, texts = [], []
                now = chunk
                ids.append(doc_id)
                texts.append(text)
        if texts:
            yield from made(now, ids, texts)

    schema = (
        "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
        "bag binary, times binary, pairs array<long>, held array<long>"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def pair_counts(chunk_pairs: DataFrame) -> DataFrame:
    """Of rows (pair, held): in how many documents each pair is linked (pair, count), and whether no pair of the same first
    id has more (best)."""
    counts = chunk_pairs.groupBy("pair").agg(F.sum("held").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def align_tokenizers(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    with_groups: bool = False,
) -> DataFrame:
    """Each text in the tokens of a byte-level BPE file (A, with a blank before the text) and of a piece model (B, which adds it).

    Byte offsets where tokens of both kinds end cut them into groups; tokens whose byte ranges overlap are linked. A pair
    of ids counts the documents that hold it linked, over the whole table. Per row: doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose count no other pair of their A id exceeds), count_sum (counts of all links), groups_sha256 of the groups
    written as ``a1,a2|b1;a3|b2``, and that text as ``groups`` if wanted. Strings of special tokens are plain text.

    Null and empty texts, and texts whose joined token bytes differ from blank + text (such as texts with U+2581), have no
    tokens: zeros and ''. Rows of one doc_id, and repeated rows, are documents of their own; other columns are left out;
    an empty table gives no rows.

    A text is cut where no token can span (a blank between other characters); each distinct stretch of a chunk is encoded and
    aligned once. Documents and their bags of pairs are written once, bucketed by chunk; a chunk sends each of its pairs
    once, with the number of its documents, and gets the counts back. Neither texts nor bags are shuffled, nothing is broadcast,
    and a pair in every document is one row a chunk.
    """
    path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
    kept = keep_in_buckets(_documents(docs, path_a, path_b, chunk_bytes, with_groups), "chunk", "aligned")
    listed = kept.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x"))
    listed = listed.select("chunk", "at", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    told = listed.join(pair_counts(listed.select("pair", "held")), "pair").select(F.col("chunk").alias("of"), "at", "count", "best")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *["groups"] * with_groups]

    def run(mine: pa.Table, counted: pa.Table) -> pa.Table:
        at = counted.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = counted.column("count").to_numpy(), counted.column("best").to_numpy(zero_copy_only=False)
        sums = []
        for bag, times in zip(mine.column("bag").to_pylist(), mine.column("times").to_pylist()):
            which, n = np.frombuffer(bag, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
            sums.append((int(n @ best[which]), int(n @ count[which])))
        out = mine.select(columns)
        for k, name in enumerate(("n_best", "count_sum")):
            out = out.append_column(name, pa.array([s[k] for s in sums], pa.int64()))
        return out

    own = kept.where("pairs is null").select("chunk", *columns, "bag", "times")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "groups string, " * with_groups + "n_best long, count_sum long"
    return own.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(run, schema)
