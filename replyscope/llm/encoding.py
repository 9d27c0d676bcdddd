"""Whole texts to token ids by the tokenizers library, with a bounded memory of pieces seen before."""

import re

import numpy as np
import regex
from tokenizers import Tokenizer

#: How byte-level tokenizers of this kind split a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES_KEPT = 700_000
#: Words that are no pieces, such as those before a comma.
WORDS_KEPT = 100_000
#: Marks that end the word before them and are words themselves.
MARKS = frozenset(".,;:!?")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others follow in order from code point 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def plain_letters(text: str) -> bool:
    """Whether a text is Latin letters only, so that it is one word by ``WORD_PATTERN``, with or without a blank before it."""
    return text.isalpha() and (text.isascii() or max(text) < "\u0250")


class Pieces(dict):
    """Text pieces between single spaces to their ids (bytes of little-endian unsigned 32-bit numbers);
    None for pieces whose ids depend on what stands around them."""

    def __init__(self, encoder: "TextEncoder"):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes | None:
        body = piece[1:] if piece[:1] == " " else piece
        if plain_letters(body):  # most pieces: one word
            found = self.encoder.word(piece)
        elif body[-1:] in MARKS and plain_letters(body[:-1]):  # or a word and a mark
            found = self.encoder.words[piece[:-1]] + self.encoder.words[body[-1:]]
        elif not piece or (piece != "\n" and re.search(r"\s", piece[1:] if piece[0] == " " else piece)) or piece == " ":
            found = None
        else:
            words = self.encoder.split(piece)
            # a piece that is one word is remembered here only
            found = self.encoder.word(piece) if len(words) == 1 else b"".join(map(self.encoder.words.__getitem__, words))
        if len(self) >= PIECES_KEPT:
            self.clear()
        self[piece] = found
        return found


class Words(dict):
    """Pre-split words to their ids as bytes."""

    def __init__(self, encoder: "TextEncoder"):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        found = self.encoder.pieces.get(word)
        if found is None:
            if len(self) >= WORDS_KEPT:
                self.clear()
            found = self[word] = self.encoder.word(word)
        return found


class TextEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    A byte-level tokenizer splits text into words before it merges, and a single space or line break
    between other characters always ends a word. So texts are cut there, and the ids of each piece are
    looked up; the library is asked about new words only. Texts with other white space are split by the
    tokenizer's own pattern; texts with special tokens, and all texts of other tokenizers, are encoded
    whole by the library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        import json

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
            and not told.get("normalizer") and told["model"]["type"] == "BPE"
            and not told["model"].get("ignore_merges") and not told["model"].get("dropout")
        )
        self.special = [x["content"] for x in told.get("added_tokens", [])]
        self.model = self.tokenizer.model
        self.letters = "".join(byte_letters())
        self.packed_ids = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.split = regex.compile(WORD_PATTERN).findall
        self.words, self.pieces = Words(self), Pieces(self)

    def word(self, word: str) -> bytes:
        latin = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        packed = self.packed_ids
        return b"".join([packed[t.id] for t in self.model.tokenize(latin.translate(self.letters))])

    def words_of(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def packed(self, text: str) -> bytes:
        """The ids as bytes of little-endian unsigned 32-bit numbers."""
        if not self.by_word or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if "\0" in text:
            return self.words_of(text)
        cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        try:
            return b"".join(map(self.pieces.__getitem__, cut))
        except TypeError:  # a piece without ids of its own
            return self.words_of(text)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), dtype="<u4")


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder a worker process, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
