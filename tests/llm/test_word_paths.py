"""Words to ids without a pattern search or a look at every pair of places; odd texts as the library encodes them."""

import random

import pytest
from tokenizers import Tokenizer

from replyscope.llm import bpe_automaton, encoding, token_alignment

LETTERS = [*" .,;:!?'abcXYZ", "ä", "ß", "ª", "ʰ", "ɏ", "ɐ", "中", "́", "½", " ", "　", "\n", "\t", "  ", "'s", " the", "\0"]


@pytest.fixture(scope="module")
def path():
    return encoding.default_tokenizer()


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    return ["", " ", ".", " .", "a..", "don't.", "we'll,", "x" * 300] + ["".join(r.choices(LETTERS, k=r.randint(1, 30))) for _ in range(800)]


def test_odd_texts_as_the_library(path, texts):
    library, own, automaton = Tokenizer.from_file(path), encoding.TextEncoder(path), bpe_automaton.AutomatonTokenizer(path)
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert own.ids(text).tolist() == want and automaton.encode(text) == want, text


def test_plain_words_need_no_pattern(path):
    """op7, op6: a word, with or without a mark behind it, is told by its letters."""
    own = encoding.TextEncoder(path)
    want = own.tokenizer.encode("Words hereand, dünne there.", add_special_tokens=False).ids
    own.split = None
    assert own.ids("Words hereand, dünne there.").tolist() == want


def test_places_tried_by_the_automaton(path):
    """op9: a few looks a byte, where every earlier place within the longest label was tried before."""

    class Counted(dict):
        looks = 0

        def get(self, *key):
            Counted.looks += 1
            return super().get(*key)

    known = bpe_automaton.AutomatonTokenizer(path)
    word = "".join(random.Random(1).choices("abcdefghijklmnop", k=2000)).encode()
    known.arcs = Counted(known.arcs)
    known.begins = Counted(getattr(known, "begins", {}))
    ids = known.word_ids(word)
    assert b"".join(known.labels[i] for i in ids) == word and Counted.looks < 8 * len(word)


def test_marks_need_no_pattern_in_the_alignment(path):
    """op13: ids of a word and the mark behind it."""
    tools = token_alignment.Aligner(path, token_alignment.default_pieces())
    want = tools.model.tokenize("Ġhereand"), tools.model.tokenize(",")
    tools.split = None
    (fact,) = tools.aligned([" hereand,"])
    assert fact[0] == sum(map(len, want))


def test_stretches_that_do_not_fit_are_told_apart(path):
    """op13: one stretch with other bytes on the second side leaves the others as they are alone."""
    tools = token_alignment.Aligner(path, token_alignment.default_pieces())
    stretches = [" abc", " a▁b", " café.", " x y"]
    together = tools.aligned(stretches)
    assert together == [tools.aligned([s])[0] for s in stretches] and together[1] is None and together[0] is not None


def test_gallop():
    r = random.Random(3)
    for _ in range(300):
        a, b = (sorted(r.sample(range(60), r.randint(0, 40))) for _ in range(2))
        assert [a[i] for i, j in token_alignment.gallop(a, b)] == sorted({*a} & {*b})
        assert all(a[i] == b[j] for i, j in token_alignment.gallop(a, b))
