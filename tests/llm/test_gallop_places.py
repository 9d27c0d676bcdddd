"""Ends searched together: equal to the search of one value after the other, from any first place."""

import numpy as np
import pytest

from replyscope.llm import token_alignment as ta


@pytest.mark.parametrize("seed", range(6))
def test_places_from_any_start(seed):
    random = np.random.default_rng(seed)
    long = np.unique(random.integers(0, 3_000, 600))
    short = np.unique(random.integers(0, 3_500, 5 * 4**seed))
    first = np.searchsorted(long, short)
    for low in (np.zeros(len(short), np.int64), first, first // 2):
        i, j = ta.gallop_places(short, long, low.astype(np.int64))
        assert short[i].tolist() == long[j].tolist() == sorted({*short.tolist()} & {*long.tolist()})
    none = np.empty(0, np.int64)
    assert ta.gallop_places(none, long, none)[0].size == ta.gallop_places(short, none, np.zeros(len(short), np.int64))[0].size == 0


def test_groups_are_laid_out_at_once():
    tools = ta.aligner(ta.default_tokenizer(), ta.default_pieces())
    texts = [" one", " two,", " Wörter", " x.\nYzzyx", " 12345"]
    together, alone = tools.aligned(texts), [tools.aligned([t])[0] for t in texts]
    assert together == alone and tools.aligned([]) == []
    for n_a, n_b, groups, shown, links in alone:
        sides = [g.split("|") for g in shown.split(";")]
        assert groups == len(sides) and len(links) % 8 == 0
        assert sum(len(a.split(",")) for a, _ in sides) == n_a and sum(len(b.split(",")) for _, b in sides) == n_b


def test_words_are_given_up(monkeypatch):
    monkeypatch.setattr(ta, "WORDS_KEPT", 10)
    tools = ta.aligner(ta.default_tokenizer(), ta.default_pieces())
    words = ta.Words(tools.word_a)
    assert [words[f" word{i}"] for i in range(40)] == [tools.word_a(f" word{i}") for i in range(40)]
    assert len(words) <= 10 and words[" " + "x" * 200] and " " + "x" * 200 not in words
