"""What a worker process keeps between rows."""

import tracemalloc

from replyscope.llm import circulant_minhash


def test_shingler_keeps_no_words():
    tool = circulant_minhash.Shingler(4)
    tool.shingles("a first text of some words")
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for k in range(100):
            found = tool.shingles(" ".join(f"word{k}x{i}" for i in range(500)))
        assert len(found) == 497
        del found
        assert tracemalloc.get_traced_memory()[0] - before < 1_000_000  # 50,000 words, some 5 MB if they were kept
    finally:
        tracemalloc.stop()
