"""Repeated word windows against brute force: spans and kept words, skew, odd rows, chunk and bucket sizes."""

import random
import re

import numpy as np
import pytest

from replyscope.llm import rabin_karp

DATA = "/root/testdata/sf0.001"


def brute(rows, width):
    """Rows (doc_id, text) in stored order to sorted (doc_id, n_words, n_removed, spans, kept_text)."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen, out = set(), []
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)):
        words, gone = split[k], set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone |= set(range(i, i + width))
            seen.add(window)
        spans = []
        for i in sorted(gone):
            if spans and spans[-1][1] == i - 1:
                spans[-1][1] = i
            else:
                spans.append([i, i])
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((rows[k][0], len(words), len(gone), spans, kept))
    return sorted(out, key=repr)


def check(df, width, **sizes):
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], width)
    got = rabin_karp.drop_repeated_passages(df, width, **sizes).collect()
    assert sorted(map(tuple, got), key=repr) == want
    return want


def test_rolling_hash_is_the_polynomial():
    words = np.random.default_rng(1).integers(0, 2**63, 120).astype(np.uint64)
    for width in (1, 2, 3, 7, 20, 32, 120, 121):
        want = [sum(int(words[i + j]) * pow(5, width - 1 - j, 1 << 64) for j in range(width)) % (1 << 64) for i in range(121 - width)]
        assert rabin_karp.rolling(words, width, 5).tolist() == want


def test_word_hashes_depend_on_the_word_only():
    rng = random.Random(2)
    words = ["".join(rng.choice("abé\0日") for _ in range(rng.randint(1, 5))) for _ in range(500)] + ["x" * 3_000_000]
    gaps = [rng.choice([" ", "\n", "\t \x0b", "\r\f"]) for _ in words]
    starts, hashes = rabin_karp.word_hashes("".join(g + w for g, w in zip(gaps, words)).encode())
    assert len(starts) == len(words)
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist())))


def test_whole_table(spark):
    want = check(spark.read.parquet(f"{DATA}/documents.parquet"), 20)
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("chunk_bytes, bucket_bytes", [(1, 1 << 20), (300, 50), (1 << 20, 1 << 20)])
def test_hot_passages_in_any_chunks(spark, chunk_bytes, bucket_bytes):
    rng = random.Random(4)
    passage = " ".join(rng.choice("abcd") + str(i) for i in range(9))
    texts = []
    for i in range(300):
        own = " ".join(rng.choice(["red", "blue", "fox"]) for _ in range(rng.randint(0, 12)))
        texts.append(f"{own} {passage} \t{own}" if i % 3 == 0 else own if i % 3 == 1 else f"{i} " * (i % 7))
    ids = list(range(300))
    rng.shuffle(ids)
    want = check(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), 4, chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes)
    assert sum(r[2] for r in want) > 900


def test_odd_rows(spark, odd_docs, no_docs):
    want = check(odd_docs, 3)
    assert len(want) == odd_docs.count() and sum(r[2] for r in want) > 30_000
    check(odd_docs, 20)
    assert rabin_karp.drop_repeated_passages(no_docs).collect() == []


def test_repeated_id_and_rows(spark):
    rows = [(7, "a b c d e f")] * 3 + [(7, "x a b c y")] + [(None, "a b c")] * 2 + [(1, "c d e f"), (2, "a b a b a b")]
    want = check(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 3)
    assert [(r[1], r[2]) for r in want if r[0] == 7] == [(5, 3), (6, 4), (6, 6), (6, 6)]
