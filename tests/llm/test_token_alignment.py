"""Aligned tokens against both libraries on whole texts and a brute-force search for overlaps."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from replyscope.llm import token_alignment as ta
from replyscope.llm.encoding import byte_letters, default_tokenizer

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ta.default_pieces())


def token_bytes(libraries, text):
    a, b = libraries
    byte_of = {c: i for i, c in enumerate(byte_letters())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    parts_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        parts_b.append(bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    return ids_a, ids_b, parts_a, parts_b


def one(libraries, text):
    """(n_a, n_b, groups text, links) of one text."""
    if not text:
        return 0, 0, "", []
    ids_a, ids_b, parts_a, parts_b = token_bytes(libraries, text)
    if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
        return 0, 0, "", []
    spans = []
    for parts in (parts_a, parts_b):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        spans.append(out)
    common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, before = [], 0
    for end in common:
        mine = [",".join(str(i) for i, (s, e) in zip(ids, sp) if before <= s and e <= end) for ids, sp in zip((ids_a, ids_b), spans)]
        groups.append("|".join(mine))
        before = end
    links = [(x, y) for x, (s, e) in zip(ids_a, spans[0]) for y, (t, u) in zip(ids_b, spans[1]) if s < u and t < e]
    return len(ids_a), len(ids_b), ";".join(groups), links


def brute(libraries, rows):
    done = [(i, one(libraries, t)) for i, t in rows]
    count = Counter(p for _, d in done for p in set(d[3]))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for i, (n_a, n_b, groups, links) in done:
        n_best, total = sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links)
        out.append((i, n_a, n_b, groups.count("|") if groups else 0, len(links), n_best, total, groups))
    return sorted(out, key=repr)


def check(libraries, df, **sizes):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = ta.align_tokenizers(df, with_groups=True, **sizes).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    want = brute(libraries, rows)
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == want
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in got)
    return want


def test_gallop():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(2))
        want = [(a.index(x), b.index(x)) for x in sorted(set(a) & set(b))]
        assert ta.gallop(a, b) == want and ta.common_ends(a, b) == want


def test_odd_texts(spark, libraries):
    rng = random.Random(5)
    parts = ["the ", "a", " ", "  ", "\n", "\r\n", ";\r", "\t", "é", "日本", "'s", "12", "!?", "<|endoftext|>", "<s>", "<0x41>", "\0", "　", "Wordsmith", "́",
             "🎉", "\x1c", "\x85", "▁", "antidisestablishment", " (", "naïve"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = check(libraries, df, chunk_bytes=2_000)
    assert any("▁" in texts[r[0]] and r[1:] == (0, 0, 0, 0, 0, 0, "") for r in want) and sum(r[4] > r[3] for r in want) > 500


def test_whole_table(spark, libraries):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("n_chars < 4000")
    check(libraries, docs)
    check(libraries, docs.union(docs.limit(30)), chunk_bytes=10_000)


def test_odd_rows(spark, libraries, odd_docs, no_docs):
    short = odd_docs.where("text is null or length(text) < 1000")
    check(libraries, short)
    assert ta.align_tokenizers(no_docs).collect() == []
    long = odd_docs.where("length(text) > 100000")
    got = ta.align_tokenizers(long).orderBy("n_a").collect()
    for r, text in zip(got, sorted((r.text for r in long.collect()), key=len)):
        ids_a, ids_b, parts_a, parts_b = token_bytes(libraries, text)
        assert (r.n_a, r.n_b) == (len(ids_a), len(ids_b)) and r.count_sum >= r.n_links >= max(r.n_a, r.n_b)
    assert ta.align_tokenizers(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()[0][1:] == (0, 0, 0, 0, "", 0, 0)
