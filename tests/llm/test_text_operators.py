"""Packing, token counts, automaton, license scan, shards and line dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from replyscope.llm import bpe_automaton, encoding, histogram_shards, license_scan, line_windows, packing, token_counts

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(encoding.default_tokenizer())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_encoder_equals_library(library):
    rng = random.Random(5)
    parts = ["the ", "a", " ", "  ", "\n", "\r\n", "\t", "é", "日本", "'s", "12", "!?", "<|endoftext|>", "\0", "　", "Word", "́", "🎉"]
    fast, own = encoding.TextEncoder(encoding.default_tokenizer()), bpe_automaton.tokenizer(encoding.default_tokenizer())
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = library.encode(text, add_special_tokens=False).ids
        assert fast.ids(text).tolist() == want, text
        assert own.encode(text) == want, text
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_gadgets_equal_merging_in_order():
    """Small random merge lists over three letters: the accepted path is what applying the merges leaves."""
    rng = random.Random(3)
    for _ in range(60):
        names, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 9)):
            u, v = rng.choice(names), rng.choice(names)
            if u + v not in names:
                merges.append((names.index(u), names.index(v), len(names)))
                names.append(u + v)
        made = bpe_automaton.MergeAutomaton(len(names), merges)
        tool = bpe_automaton.AutomatonTokenizer.__new__(bpe_automaton.AutomatonTokenizer)
        tool.automaton, tool.labels = made, [x.encode() for x in names]
        tool.arcs = {x.encode(): i for i, x in enumerate(names) if made.alive[i]}
        tool.longest = max(map(len, tool.arcs))
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            ids = [names.index(c) for c in word]
            for u, v, w in merges:
                out, k = [], 0
                while k < len(ids):
                    hit = ids[k : k + 2] == [u, v]
                    out.append(w if hit else ids[k])
                    k += 2 if hit else 1
                ids = out
            assert tool.word_ids(word.encode()) == ids, (word, merges)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_automaton_query(spark, request, library, which):
    df = request.getfixturevalue(which)
    want = Counter()
    for doc_id, text in texts_of(df):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe_automaton.encode_and_decode(df).collect()) == want


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_packing(spark, request, library, which):
    df = request.getfixturevalue(which)
    rows = packing.pack(df, with_ids=True).collect()
    held, sequences = defaultdict(list), set()
    for r in rows:
        held[r.doc_id].append(r)
        assert r.offset == 0 and r.length == len(r.ids) <= 1024 and r.length & (r.length - 1) == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        sequences.add(r.sequence_id)
    assert sequences == set(range(len(rows)))
    assert [r.length for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted((r.length for r in rows), reverse=True)
    want = defaultdict(list)
    for doc_id, text in texts_of(df):
        want[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    assert held.keys() == want.keys()
    for doc_id, lists in want.items():
        for ids in {tuple(x) for x in lists}:
            mine = sorted({(r.start, tuple(r.ids)) for r in held[doc_id] if r.doc_tokens == len(ids)})
            assert [i for _, part in mine for i in part] == list(ids)
        assert sum(r.length for r in held[doc_id]) == sum(map(len, lists))


def test_token_counts(spark, docs, odd_docs, library):
    for df in (docs.where("n_chars < 3000"), odd_docs.where("text is null or length(text) < 3000")):
        want = Counter()
        for doc_id, text in texts_of(df):
            if not text:
                want[doc_id, 0, 0, 0, 0, 0] += 1
                continue
            borders = [0, *(i + 1 for i, c in enumerate(text) if c == "\n")]
            borders = [*[b for b in borders if b < len(text)], len(text)]
            n, cross = [0] * (len(borders) - 1), [0] * (len(borders) - 1)
            done = library.encode(text, add_special_tokens=False)
            at, data, lengths = 0, text.encode(), [len(library.decode([i], skip_special_tokens=False).encode()) for i in done.ids]
            if sum(lengths) != len(data):
                lengths = [len(bpe_automaton.tokenizer(encoding.default_tokenizer()).labels[i]) for i in done.ids]
            for size in lengths:
                a = len(data[:at].decode(errors="ignore"))
                b = len(data[: at + size].decode(errors="ignore"))
                b += data[: at + size].decode(errors="ignore").encode() != data[: at + size]
                at += size
                held = [max(0, min(b, borders[k + 1]) - max(a, borders[k])) for k in range(len(n))]
                n[held.index(max(held))] += 1
                touched = [k for k, x in enumerate(held) if x]
                for k in touched if len(touched) > 1 else []:
                    cross[k] += 1
            for k in range(len(n)):
                want[doc_id, k, borders[k], borders[k + 1], n[k], cross[k]] += 1
        assert Counter(tuple(r) for r in token_counts.section_token_counts(df).collect()) == want
    totals = {r.doc_id: r.n for r in token_counts.section_token_counts(docs).groupBy("doc_id").agg({"n_tokens": "sum"}).toDF("doc_id", "n").collect()}
    assert totals == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts_of(docs)}


def test_license_scan(spark, docs, odd_docs):
    for df in (docs, odd_docs):
        got = {}
        for r in license_scan.scan_licenses(df).collect():
            got.setdefault(r.doc_id, []).append(r)
        for doc_id, text in texts_of(df):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
            places, base = [], set()
            for phrase, label in license_scan.PHRASES.items():
                p = phrase.split()
                hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
                places += hits
                base |= {label} if hits else set()
            fuzzy = {n.label for n in license_scan.NOTICES if len(low) < 2_000 and regex.search(f"(?:{regex.escape(n.text)}){{e<={n.errors}}}", low)}
            r = got[doc_id][0]
            assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted(base)))
            assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
            if len(low) < 2_000:
                assert r.labels == ",".join(sorted(base | fuzzy))
            assert (r.score == 1) == bool(places) or r.score <= 1


def test_license_edits_are_found(spark):
    texts = ["xx Licenced undr the Apache Licence, Version 2.0 yy", "Released under teh MIT License", "Licensed under CC BY-NC 4.0", "nothing here"]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["apache", "mit", "cc-by-nc", ""]
    assert rows[0].n_base == 0 and 0.9 < rows[0].score < 1 and rows[0].spans == ["apache:3-48:3"] and rows[3].score == 0


def check_shards(df, shards=40, tolerance=0.001):
    rows = histogram_shards.shard_documents(df, shards, tolerance).collect()
    texts = texts_of(df)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, max((r.size for r in rows), default=0), sum(r.size for r in rows) / shards


def test_shards(spark, docs, odd_docs, no_docs):
    sizes, largest, mean = check_shards(docs, 5)
    assert all(abs(sizes[k] - mean) <= largest + 0.01 * mean for k in range(5))
    check_shards(odd_docs, 4)
    check_shards(no_docs)
    hot = spark.range(9000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'the same text' else concat('text ', id) end as text")
    sizes, largest, mean = check_shards(hot)
    assert max(abs(sizes[k] - mean) for k in range(40)) <= largest + 0.002 * mean


def test_shards_of_one_repeated_row(spark):
    """A third of the rows are one row: all 40 shards are near-equal all the same, in one exchange along the splitters."""
    rows = spark.range(9000).selectExpr(
        "case when id % 3 = 0 then 7 else id end as doc_id", "case when id % 3 = 0 then 'one repeated row' else concat('text ', id) end as text",
        "1 as _piece", "2 as slot",
    )
    sizes, largest, mean = check_shards(rows.select("doc_id", "text"), 40)
    assert len(sizes) == 40 and max(abs(sizes[k] - mean) for k in range(40)) <= largest + 0.002 * mean
    many = histogram_shards.shard_by_bytes(rows, F.lit(10), histogram_shards.sort_key(F.col("text")), shards=3)
    assert many.columns == ["doc_id", "text", "_piece", "shard", "slot"] and many.where("_piece <> 1").count() == 0
    found = {r.shard: r["count"] for r in many.groupBy("shard").count().collect()}
    assert sorted(found) == [0, 1, 2] and all(abs(n - 3000) <= 3 for n in found.values())


def test_shards_in_pieces(spark, docs, monkeypatch):
    monkeypatch.setattr(histogram_shards, "PIECE_ROWS", 7)
    sizes, largest, mean = check_shards(docs, 5)
    assert all(abs(sizes[k] - mean) <= largest + 0.01 * mean for k in range(5))


def brute_lines(rows):
    """rows: (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out[doc_id] = (0, 0, None)
            continue
        lines = text.split("\n")
        spoken = [(k, x.strip(" \t\r\x0b\x0c")) for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for k in range(len(spoken) - 2):
            body = tuple(x for _, x in spoken[k : k + 3])
            if body in seen:
                gone |= set(range(spoken[k][0], spoken[k + 2][0] + 1))
            seen.add(body)
        out[doc_id] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_windows(spark, docs, odd_docs, no_docs):
    made = [(i, "\n".join(random.Random(i).choice(["red fox", "blue sky", "", " green ", "grass"]) for _ in range(i % 17))) for i in range(60)]
    frames = [docs, spark.createDataFrame(made, "doc_id long, text string"), odd_docs.dropDuplicates(["doc_id"])]
    for df in frames:
        got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_windows.drop_repeated_windows(df, report=True).collect()}
        assert got == brute_lines(texts_of(df))
    plain = line_windows.drop_repeated_windows(odd_docs)
    assert plain.columns == odd_docs.columns and plain.count() == odd_docs.count()
    assert line_windows.drop_repeated_windows(no_docs).count() == 0


def test_line_windows_with_any_names_and_repeated_rows(spark):
    body = "a b\nc d\ne f\ng"
    rows = [(1, body, "x", 5, 1)] * 3 + [(2, "q\n" + body, "y", 6, 2), (None, "a b\nc d", None, None, None)]
    names = ["doc_id", "text", "runs", "_row", "n_removed"]
    got = line_windows.drop_repeated_windows(spark.createDataFrame(rows, names))
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, body, "x", 5, 1), (1, "", "x", 5, 1), (1, "", "x", 5, 1), (2, "q", "y", 6, 2), (None, "a b\nc d", None, None, None)], key=repr
    )
    told = line_windows.drop_repeated_windows(spark.createDataFrame(rows, names), report=True).collect()
    assert sorted(r.n_removed for r in told) == [0, 0, 4, 4, 4]


def test_line_statement(spark, docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = Counter(con.execute(f"SELECT doc_id, n_lines, n_removed, text FROM ({line_windows.SQL})").fetchall())
    assert Counter(tuple(r) for r in line_windows.drop_repeated_windows(docs, report=True).select("doc_id", "n_lines", "n_removed", "text").collect()) == want


def test_empty_tables(spark, no_docs):
    assert packing.pack(no_docs).count() == 0
    assert token_counts.section_token_counts(no_docs).count() == 0
    assert bpe_automaton.encode_and_decode(no_docs).count() == 0
    assert license_scan.scan_licenses(no_docs).count() == 0
