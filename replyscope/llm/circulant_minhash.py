"""Near-duplicates by circulant MinHash: two permutations make all coordinates; bands find candidates, sets confirm them."""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import components, keep, map_rows, small_batches

#: Universe that shingles are hashed into, coordinates, bands. At a similarity of 0.8 a pair shares none of the
#: 32 bands of 4 coordinates with probability 5e-8.
UNIVERSE, COORDINATES, BANDS = 1 << 20, 128, 32
#: Coordinates that two sets of similarity 0.8 or more agree in: 102 on average; below this many once in 10^7.
LEAST_EQUAL = 78
#: Rows of one block when a bucket's members are compared, and rounds of pivots before that.
BLOCK, PIVOT_ROUNDS = 512, 2
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Shingler:
    """Sets of hashed word shingles, their digests, signatures and band keys."""

    def __init__(self, width: int):
        random = np.random.default_rng(2024)
        self.width = width
        self.first = random.permutation(UNIVERSE).astype("i4")
        second = random.permutation(UNIVERSE).astype("i4")
        circle = np.concatenate([second, second[:COORDINATES]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)

    @staticmethod
    def hashes(words: list[bytes]) -> np.ndarray:
        """64-bit hashes; hashing a word anew takes less time than looking it up, and no memory."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype="u8", count=len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles; the whole sequence as one if it is shorter; empty without words."""
        words = (text or "").encode("utf-8").lower().split()  # on bytes: A-Z only; 0x20 and 0x09 to 0x0D
        if not words:
            return np.zeros(0, dtype="u8")
        h = self.hashes(words)
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, dtype="u8")
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * ODD[k % 4]
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def signature(self, found: np.ndarray) -> np.ndarray:
        """Coordinate k is the least value of the second permutation, shifted by k, at the places the first gives."""
        places = self.first[(found % np.uint64(UNIVERSE)).astype("i8")]
        best = np.full(COORDINATES, UNIVERSE, dtype="i4")
        for i in range(0, len(places), 8192):
            np.minimum(best, self.shifted[places[i : i + 8192]].min(axis=0), out=best)
        return best

    @staticmethod
    def bands(signature: np.ndarray) -> np.ndarray:
        rows = signature.reshape(BANDS, -1).astype("u8")
        out = np.arange(1, BANDS + 1, dtype="u8") * ODD[1]
        for k in range(rows.shape[1]):
            out = (out ^ rows[:, k]) * ODD[k % 4]
            out ^= out >> np.uint64(31)
        return out.view("i8")


_SHINGLERS: dict[int, Shingler] = {}


def shingler(width: int) -> Shingler:
    if width not in _SHINGLERS:
        _SHINGLERS[width] = Shingler(width)
    return _SHINGLERS[width]


def _digest(found: np.ndarray) -> bytes:
    return hashlib.md5(found.tobytes(), usedforsecurity=False).digest()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def features(docs: DataFrame, width: int, row_key: str | None = None) -> DataFrame:
    """doc_id, uid (the row key, else a number), mark (a hash of the text), n_shingles, digest of the set, band keys (null without words)."""

    def make():
        tool = shingler(width)

        def row(doc_id, uid, mark, text):
            found = tool.shingles(text)
            if len(found):
                yield doc_id, uid, mark, len(found), _digest(found), tool.bands(tool.signature(found)).tolist()
            else:
                yield doc_id, uid, mark, 0, None, None

        return row

    uid = F.col(f"`{row_key}`").cast("long") if row_key else F.monotonically_increasing_id()
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), uid.alias("uid"), F.xxhash64(text).alias("mark"), text.alias("text"))
    schema = "doc_id bigint, uid bigint, mark bigint, n_shingles bigint, digest binary, bands array<bigint>"
    return map_rows(narrow, make, schema, ["doc_id", "uid", "mark", "text"])


def candidate_sets(docs: DataFrame, wanted: DataFrame, width: int, row_key: str | None = None) -> DataFrame:
    """node, n, sig (a byte of each coordinate), set: of the classes in ``wanted`` (node, digest, home: a row key, else
    a doc_id, mark: the text's hash). A row meets the one class whose head has its id and its text, however often the id stands."""

    def make():
        tool = shingler(width)

        def row(node, digest, text):
            found = tool.shingles(text)
            if _digest(found) == digest:
                yield node, len(found), tool.signature(found).astype("u1").tobytes(), found.view("i8").tolist()

        return row

    text = F.col("text").cast("string")
    texts = docs.select(F.col(f"`{row_key or 'doc_id'}`").cast("long").alias("home"), F.xxhash64(text).alias("mark"), text.alias("text"))
    heads = wanted.select("node", "digest", F.col("home").alias("at_home"), F.col("mark").alias("at_mark"))
    same = F.col("home").eqNullSafe(F.col("at_home")) & (F.col("mark") == F.col("at_mark"))
    joined = texts.join(heads, same).select("node", "digest", "text")
    found = map_rows(joined, make, "node bigint, n bigint, sig binary, set array<bigint>", ["node", "digest", "text"])
    return found.dropDuplicates(["node"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""

    def make():
        def row(a, b, x, y, s, t):
            if np.count_nonzero(np.frombuffer(s, "u1") == np.frombuffer(t, "u1")) >= LEAST_EQUAL:
                if similar(np.array(x, dtype="i8").view("u8"), np.array(y, dtype="i8").view("u8"), percent):
                    yield a, b

        return row

    sizes = sets.select("node", "n")
    near = (
        pairs.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b")
    )
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("x"), F.col("sig").alias("s"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("y"), F.col("sig").alias("t"))
    return map_rows(near.join(one, "a").join(two, "b"), make, "a bigint, b bigint", ["a", "b", "x", "y", "s", "t"])


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets that still hold two components or more: key, node, label."""
    if labels is None:
        return members.select("key", "node", F.col("node").alias("label"))
    named = members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    open_keys = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    return named.join(keep(open_keys, "open"), "key")


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b: labels) between members of one bucket with different labels, all such pairs compared.

    Members outside the bucket's first component are compared with all members. Both sides are dealt into
    blocks; a task holds two blocks of sets, compares signatures first, and passes on which labels meet,
    never the pairs.
    """
    first = keep(members.groupBy("key").agg(F.min("label").alias("main"), F.count("*").alias("n")), "buckets")
    # a bucket's set of (node, label) that occurs in several bands is compared once
    told = members.join(first, "key")
    aside = told.where("label <> main")
    counts = keep(aside.groupBy("key").agg(F.count("*").alias("m")), "aside")
    deal = lambda n: F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / BLOCK)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / BLOCK).cast("int") - 1))
    told = told.join(counts, "key")
    base = told.select("key", "node", "label", deal("n").alias("i"), every("m").alias("j"), F.lit(False).alias("probe"))
    probes = told.where("label <> main").select("key", "node", "label", every("n").alias("i"), deal("m").alias("j"), F.lit(True).alias("probe"))
    cells = base.unionByName(probes).join(sets, "node")

    def compare(cell):
        base, probes = [r for r in cell if not r[0]], [r for r in cell if r[0]]
        if not base or not probes:
            return
        links: dict[int, int] = {}

        def root(x):
            while links.get(x, x) != x:
                x = links[x]
            return x

        sig = np.frombuffer(b"".join(r[3] for r in base), "u1").reshape(len(base), -1)
        n, labels = np.array([r[2] for r in base]), np.array([r[1] for r in base])
        for _, label, size, mine, found in probes:
            near = (sig == np.frombuffer(mine, "u1")).sum(axis=1) >= LEAST_EQUAL
            near &= (labels != label) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
            for k in np.flatnonzero(near):
                if root(label) != root(base[k][1]) and similar(found, base[k][4], percent):
                    yield label, base[k][1]
                    links[root(label)] = root(base[k][1])

    def run(batches):
        """Cells lie side by side in a task; one cell is held at a time."""
        import pyarrow as pa

        at, cell, out = None, [], []
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j")))
            rows = [batch.column(c).to_pylist() for c in ("probe", "label", "n", "sig")]
            held = batch.column("set")
            values, ends = held.values.to_numpy(), held.offsets.to_numpy()
            for k, place in enumerate(places):
                if place != at:
                    out.extend(compare(cell))
                    at, cell = place, []
                cell.append((*(r[k] for r in rows), values[ends[k] : ends[k + 1]]))
            yield links_of(pa, out)
            out = []
        yield links_of(pa, list(compare(cell)))

    def links_of(pa, out):
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], type=pa.int64()) for c in (0, 1)], names=["a", "b"])

    small_batches(members.sparkSession)
    place = ["key", "i", "j"]
    return cells.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a bigint, b bigint")


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of nodes after linking labels."""
    roots = keep(components(links), "roots")
    if labels is None:
        return roots
    moved = labels.join(roots.select(F.col("node").alias("old"), F.col("component").alias("new")), labels["component"] == F.col("old"), "left")
    known = moved.select("node", F.coalesce("new", "component").alias("component"))
    fresh = roots.join(labels.select("node"), "node", "left_anti")
    return keep(known.unionByName(fresh), "labels")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, pivot_rounds: int = PIVOT_ROUNDS, row_key: str | None = None
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id linked directly or not), kept.

    Documents are linked if their sets of distinct ``width``-word shingles have a Jaccard similarity of
    ``percent`` or more. Equal sets become one class first, whatever their number. Classes that share a
    band of the circulant signature are candidates. In each bucket the members are held against one
    pivot, then, while a bucket still holds several components, against other pivots, and at last every
    pair of members of different components is compared in blocks; so no link between components that
    meet in a bucket is lost, and no group is written out as pairs. All links are confirmed on full sets.

    Texts shorter than a shingle are one shingle; null texts and texts without words are linked with
    nothing. Rows that repeat a doc_id are rows of their own, linked by their texts; kept compares ids, so of exactly
    repeated rows all or none are kept. A null doc_id gets the smallest id of its component, else null, and is kept
    only if that is null. Other columns are ignored; an empty table gives no rows.

    ``row_key`` names a column of distinct numbers, stored with ``docs``. It is then returned too, and exactly one row of
    each component is kept: the one with the smallest doc_id (null last), then row key.
    """
    found = keep(features(docs, width, row_key), "features")
    worded = found.where("n_shingles > 0")
    classes = keep(worded.groupBy("digest").agg(F.min("uid").alias("node")), "classes")
    heads = keep(
        worded.join(classes.select("node", F.col("digest").alias("d")), (F.col("uid") == F.col("node")) & (F.col("digest") == F.col("d")))
        .select("node", "digest", F.col("uid" if row_key else "doc_id").alias("home"), "mark", "bands"),
        "heads",
    )
    buckets = heads.select("node", F.explode("bands").alias("key"))
    shared = keep(buckets.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1"), "shared")
    members = keep(buckets.join(shared, "key").select("key", "node", "size", "pivot"), "members")
    wanted = heads.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest", "home", "mark")
    sets = keep(candidate_sets(docs, wanted, width, row_key), "sets")

    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    labels = _joined(None, keep(confirm(pairs, sets, percent), "links"))
    members = members.where("size > 2")  # the only pair of a bucket of two is decided
    rest = keep(labelled(members, labels), "open-members")
    for k in range(pivot_rounds):
        if not rest.take(1):
            break
        pick = F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("order"), "node", "label"))
        pivots = keep(rest.groupBy("key").agg(pick.alias("p")).select("key", "p.node", "p.label"), "pivots")
        against = rest.join(pivots.select("key", F.col("node").alias("a"), F.col("label").alias("la")), "key")
        pairs = against.where("label <> la").select("a", F.col("node").alias("b")).distinct()
        links = keep(confirm(pairs, sets, percent), "links")
        named = _relabel(links, labels)
        labels = _joined(labels, named)
        rest = keep(labelled(members.join(rest.select("key").distinct(), "key", "left_semi"), labels), "open-members")
    if rest.take(1):
        labels = _joined(labels, keep(block_links(rest, sets, percent), "links"))

    placed = found.join(classes, "digest", "left").join(labels, "node", "left").select(
        "doc_id", "uid", "n_shingles", F.coalesce("component", "node", F.col("uid")).alias("label")
    )
    placed = keep(placed, "placed")
    if row_key:
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first")
        heads = keep(placed.groupBy("label").agg(F.min("doc_id").alias("component_id"), first), "least")
        return placed.join(heads, "label").select(
            F.col("uid").alias(row_key), "doc_id", "n_shingles", "component_id", (F.col("uid") == F.col("first.uid")).alias("kept")
        )
    least = keep(placed.groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    same: Column = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())
    return placed.join(least, "label").select("doc_id", "n_shingles", "component_id", same.alias("kept"))


def _relabel(links: DataFrame, labels: DataFrame) -> DataFrame:
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
