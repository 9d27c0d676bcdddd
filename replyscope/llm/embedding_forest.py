"""Embedding near-dedup by a forest of random-projection trees with spill, compared within leaves."""

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import components, keep, map_rows

#: Trees, vectors compared at once, share of a node that goes to both sides, vectors the tree tops are fitted on,
#: and vectors of a cell that one task splits further.
TREES, LEAF, SPILL, SAMPLE, CELL = 10, 256, 0.06, 16_000, 4_096
#: Dense balls sought in the sample: most, and their least share of it.
BALLS, BALL_SHARE = 64, 0.01
#: Wide groups sought in the sample: most, and about so many vectors of the table within the linking angle of one; rows
#: and columns of a block when such a group is compared wholly; vectors of a dense node that is not split further.
WIDE_BALLS, WIDE, BLOCK, WHOLE = 1024, 600, 4_096, 2_048


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype="f8")
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _matrix(column) -> np.ndarray:
    return unit(np.vstack([np.asarray(v, dtype="f8") for v in column]))


class TreeTop:
    """The first levels of one tree, fitted on a bounded sample: each node cuts at the median of a random projection
    and sends what lies near the cut to both sides."""

    def __init__(self, sample: np.ndarray, levels: int, seed: int, spill: float):
        self.levels = levels
        random = np.random.default_rng(seed)
        self.direction = random.standard_normal((2**levels - 1, sample.shape[1])) if levels else np.zeros((0, sample.shape[1]))
        self.low, self.middle, self.high = (np.zeros(2**levels - 1) for _ in range(3))
        held = {0: np.arange(len(sample))}
        for node in range(2**levels - 1):
            rows = held.pop(node)
            at = sample[rows] @ self.direction[node]
            if len(at):
                self.low[node], self.middle[node], self.high[node] = np.quantile(at, [0.5 - spill, 0.5, 0.5 + spill])
            held[2 * node + 1], held[2 * node + 2] = rows[at <= self.high[node]], rows[at >= self.low[node]]

    def cells(self, x: np.ndarray, spill: bool) -> list[tuple[int, np.ndarray]]:
        """Row numbers of each cell; without spill every row has one cell."""
        held = {0: np.arange(len(x))}
        for node in range(2**self.levels - 1):
            rows = held.pop(node)
            at = x[rows] @ self.direction[node]
            left = at <= (self.high if spill else self.middle)[node]
            right = at >= self.low[node] if spill else ~left
            held[2 * node + 1], held[2 * node + 2] = rows[left], rows[right]
        return [(cell, rows) for cell, rows in held.items() if len(rows)]


def leaves(x: np.ndarray, random: np.random.Generator, spill: float, leaf: int, near: float = 2.0) -> list[np.ndarray]:
    """Row numbers of the leaves below one cell; splits go by rank, so equal projections are parted too. A node of at
    most WHOLE rows in which some row has over an eighth of a leaf of others at a cosine of ``near`` is a leaf too."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        if near <= 1 and len(rows) <= WHOLE:
            probes = x[rows[:: max(1, len(rows) // 64)]]
            if ((probes @ x[rows].T) >= near).sum(axis=1).max() > leaf / 8:
                out.append(rows)
                continue
        order = rows[np.argsort(x[rows] @ random.standard_normal(x.shape[1]), kind="stable")]
        more, half = int(len(rows) * spill), len(rows) // 2
        todo += [order[: half + more], order[half - more :]]
    return out


def dense_balls(sample: np.ndarray, near: float) -> np.ndarray:
    """Centres around which at least a hundredth of the sample lies, densest first."""
    some, centres = sample[:4000], []
    least = max(8, math.ceil(BALL_SHARE * len(some)))
    while len(centres) < BALLS and len(some) >= least:
        close = (some.astype("f4") @ some.astype("f4").T) >= near
        counts = close.sum(axis=1)
        k = int(np.argmax(counts))
        if counts[k] < least:
            break
        centre = unit(some[close[k]].mean(axis=0)).astype("f4").astype("f8")
        centres.append(centre)
        some = some[~close[k] & (some @ unit(centre) < near)]
    return np.array(centres).reshape(-1, sample.shape[1])


def wide_balls(sample: np.ndarray, cosine: float, least: int) -> np.ndarray:
    """Centres of groups of which one member has at least ``least`` of the sample within the linking angle."""
    some, centres = sample.astype("f4"), []

    def count(a, b):
        return np.concatenate([np.zeros(0, "i8"), *(((a[i : i + 500] @ b.T) >= cosine).sum(axis=1) for i in range(0, len(a), 500))])

    counts = count(some, some)
    while len(centres) < WIDE_BALLS and len(some) and counts.max() >= least:
        k = int(np.argmax(counts))
        centre = unit(some[(some @ some[k]) >= cosine].mean(axis=0))
        gone = (some @ centre.astype("f4")) >= cosine
        gone[k] = True
        centres.append(centre)
        counts, some = counts[~gone] - count(some[~gone], some[gone]), some[~gone]
    return np.array(centres).reshape(-1, sample.shape[1])


def _angle(x: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x, -1.0, 1.0))


class _Links:
    """The work on vectors of one dimension: node (long), vec (array<float>), copies (long)."""

    def __init__(self, reps: DataFrame, n: int, cosine: float, trees: int, seed: int):
        self.reps, self.n, self.cosine, self.trees, self.seed = reps, n, cosine, trees, seed
        self.theta = math.acos(cosine)
        self.radius = 0.4985 * self.theta  # two vectors this near to one centre are linked for sure
        rows = reps.where(F.pmod(F.xxhash64("node"), F.lit(n)) < SAMPLE).orderBy(F.xxhash64("node")).limit(2 * SAMPLE).select("vec").collect()
        if not rows:  # a hash may choose none of a few
            rows = reps.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").collect()
        self.sample = _matrix([r.vec for r in rows])
        near = math.cos(self.radius)
        self.balls = dense_balls(self.sample, near)
        apart = self.sample[(self.sample @ unit(self.balls).T).max(axis=1) < near] if len(self.balls) else self.sample
        apart = apart[:SAMPLE]
        self.wide = wide_balls(apart, cosine, max(8, math.ceil(WIDE * len(self.sample[:SAMPLE]) / max(n, 1))))

    def _levels(self, n: int) -> int:
        wanted = math.ceil(math.log2(max(n / CELL, 1)))
        return max(0, min(wanted, int(math.log2(max(len(self.sample) / 32, 1)))))

    def classes(self) -> DataFrame:
        """node, class, angle to the class's centre, centre, wide: sets of vectors within half the linking angle of one
        centre, all linked with each other. Dense balls of the sample take their vectors without any comparison; the
        others are grouped inside the leaves of one tree without spill. Vectors of a wide ball (wide: its number, else -1)
        are classes of their own."""
        balls, near, wide, cosine = self.balls, math.cos(self.radius), self.wide, self.cosine
        top = TreeTop(self.sample, self._levels(self.n), self.seed, 0.0)

        def place(batches):
            import pandas as pd

            for rows in batches:
                x = _matrix(rows["vec"]) if len(rows) else np.zeros((0, top.direction.shape[1]))
                cell = np.zeros(len(rows), dtype="i8")
                for number, held in top.cells(x, spill=False):
                    cell[held] = number
                ball, angle = np.full(len(rows), -1, dtype="i8"), np.zeros(len(rows))
                if len(balls) and len(rows):
                    dots = x @ unit(balls).T
                    best = dots.argmax(axis=1)
                    inside = dots[np.arange(len(rows)), best] >= near
                    ball[inside] = best[inside]
                    angle[inside] = _angle(dots[np.arange(len(rows)), best])[inside]
                group = np.full(len(rows), -1, dtype="i8")
                if len(wide) and len(rows):
                    dots = x @ wide.T
                    best = dots.argmax(axis=1)
                    inside = (ball < 0) & (dots[np.arange(len(rows)), best] >= cosine)
                    group[inside] = best[inside]
                yield pd.DataFrame({
                    "node": rows["node"], "vec": rows["vec"], "copies": rows["copies"], "cell": cell, "ball": ball, "angle": angle, "wide": group,
                })

        def group(rows):
            import pandas as pd

            x, nodes = _matrix(rows["vec"]), rows["node"].to_numpy()
            home, angle = np.full(len(rows), -1, dtype="i8"), np.zeros(len(rows))
            random = np.random.default_rng(5)
            order = np.argsort(nodes, kind="stable")
            for held in leaves(x[order], random, 0.0, LEAF):
                held = order[held]
                dots = x[held] @ x[held].T
                close = dots >= near
                free = np.ones(len(held), dtype=bool)
                while free.any():
                    counts = (close & free).sum(axis=1) * free
                    k = int(np.argmax(counts))
                    if counts[k] < 2:
                        break
                    taken = close[k] & free
                    taken[k] = True
                    home[held[taken]], angle[held[taken]] = held[k], _angle(dots[k][taken])
                    angle[held[k]] = 0.0
                    free &= ~taken
                alone = held[free]
                home[alone] = alone
            return pd.DataFrame({"node": nodes, "class": nodes[home], "angle": angle, "centre": rows["vec"].to_numpy()[home]})

        placed = keep(
            self.reps.mapInPandas(place, f"node long, vec {self.reps.schema['vec'].dataType.simpleString()}, copies long, cell long, ball long, angle double, wide long"), "placed"
        )
        within = placed.where("ball >= 0")
        centres = self.reps.sparkSession.createDataFrame(
            [(i, [float(v) for v in c]) for i, c in enumerate(balls)], "ball long, centre array<float>"
        )
        names = keep(within.groupBy("ball").agg(F.min("node").alias("class")), "balls").join(centres, "ball")
        dense = within.join(F.broadcast(names), "ball").select("node", "class", "angle", "centre")
        loose = placed.where("ball < 0 and wide < 0").groupBy("cell").applyInPandas(group, "node long, class long, angle double, centre array<float>")
        single = placed.where("wide >= 0").select("node", F.col("node").alias("class"), F.lit(0.0).alias("angle"), F.col("vec").alias("centre"), "wide")
        grouped = dense.unionByName(loose).withColumn("wide", F.lit(-1).cast("long"))
        return keep(grouped.unionByName(single), "classes")

    def wide_links(self, heads: DataFrame) -> DataFrame:
        """All links of the classes in wide balls, every pair compared once a side, in blocks spread over tasks; pairs of
        single vectors never leave a block. kind 0: ``n`` more links of class ``a``; 1: ``a`` and ``b`` are connected;
        2 and 3: the class ``b`` of more angles may hold links of ``a``, or is linked with it wholly.

        A link of a member of a ball ends within twice the linking angle of its centre: such classes are the ball's columns.
        """
        wide, theta, cosine = self.wide, self.theta, self.cosine

        def place(batches):
            import pandas as pd

            for rows in batches:
                if not len(rows):
                    continue
                angle = _angle(_matrix(rows["centre"]) @ wide.T)
                home = rows["wide"].to_numpy()
                for ball in range(len(wide)):
                    column = angle[:, ball] <= 2 * theta + rows["radius"].to_numpy() + 1e-6
                    for probe, held in ((True, home == ball), (False, column)):
                        if held.any():
                            yield rows[held].assign(ball=ball, probe=probe)[["ball", "probe", "class", "centre", "radius", "size", "wide"]]

        def compare(rows):
            import pandas as pd

            one, two = rows[rows["probe"]], rows[~rows["probe"]]
            out = {k: [] for k in ("kind", "a", "b", "n")}

            def tell(kind, a, b, n):
                for k, v in zip(out, (np.full(len(a), kind), a, b, n)):
                    out[k].append(np.asarray(v, dtype="i8"))

            if len(one) and len(two):
                x, y, a, b = _matrix(one["centre"]), _matrix(two["centre"]), one["class"].to_numpy(), two["class"].to_numpy()
                radius, copies, weight = two["radius"].to_numpy(), one["size"].to_numpy(), two["size"].to_numpy()
                flat, joined = np.flatnonzero(radius == 0), np.flatnonzero(radius > 0)
                component = np.arange(len(flat))
                back = np.zeros(len(flat), dtype="i8")
                for at in range(0, len(x), 256):
                    part = slice(at, at + 256)
                    dots = x[part] @ y.T
                    link = (dots[:, flat] >= cosine) & (a[part][:, None] != b[flat][None, :])
                    more = link.astype("f8") @ weight[flat].astype("f8")
                    some = more > 0
                    tell(0, a[part][some], a[part][some], more[some])
                    back += (copies[part].astype("f8") @ link).astype("i8")
                    for k in np.flatnonzero(some):
                        met = component[link[k]]
                        low = met.min()
                        tell(1, [a[at + k]], [b[flat[low]]], [0])
                        others = np.unique(met[met != low])
                        if len(others):
                            tell(1, np.full(len(others), b[flat[low]]), b[flat[others]], np.zeros(len(others)))
                            component[np.isin(component, others)] = low
                    if len(joined):
                        angle = _angle(dots[:, joined])
                        for i, j in zip(*np.nonzero(angle <= theta + radius[joined] + 1e-9)):
                            sure = angle[i, j] + radius[joined[j]] <= theta - 1e-9
                            tell(3 if sure else 2, [a[at + i]], [b[joined[j]]], [0])
                guests = (back > 0) & (two["wide"].to_numpy()[flat] < 0)  # members of a ball count for themselves
                tell(0, b[flat][guests], b[flat][guests], back[guests])
            return pd.DataFrame({k: np.concatenate([np.zeros(0, "i8"), *v]) for k, v in out.items()})

        dealt = keep(
            heads.mapInPandas(place, "ball long, probe boolean, class long, centre array<float>, radius double, size long, wide long"), "wide"
        )
        sizes = dealt.groupBy("ball").agg(
            F.ceil(F.count_if("probe") / BLOCK).cast("int").alias("n"), F.ceil(F.count_if(~F.col("probe")) / BLOCK).cast("int").alias("m")
        ).where("n > 0")
        told = dealt.join(F.broadcast(sizes), "ball")
        deal = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows = told.where("probe").select(*dealt.columns, deal("n").alias("i"), every("m").alias("j"))
        columns = told.where("not probe").select(*dealt.columns, every("n").alias("i"), deal("m").alias("j"))
        blocks = rows.unionByName(columns).groupBy("ball", "i", "j")
        return keep(blocks.applyInPandas(compare, "kind long, a long, b long, n long"), "wide-links")

    def class_pairs(self, heads: DataFrame, n: int) -> DataFrame:
        """Pairs of classes (a < b) that are linked wholly (sure) or may hold links, found in common leaves."""
        tops = [TreeTop(self.sample, self._levels(n), self.seed + 1 + t, SPILL) for t in range(self.trees)]
        theta, cosine, seed = self.theta, self.cosine, self.seed

        def place(batches):
            import pandas as pd

            for rows in batches:
                if len(rows):
                    x = _matrix(rows["centre"])
                    for t, top in enumerate(tops):
                        for cell, held in top.cells(x, spill=True):
                            yield pd.DataFrame({"tree": t, "cell": cell, "class": rows["class"].to_numpy()[held], "centre": rows["centre"].to_numpy()[held], "radius": rows["radius"].to_numpy()[held]})

        def compare(rows):
            import pandas as pd

            rows = rows.sort_values("class")
            x, names, radius = _matrix(rows["centre"]), rows["class"].to_numpy(), rows["radius"].to_numpy()
            random = np.random.default_rng([seed, int(rows["tree"].iloc[0]), int(rows["cell"].iloc[0])])
            found = []
            for held in leaves(x, random, SPILL, LEAF, cosine):
                dots = x[held] @ x[held].T
                reach = radius[held][:, None] + radius[held][None, :]
                single = reach == 0
                close = np.where(single, dots >= cosine, dots >= np.cos(np.minimum(theta + reach + 1e-9, np.pi)))
                i, j = np.nonzero(np.triu(close, 1))
                sure = single[i, j] | (_angle(dots[i, j]) + reach[i, j] <= theta - 1e-9)
                a, b = names[held[i]], names[held[j]]
                told = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "sure": sure})
                found.append(told[told["a"] != told["b"]])
            return pd.concat(found).groupby(["a", "b"], as_index=False)["sure"].max().astype({"a": "i8", "b": "i8", "sure": bool})

        dealt = heads.mapInPandas(place, "tree long, cell long, class long, centre array<float>, radius double")
        cells = dealt.groupBy("tree", "cell").applyInPandas(compare, "a long, b long, sure boolean")
        return keep(cells.groupBy("a", "b").agg(F.max("sure").alias("sure")), "class-pairs")

    def run(self) -> DataFrame:
        """node, links (rows linked with it, itself not counted), label (component)."""
        classes = self.classes()
        sized = classes.join(self.reps.select("node", "copies", "vec"), "node")
        members = keep(sized.select("node", "class", "angle", "copies", "vec"), "members")
        sizes = members.groupBy("class").agg(F.sum("copies").alias("size"), F.max("angle").alias("radius"))
        heads = keep(sizes.join(classes.groupBy("class").agg(F.first("centre").alias("centre"), F.first("wide").alias("wide")), "class"), "heads")
        rest = heads.where("wide < 0")
        pairs = self.class_pairs(rest, rest.count())
        told = None
        if len(self.wide):
            told = self.wide_links(heads)
            pairs = pairs.unionByName(told.where("kind >= 2").select("a", "b", (F.col("kind") == 3).alias("sure")))
        size = heads.select("class", "size")
        both = pairs.where("sure").select("a", "b").unionByName(pairs.where("sure").select(F.col("b").alias("a"), F.col("a").alias("b")))
        more = both.join(size.select(F.col("class").alias("b"), "size"), "b").select("a", F.col("size").alias("n"))
        if told is not None:
            more = more.unionByName(told.where("kind = 0").select("a", "n"))
        whole = more.groupBy("a").agg(F.sum("n").alias("more")).select(F.col("a").alias("class"), "more")
        side = members.select("class", "node", "copies", F.col("vec").cast("array<double>").alias("vec"))
        one = side.select(F.col("class").alias("a"), F.col("node").alias("m"), F.col("copies").alias("cm"), F.col("vec").alias("x"))
        two = side.select(F.col("class").alias("b"), F.col("node").alias("k"), F.col("copies").alias("ck"), F.col("vec").alias("y"))
        length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v))
        cosine = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) / length("x") / length("y")
        single = keep(
            pairs.where("not sure").join(one, "a").join(two, "b").where(cosine >= self.cosine).select("a", "b", "m", "k", "cm", "ck"),
            "single-links",
        )
        apart = single.select(F.col("m").alias("node"), F.col("ck").alias("n")).unionByName(
            single.select(F.col("k").alias("node"), F.col("cm").alias("n"))
        ).groupBy("node").agg(F.sum("n").alias("apart"))
        met = pairs.where("sure").select("a", "b").unionByName(single.select("a", "b").distinct())
        labels = components(met if told is None else met.unionByName(told.where("kind = 1").select("a", "b")))
        labels = keep(labels.select(F.col("node").alias("class"), "component"), "labels")
        return (
            members.select("node", "class").join(size, "class").join(whole, "class", "left").join(labels, "class", "left")
            .join(apart, "node", "left")
            .select(
                "node", (F.col("size") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("apart", F.lit(0))).alias("links"),
                F.coalesce("component", "class").alias("label"),
            )
        )


def in_range(vector: list[float]) -> list[float]:
    """The vector, times a power of two if its squares would leave the range of doubles: its direction is the same."""
    power = math.frexp(max(map(abs, vector)))[1]
    return vector if abs(power) < 300 else [math.ldexp(v, -power) for v in vector]


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = 0.9, trees: int = TREES, id_column: str = "vec_id", vector_column: str = "embedding", seed: int = 11
) -> DataFrame:
    """Per vector: the id, n_links (other rows linked directly), component_id (smallest id reachable), kept.

    Vectors of equal length are linked at a cosine of ``cosine`` or more, in double precision. Equal vectors are
    taken together first. Vectors within half the linking angle of one centre form a class, all linked by the
    triangle rule, so large groups need no pairs. Class centres go down a forest of random-projection trees with
    spill; the tree tops are fitted on about 16,000 vectors, every vector is placed, and a task splits a cell on
    down to leaves of 256, or of 2,048 where a node stays dense. Groups of which the sample shows some 600 members or more
    within the linking angle of one are compared wholly instead, with all vectors within twice that angle, block by block:
    only counts and which classes are connected leave a block. Classes in one leaf are linked wholly if their angles and radii prove it, ruled out if they
    exclude it, and else compared vector by vector. Null, zero and non-finite vectors are linked with nothing.
    Repeated rows are rows of their own; a null id counts as a row and takes the smallest id of its component; other
    columns are ignored; an empty table gives no rows.
    """

    def make():
        def row(name, vector):
            ok = vector is not None and len(vector) > 0 and all(v is not None and math.isfinite(v) for v in vector)
            ok = ok and any(v != 0 for v in vector)
            yield name, in_range([float(v) for v in vector]) if ok else None, len(vector) if ok else 0

        return row

    kind = "array<float>" if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else "array<double>"
    named = vectors.select(F.col(id_column).cast("long").alias("name"), F.col(vector_column).cast(kind).alias("vector"))
    base = keep(
        map_rows(named, make, f"name bigint, vec {kind}, size int", ["name", "vector"]).withColumn("uid", F.monotonically_increasing_id()),
        "vectors",
    )
    valid = base.where("size > 0").withColumn("digest", F.unhex(F.md5(F.to_json("vec").cast("binary"))))
    copies = keep(valid.groupBy("size", "digest").agg(F.min("uid").alias("node"), F.count("*").alias("copies")), "copies")
    reps = keep(
        valid.select("uid", "vec", F.col("digest").alias("d")).join(copies, (F.col("uid") == F.col("node")) & (F.col("d") == F.col("digest")))
        .select("node", "vec", "copies", "size"),
        "distinct",
    )
    done = None
    for size, n in sorted(tuple(r) for r in reps.groupBy("size").count().collect()):
        part = _Links(reps.where(F.col("size") == size).drop("size"), n, cosine, trees, seed).run()
        done = part if done is None else done.unionByName(part)
    rows = valid.select("uid", "name", "size", "digest").join(copies.select("size", "digest", "node"), ["size", "digest"])
    if done is not None:
        rows = rows.join(keep(done, "linked"), "node").select("name", "links", "label")
    else:
        rows = rows.select("name", F.lit(0).cast("long").alias("links"), F.col("node").alias("label"))
    rest = base.where("size = 0").select("name", F.lit(0).cast("long").alias("links"), (-F.col("uid") - 1).alias("label"))
    placed = keep(rows.unionByName(rest), "placed")
    least = keep(placed.groupBy("label").agg(F.min("name").alias("component_id")), "least")
    same = F.coalesce(F.col("name") == F.col("component_id"), F.col("name").isNull() & F.col("component_id").isNull())
    return placed.join(least, "label").select(
        F.col("name").alias(id_column), F.col("links").cast("long").alias("n_links"), "component_id", same.alias("kept")
    )
