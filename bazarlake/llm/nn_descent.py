"""Embedding near-dedup by NN-descent.

Equal vectors under one label are one class. Each class keeps a list of its nearest neighbours:

1. Start: classes are sorted by sign codes of random hyperplanes, in several tables, and compared
   with those beside them in overlapping blocks.
2. Rounds: around each class its neighbours, and those that list it, are compared with each other
   (neighbours of neighbours), in chunks of bounded size, until few lists change.
3. Threshold: list entries of at least the threshold are links; components follow from them.
4. Saturation: a list that is full of links is too short. Every class that lies within reach of its
   component's members, by the angle to the centroid, is held against them, so all components that
   a link joins with it become one. That one is then counted exactly, whatever its size: all members within half the threshold's angle of the centroid are linked with
   each other, so their number is known without listing pairs; the members outside that ball are
   compared, block by block, with the whole component.
5. Audit: link counts of a bounded sample of classes are compared with brute force over all
   classes. Recall is the mean of found by true links over the sampled classes with a link, and
   likewise over those outside crowded components; the lower of the two counts. Below ``RECALL``
   the lists are doubled, fresh hyperplanes give further candidates and the rounds go on. If
   ``PASSES`` of them don't reach it, all pairs of a label are compared, in blocks.

All cosines are in double precision, so no link is below the threshold. Nothing that grows with the
table goes to the driver; the audit's sample has at most twice ``AUDITED`` vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite parts, and rows without
label, link with nothing and form a component of their own, under their own id. Vectors of different
length are never compared. Rows that repeat an id are vectors of their own. Components are named by
their smallest id, null ids aside. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from bazarlake.llm.components import components
from bazarlake.operators.workdir import materialize

THRESHOLD = 0.93
NEIGHBOURS = 16
TABLES = 8
ROUNDS = 4
RECALL = 0.98
AUDITED = 256
PASSES = 4
_BLOCK = 256
_CHUNK = 64
_SALTS = 32
_SETTLED = 0.002


def _unit(parts: list[float]) -> np.ndarray:
    v = np.array(parts, float)
    v /= np.abs(v).max()
    return v / math.sqrt(float(v @ v))


def _codes(units: np.ndarray, tables: int, turn: int) -> np.ndarray:
    planes = np.random.default_rng([units.shape[1], turn]).standard_normal((units.shape[1], tables * 32))
    bits = (units @ planes > 0).reshape(len(units), tables, 32)
    return (bits * (np.int64(1) << np.arange(31, -1, -1, dtype=np.int64))).sum(axis=2)


def _classes(vectors: DataFrame) -> DataFrame:
    """(cid, label, parts, dim, unit, least, copies), one row for each vector of a label."""
    usable = vectors.filter(_usable())
    grouped = usable.groupBy("label", "parts").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(p) for p in batch.column("parts").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns += [
                pa.array([len(u) for u in units], pa.int32()),
                pa.array([u.tobytes() for u in units], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "dim", "unit"])

    schema = "label string, parts array<double>, least bigint, copies bigint, dim int, unit binary"
    return materialize(grouped.mapInArrow(measured, schema).withColumn("cid", F.monotonically_increasing_id()))


def _usable():
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.col("parts").isNotNull() & finite & F.exists("parts", lambda x: x != 0)


def _pairs_of(ids: np.ndarray, groups: np.ndarray, units: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` nearest others of each row, within its group."""
    cosine = units @ units.T
    cosine[groups[:, None] != groups[None, :]] = -2
    np.fill_diagonal(cosine, -2)
    most = min(keep, len(ids) - 1)
    near = np.argpartition(-cosine, most - 1, axis=1)[:, :most]
    value = np.take_along_axis(cosine, near, axis=1)
    held = value > -2
    return np.repeat(ids, held.sum(axis=1)), ids[near[held]], value[held]


def _batch(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["u", "v", "cosine"])


_EDGES = "u bigint, v bigint, cosine double"


def _start(classes: DataFrame, keep: int, turn: int) -> DataFrame:
    """Candidates from overlapping blocks of the sign-code order; each turn has hyperplanes of its own."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            codes = np.zeros((len(dims), TABLES), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                codes[at] = _codes(np.stack([np.frombuffer(batch.column("unit")[int(i)].as_buffer()) for i in at]), TABLES, turn)
            columns = [*batch.columns, pa.array(codes.tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "codes"])

    held = classes.select("label", "dim", "cid", "unit").mapInArrow(coded, "label string, dim int, cid bigint, unit binary, codes array<bigint>")
    rows = held.select("label", "dim", "cid", "unit", F.posexplode("codes").alias("t", "code"))
    order = ["t", "label", "dim", "code", "cid"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("t", "label", "dim", "cid", "unit")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def found() -> tuple:
            ids = np.array([r[3] for r in held])
            names: dict = {}
            groups = np.array([names.setdefault(r[:3], len(names)) for r in held])
            width = max(r[2] for r in held)
            units = np.zeros((len(held), width))
            for i, r in enumerate(held):
                units[i, : r[2]] = np.frombuffer(r[4])
            return _pairs_of(ids, groups, units, keep)

        fresh = 0
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                held.append(row)
                fresh += 1
                if len(held) == _BLOCK:
                    out.append(found())
                    del held[: _BLOCK // 2]
                    fresh = 0
            if out:
                yield _batch(out)
        if len(held) > 1 and fresh:
            yield _batch([found()])

    return ordered.mapInArrow(blocks, _EDGES)


def _nearest(edges: DataFrame, keep: int) -> DataFrame:
    best = edges.groupBy("u", "v").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("u").orderBy(F.desc("cosine"), "v")
    return materialize(best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep).select("u", "v", "cosine"))


def _around(near: DataFrame, units: DataFrame, keep: int) -> DataFrame:
    """Candidates among the neighbours of each class and those that have it as a neighbour."""
    members = near.select(F.col("u").alias("center"), F.col("v").alias("cid")).unionAll(
        near.select(F.col("v").alias("center"), F.col("u").alias("cid"))
    ).unionAll(near.select(F.col("u").alias("center"), F.col("u").alias("cid"))).distinct()
    place = F.row_number().over(Window.partitionBy("center").orderBy(F.xxhash64("cid")))
    chunked = members.withColumn("chunk", F.floor((place - 1) / _CHUNK)).join(units, "cid")
    sorted_rows = chunked.repartition("center", "chunk").sortWithinPartitions("center", "chunk").select("center", "chunk", "cid", "unit")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, units_held = None, [], []

        def found():
            return _pairs_of(np.array(ids), np.zeros(len(ids)), np.stack(units_held), keep)

        for batch in batches:
            out = []
            for center, chunk, cid, unit in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (center, chunk) != key:
                    if len(ids) > 1:
                        out.append(found())
                    key, ids, units_held = (center, chunk), [], []
                ids.append(cid)
                units_held.append(np.frombuffer(unit))
            if out:
                yield _batch(out)
        if len(ids) > 1:
            yield _batch([found()])

    return sorted_rows.mapInArrow(local, _EDGES)


def _descend(near: DataFrame, classes: DataFrame, keep: int, rounds: int) -> DataFrame:
    units = classes.select("cid", "unit")
    for _ in range(rounds):
        known = near.select("u", "v", F.lit(True).alias("known"))
        new = _nearest(near.unionAll(_around(near, units, keep)), keep)
        changed, total = new.join(known, ["u", "v"], "left").agg(F.count_if(F.col("known").isNull()), F.count("*")).first()
        near = new
        if changed <= _SETTLED * total:
            break
    return near


@F.arrow_udf(DoubleType())
def _angle(units: pa.Array, centers: pa.Array) -> pa.Array:
    out = []
    for u, c in zip(units, centers, strict=True):
        center = np.array(c.as_py())
        norm = np.linalg.norm(center)
        cosine = float(np.frombuffer(u.as_buffer()) @ center / norm) if norm > 0 else -1.0
        out.append(math.acos(max(-1.0, min(1.0, cosine))))
    return pa.array(out, pa.float64())


def _centered(members: DataFrame) -> DataFrame:
    """The members (component, unit and others) with the angle to their component's ``centroid``."""
    floats = F.arrow_udf(lambda u: pa.array([np.frombuffer(x.as_buffer()) for x in u], pa.list_(pa.float64())), "array<double>")
    sums = (
        members.select("component", F.posexplode(floats("unit")).alias("pos", "x"))
        .groupBy("component", "pos")
        .agg(F.sum("x").alias("x"))
        .groupBy("component")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("centroid"))
    )
    return members.join(materialize(sums), "component").withColumn("angle", _angle("unit", "centroid"))


def _blocks(rows: DataFrame, key: list[str], number: str, columns: list[str], name: str) -> DataFrame:
    """The rows of each key in blocks of about ``_BLOCK``, each as one array; ``block`` is dealt by the number."""
    sizes = materialize(rows.groupBy(*key).agg(F.ceil(F.count("*") / _BLOCK).alias("n_blocks")))
    numbered = rows.join(sizes, key).withColumn("block", F.pmod(F.xxhash64(number), F.col("n_blocks")))
    return numbered.groupBy(*key, "block").agg(F.collect_list(F.struct(*columns)).alias(name))


def _every(classes: DataFrame, threshold: float, keep: int) -> DataFrame:
    """Each class's nearest links, from all pairs of its label."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, others = (np.array([x["cid"] for x in row[side]]) for side in ("asked", "others"))
                units, beside = (np.stack([np.frombuffer(x["unit"]) for x in row[side]]) for side in ("asked", "others"))
                cosine = units @ beside.T
                cosine[ids[:, None] == others[None, :]] = -2
                near = np.argsort(-cosine, axis=1)[:, :keep]
                value = np.take_along_axis(cosine, near, axis=1)
                held = value >= threshold
                yield _batch([(np.repeat(ids, held.sum(axis=1)), others[near[held]], value[held])])

    left, right = (_blocks(classes, ["label", "dim"], "cid", ["cid", "unit"], side).drop("block") for side in ("asked", "others"))
    return left.join(right, ["label", "dim"]).select("asked", "others").mapInArrow(compared, _EDGES)


def _merged(links: DataFrame, placed: DataFrame) -> DataFrame:
    """``placed`` after links (a, b) between components, with the classes that had no component before."""
    higher = materialize(components(links).withColumnRenamed("component", "joined"))
    known = placed.join(higher, placed.component == higher.node, "left").select("cid", F.coalesce("joined", "component").alias("component"))
    fresh = higher.join(placed.select("component").distinct(), higher.node == F.col("component"), "left_anti")
    return materialize(known.unionAll(fresh.select(F.col("node").alias("cid"), F.col("joined").alias("component"))))


def _met(placed: DataFrame, crowded: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``placed`` after every link of a crowded component's member has joined its two components.

    A class can link with a component only if its angle to the centroid is within the largest of the
    members' and the threshold's. Such a class is compared with the member nearest to the centroid;
    if that doesn't link, and its component isn't joined by others, with all members whose own
    angle to the centroid allows a link.
    """
    reach = math.acos(threshold) + 1e-6  # the margin is far above rounding
    named = materialize(
        classes.join(placed, "cid", "left").select("cid", F.coalesce("component", "cid").alias("component"), "label", "dim", "unit")
    )
    members = materialize(_centered(named.join(crowded, "component")))
    balls = members.groupBy("component", "label", "dim").agg(
        F.max("angle").alias("radius"), F.first("centroid").alias("centroid"), F.min_by("unit", F.struct("angle", "cid")).alias("anchor")
    )

    def near_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["classes"], row["balls"]
                units, anchors = np.stack([np.frombuffer(x["unit"]) for x in left]), np.stack([np.frombuffer(x["anchor"]) for x in right])
                centers = np.array([x["centroid"] for x in right])
                norms = np.linalg.norm(centers, axis=1)
                cosine = np.where(norms > 0, (units @ centers.T) / np.where(norms > 0, norms, 1.0), -1.0)
                angle = np.arccos(np.clip(cosine, -1.0, 1.0))
                of, ball = np.array([x["component"] for x in left]), np.array([x["component"] for x in right])
                other = of[:, None] != ball
                direct = other & (units @ anchors.T >= threshold)
                within = other & ~direct & (angle <= np.array([x["radius"] for x in right]) + reach)
                i, j = np.nonzero(direct)
                joined = np.unique(np.stack([of[i], ball[j]], axis=1), axis=0)
                at, to = np.nonzero(within)
                ids = np.array([x["cid"] for x in left])[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([joined[:, 0], of[at]]), pa.int64()), pa.array(np.concatenate([joined[:, 1], ball[to]]), pa.int64()),
                        pa.array([None] * len(joined) + ids.tolist(), pa.int64()), pa.array(np.concatenate([np.zeros(len(joined)), angle[at, to]])),
                    ],
                    names=["a", "b", "cid", "angle"],
                )

    salted = _blocks(named, ["label", "dim"], "cid", ["cid", "component", "unit"], "classes").withColumn("salt", F.pmod("block", F.lit(_SALTS)))
    every = _blocks(balls, ["label", "dim"], "component", ["component", "radius", "centroid", "anchor"], "balls")
    every = every.drop("block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))))
    pairs = salted.drop("block").join(every, ["label", "dim", "salt"]).select("classes", "balls")
    found = materialize(pairs.mapInArrow(near_balls, "a bigint, b bigint, cid bigint, angle double"))
    direct = found.filter("cid IS NULL").select("a", "b")
    once = _merged(direct, placed)
    # What is left: classes in reach of a ball, of a component that is still another.
    now = once.select(F.col("cid").alias("at"), F.col("component").alias("joined"))
    asked = found.filter("cid IS NOT NULL").join(now.withColumnRenamed("joined", "a_now"), F.col("a") == F.col("at"), "left").drop("at")
    asked = asked.join(now.withColumnRenamed("joined", "b_now"), F.col("b") == F.col("at"), "left").drop("at")
    asked = materialize(asked.filter("coalesce(a_now, a) <> coalesce(b_now, b)").select("a", F.col("b").alias("component"), "cid", "angle"))
    if asked.isEmpty():
        return once

    def touching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["asked"], row["members"]
                linked = np.stack([np.frombuffer(x["unit"]) for x in left]) @ np.stack([np.frombuffer(x["unit"]) for x in right]).T >= threshold
                joined = np.unique(np.array([x["a"] for x in left], np.int64)[linked.any(axis=1)])
                yield pa.RecordBatch.from_arrays([pa.array(joined), pa.array([row["component"]] * len(joined), pa.int64())], names=["a", "b"])

    # A link's two angles to the centroid differ by the threshold's at most: cells of that width, and those beside them.
    cell = F.floor(F.col("angle") / reach)
    with_units = asked.join(named.select("cid", "unit"), "cid").withColumn("cell", cell)
    cells = members.withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    left = _blocks(with_units, ["component", "cell"], "cid", ["a", "unit"], "asked").drop("block")
    right = _blocks(cells, ["component", "cell"], "cid", ["unit"], "members").drop("block")
    touched = left.join(right, ["component", "cell"]).select("component", "asked", "members").mapInArrow(touching, "a bigint, b bigint")
    return _merged(direct.unionAll(materialize(touched.distinct())), placed)


def _crowded_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(cid, linked): exact weights of links for whole components, given (cid, component, unit, copies)."""
    half = math.acos(threshold) / 2 - 1e-6  # the margin is far above rounding
    placed = materialize(_centered(members).withColumn("inside", F.col("angle") <= half).drop("centroid", "angle"))
    weights = placed.filter("inside").groupBy("component").agg(F.sum("copies").alias("weight"))
    inner = placed.filter("inside").join(materialize(weights), "component").select("cid", (F.col("weight") - F.col("copies")).alias("linked"))
    outer = placed.filter("NOT inside")
    if outer.isEmpty():
        return inner

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["outer"], row["all"]
                a, b = (np.stack([np.frombuffer(x["unit"]) for x in side]) for side in (left, right))
                linked = (a @ b.T >= threshold) & (np.array([x["cid"] for x in left])[:, None] != np.array([x["cid"] for x in right]))
                to_left = linked @ np.array([x["copies"] for x in right])
                to_right = np.array([x["copies"] for x in left]) @ linked
                inside = np.array([x["inside"] for x in right])
                ids = [x["cid"] for x in left] + [x["cid"] for x, i in zip(right, inside, strict=True) if i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.concatenate([to_left, to_right[inside]]), pa.int64())], names=["cid", "linked"]
                )

    columns = ["cid", "unit", "copies", "inside"]
    left, right = (_blocks(rows, ["component"], "cid", columns, name).drop("block") for rows, name in ((outer, "outer"), (placed, "all")))
    pairs = left.join(right, "component").select("outer", "all")
    return inner.unionAll(pairs.mapInArrow(compared, "cid bigint, linked bigint")).groupBy("cid").agg(F.sum("linked").alias("linked"))


def _counted(near: DataFrame, classes: DataFrame, threshold: float, keep: int) -> DataFrame:
    """(cid, component, linked, crowded) of the classes that have a link."""
    links = near.filter(F.col("cosine") >= threshold)
    both = materialize(links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    placed = components(both.select(F.col("u").alias("a"), F.col("v").alias("b"))).withColumnRenamed("node", "cid")
    full = links.groupBy(F.col("u").alias("cid")).agg(F.count("*").alias("n")).filter(F.col("n") >= keep)
    full = materialize(full)
    crowded = materialize(full.join(placed, "cid").select("component").distinct())
    if not crowded.isEmpty():
        placed = _met(placed, crowded, classes, threshold)
        crowded = materialize(full.join(placed, "cid").select("component").distinct())
    members = placed.join(crowded, "component").join(classes.select("cid", "unit", "copies"), "cid")
    plain = (
        both.join(classes.select(F.col("cid").alias("v"), "copies"), "v").groupBy(F.col("u").alias("cid")).agg(F.sum("copies").alias("linked"))
        .join(placed.join(crowded, "component", "left_anti"), "cid").select("cid", "linked", F.lit(False).alias("crowded"))
    )
    exact = _crowded_counts(materialize(members), threshold).select("cid", "linked", F.lit(True).alias("crowded"))
    return materialize(plain.unionAll(exact).join(placed, "cid"))


def _recall(counted: DataFrame, classes: DataFrame, threshold: float) -> float:
    """Mean share of a class's brute-force links that were found, over bounded samples of the classes with
    a link: of all, and of those outside crowded components; the lower one."""
    named = classes.join(counted, "cid", "left").select(
        "cid", "label", "dim", "unit", "least", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("crowded", F.lit(False)).alias("crowded")
    )
    order = [F.xxhash64("least"), "cid"]
    sample = list({r.cid: r for rows in (named, named.filter("NOT crowded")) for r in rows.orderBy(*order).limit(AUDITED).collect()}.values())
    shared = classes.sparkSession.sparkContext.broadcast([(r.cid, r.label, r.dim, bytes(r.unit)) for r in sample])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict = {}
        for cid, label, dim, unit in shared.value:
            asked.setdefault((label, dim), []).append((cid, np.frombuffer(unit)))
        for batch in batches:
            labels, dims, ids = (batch.column(c).to_pylist() for c in ("label", "dim", "cid"))
            copies, total = np.array(batch.column("copies").to_pylist()), {}
            by_group: dict = {}
            for i, key in enumerate(zip(labels, dims, strict=True)):
                if key in asked:
                    by_group.setdefault(key, []).append(i)
            for key, at in by_group.items():
                units = np.stack([np.frombuffer(batch.column("unit")[i].as_buffer()) for i in at])
                for cid, unit in asked[key]:
                    hit = (units @ unit >= threshold) & (np.array(ids)[at] != cid)
                    if hit.any():
                        total[cid] = total.get(cid, 0) + int(copies[at][hit].sum())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (total.keys(), total.values())], names=["cid", "n"])

    counts = classes.select("label", "dim", "cid", "copies", "unit").mapInArrow(exact, "cid bigint, n bigint").groupBy("cid").agg(F.sum("n"))
    there = dict(map(tuple, counts.collect()))
    shares = [(min(1.0, r.linked / there[r.cid]), r.crowded) for r in sample if r.cid in there]
    parts = [[s for s, _ in shares], [s for s, crowded in shares if not crowded]]
    return min((sum(part) / len(part) for part in parts if part), default=1.0)


def linked(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    neighbours: int = NEIGHBOURS,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    vectors = embeddings.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("parts")
    )
    classes = _classes(vectors)
    keep = neighbours
    near = _nearest(_start(classes, keep, 0), keep)
    for turn in range(1, PASSES + 1):
        near = _descend(near, classes, keep, rounds)
        counted = _counted(near, classes, threshold, keep)
        if _recall(counted, classes, threshold) >= RECALL:
            break
        if turn == PASSES:
            counted = _counted(_nearest(_every(classes, threshold, keep), keep), classes, threshold, keep)
            break
        keep *= 2
        near = _nearest(near.unionAll(_start(classes, keep, turn)), keep)
    named = classes.select("cid", "label", "parts", "least", "copies").join(counted, "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    least = materialize(named.groupBy("component").agg(F.min("least").alias("component_id")))
    lookup = materialize(
        named.join(least, "component").select("label", "parts", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    keyed = vectors.withColumn("usable", F.coalesce(_usable(), F.lit(False)))
    found = keyed.filter("usable").join(lookup, ["label", "parts"]).select("vec_id", "n_links", "component_id")
    alone = keyed.filter("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
