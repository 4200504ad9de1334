"""MinHash near-dedup with tensored banding.

A document's set holds the hashes of its distinct word shingles. ``COLLECTIONS`` small collections
of ``ROWS`` minhashes each are computed; every *pair* of collections forms the key of one table, so
m * ROWS minhashes give m * (m - 1) / 2 tables of 2 * ROWS rows: about the square root of the
minhashes that separate tables would take. Documents that share a key are candidates, and every
candidate link is confirmed on the full sets.

No group emits all its pairs:

1. Documents with equal sets are one class (a grouping that combines before the shuffle).
2. In each table bucket all classes are compared with one leader, the class that meets most others
   over all tables. Confirmed links join classes to components.
3. The classes of a leading component have a consensus: the shingles that most of them hold. All
   classes in its buckets are measured by it, and those outside the component are compared with its
   centre, the class nearest the consensus; links join components again.
4. Only classes that are still outside are compared further, with the classes of other components
   in their buckets, and only pairs that can be links by what is known of the consensus: an
   intersection has at most the smaller of both overlaps with it, plus the shingles that both have
   beyond it. Pairs with such a shingle in common are joined on it; all others meet in their bucket
   and must be able to link by the overlaps alone. This bound loses nothing: it holds for every pair
   and every third set. A pair that meets in several tables is emitted in the first alone.

Defined cases: a null, empty or wordless text has an empty set and links with nothing; a text of
fewer words than a shingle is one shingle. Every row is a node of its own: rows that repeat an id
with other texts link by their texts alone. Rows without id take part; their component's id is the
smallest id of the others, null if there is none. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazarlake.llm.common import row_of, utf8, words_of
from bazarlake.llm.components import LINKS_PER_TASK, components
from bazarlake.llm.encoding import in_groups
from bazarlake.operators.workdir import materialize

COLLECTIONS = 12
ROWS = 3
_BLOCK = 4096
#: Longer lists of shingles are not carried along in joins; their pairs pass on counts alone.
_CARRIED = 256
#: Shingles that one Arrow batch holds.
_SPREAD = 1 << 19
#: Sets that a task reads; they are wider than other rows.
_SETS_PER_TASK = 10_000
_ODD = np.random.default_rng(20240607).integers(1, 1 << 63, (2, 64), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``width`` words."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    rolled = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(words) - span + 1 + k]
    return np.unique(_mixed(rolled))


def _collection_hashes(members: np.ndarray, collections: int, rows: int) -> np.ndarray:
    """One hash for each small collection of minhashes."""
    n = collections * rows
    a, b = _ODD[0, :n, None], _ODD[1, :n, None]
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), _BLOCK):  # bounded memory for very long texts
        least = np.minimum(least, (members[None, start : start + _BLOCK] * a + b).min(axis=1))
    parts = least.reshape(collections, rows)
    out = np.zeros(collections, np.uint64)
    for k in range(rows):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return out


def _fingerprint(members: np.ndarray) -> bytes:
    """128 bits of the whole set."""
    return xxhash.xxh3_128_digest(members.tobytes())


def _signatures(docs: DataFrame, width: int, collections: int, rows: int) -> DataFrame:
    """Columns of ``docs`` but for ``bytes``; set size, fingerprint and collection hashes."""
    kept = [c for c in docs.schema.fields if c.name != "bytes"]
    schema = ", ".join([f"{c.name} {c.dataType.simpleString()}" for c in kept] + ["n_shingles bigint", "print binary", "halves array<bigint>"])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes")
            sizes, prints, halves = [], [], []
            for i in range(len(texts)):
                members = shingle_set(texts[i].as_py(), width)
                sizes.append(len(members))
                prints.append(_fingerprint(members) if len(members) else None)
                halves.append(_collection_hashes(members, collections, rows).view(np.int64) if len(members) else None)
            columns = [batch.column(c.name) for c in kept]
            columns += [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(halves, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.name for c in kept] + ["n_shingles", "print", "halves"])

    return docs.mapInArrow(signed, schema)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(cid, members) of the rows whose set has the fingerprint that the class has."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                members = shingle_set(batch.column("bytes")[i].as_py(), width)
                if _fingerprint(members) == batch.column("print")[i].as_py():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("cid")[i : i + 1], pa.array([members.tobytes()], pa.binary())], names=["cid", "members"]
                    )

    return docs.select("cid", "print", "bytes").mapInArrow(built, "cid bigint, members binary")


def _fitted(df: DataFrame, rows_per_task: int = LINKS_PER_TASK) -> DataFrame:
    """Computed once, and read by as many tasks as its rows need.

    A shuffle writes files for each of the tasks before it, so many tasks with few rows each would
    fill the disks with files that are almost empty.
    """
    held = materialize(df)
    return held.coalesce(1 + held.count() // rows_per_task)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of both sets and of their intersection: n_a, n_b, common."""

    @F.arrow_udf("bigint")
    def overlap(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for i in range(len(left)):
            both = np.concatenate([np.frombuffer(side[i].as_buffer(), np.uint64) for side in (left, right)])
            both.sort(kind="stable")
            out.append(int((both[1:] == both[:-1]).sum()))
        return pa.array(out, pa.int64())

    first = sets.select(F.col("cid").alias("a"), F.col("members").alias("left_set"))
    second = sets.select(F.col("cid").alias("b"), F.col("members").alias("right_set"))
    n_a, n_b = ((F.octet_length(side) / 8).cast("bigint") for side in ("left_set", "right_set"))
    both = pairs.join(first, "a").join(second, "b")
    return both.select("a", "b", overlap("left_set", "right_set").alias("common"), n_a.alias("n_a"), n_b.alias("n_b"))


def _linked(percent: int):
    """Whether the sets have ``100 * intersection >= percent * union``."""
    return (100 + percent) * F.col("common") >= percent * (F.col("n_a") + F.col("n_b"))


def _consensus(inside: DataFrame, sets: DataFrame) -> DataFrame:
    """(led, consensus): the shingles that more than half of a component's classes hold."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, led = batch.column("members"), batch.column("led").to_numpy()
            held = [np.frombuffer(members[i].as_buffer(), np.int64) for i in range(len(batch))]
            for low, high in in_groups([len(h) for h in held], _SPREAD):
                repeated = np.repeat(led[low:high], [len(h) for h in held[low:high]])
                yield pa.RecordBatch.from_arrays([pa.array(repeated), pa.array(np.concatenate(held[low:high]))], names=["led", "shingle"])

    rows = inside.join(sets, "cid").select("led", "members").mapInArrow(spread, "led bigint, shingle bigint")
    counts = rows.groupBy("led", "shingle").agg(F.count("*").alias("n"))
    classes = inside.groupBy("led").agg(F.count("*").alias("of"))
    return counts.join(classes, "led").filter("2 * n > of").groupBy("led").agg(F.collect_list("shingle").alias("consensus"))


def _against(belongs: DataFrame, sets: DataFrame, consensus: DataFrame) -> DataFrame:
    """(cid, led, common, apart, beyond): a set's overlap with the consensus, the number of shingles
    that only one of both has, and the set's shingles beyond it that another set there has too."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, apart, lacking = [], [], []
            for i in range(len(batch)):
                own = np.frombuffer(batch.column("members")[i].as_buffer(), np.int64)
                other = batch.column("consensus")[i].values.to_numpy()
                lacking.append(np.setdiff1d(own, other, assume_unique=True))
                common.append(len(own) - len(lacking[-1]))
                apart.append(len(lacking[-1]) + len(other) - common[-1])
            columns = [batch.column("cid"), batch.column("led"), pa.array(common, pa.int64()), pa.array(apart, pa.int64())]
            columns.append(pa.array(lacking, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["cid", "led", "common", "apart", "lacking"])

    held = belongs.select("cid", "led").join(sets, "cid").join(consensus, "led", "left")
    held = held.select("cid", "led", "members", F.coalesce("consensus", F.array().cast("array<bigint>")).alias("consensus"))
    met = _fitted(held.mapInArrow(compared, "cid bigint, led bigint, common bigint, apart bigint, lacking array<bigint>"), _SETS_PER_TASK)
    rows = met.select("cid", "led", F.explode("lacking").alias("shingle"))
    shared = _fitted(rows.groupBy("led", "shingle").agg(F.count("*").alias("n")).filter("n > 1").select("led", "shingle"))
    lists = rows.join(shared, ["led", "shingle"]).groupBy("cid", "led").agg(F.collect_list("shingle").alias("beyond"))
    return met.drop("lacking").join(lists, ["cid", "led"], "left")


def _leaders(bucketed: DataFrame) -> DataFrame:
    """(key, leader): in each bucket the class that meets most others over all tables."""
    sizes = _fitted(bucketed.groupBy("key").agg(F.count("*").alias("n")))
    meetings = _fitted(bucketed.join(sizes, "key").groupBy("cid").agg(F.sum("n").alias("meetings")))
    best = bucketed.join(meetings, "cid").groupBy("key").agg(F.max(F.struct("meetings", (-F.col("cid")).alias("order"))).alias("best"))
    return best.select("key", (-F.col("best.order")).alias("leader"))


def classified(
    docs: DataFrame,
    width: int = 3,
    percent: int = 85,
    collections: int = COLLECTIONS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    with_survivor: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``, ``kept``.

    On demand also ``survivor``: true for the rows of one id and text per component, the smallest
    by (id, text hash) with null ids last, and for every row without words.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(
        _signatures(named.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8().alias("bytes")), width, collections, rows)
    )
    grouped = signed.filter("print IS NOT NULL").groupBy("print", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "text_hash")).alias("source"), F.first("halves").alias("halves"),
        *([F.min(_place()).alias("first_row")] if with_survivor else []),
    )
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()))

    pairs = [(i, j) for i in range(collections) for j in range(i + 1, collections)]
    classes = classes.coalesce(1 + classes.count() * len(pairs) // LINKS_PER_TASK)
    keys = F.array(*[F.xxhash64(F.lit(n), F.get("halves", F.lit(i)), F.get("halves", F.lit(j))) for n, (i, j) in enumerate(pairs)])
    keyed = classes.select("cid", F.posexplode(keys).alias("place", "key"))
    met = keyed.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high").select("key")
    bucketed = _fitted(keyed.join(_fitted(met), "key"))

    candidates = _fitted(bucketed.select("cid").distinct().join(classes.select("cid", "print", "source"), "cid"))
    texts = named.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8().alias("bytes")).join(
        candidates.select("cid", "print", F.col("source.doc_id").alias("s_id"), F.col("source.text_hash").alias("s_hash")),
        F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash")),
    )
    sets = _fitted(_sets(texts, width).dropDuplicates(["cid"]), _SETS_PER_TASK)

    leaders = _fitted(_leaders(bucketed))
    led = bucketed.join(leaders, "key").filter("cid <> leader").select(F.col("cid").alias("a"), F.col("leader").alias("b"))
    first = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    overlaps = _fitted(_overlaps(first, sets))

    so_far = components(overlaps.filter(_linked(percent))).withColumnRenamed("node", "cid")
    more = _further_links(bucketed, leaders, so_far, classes, sets, pairs, percent)
    merged = components(more).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    held = ["first_row"] if with_survivor else []
    named_classes = classes.select("cid", "rep", "print", *held).join(so_far, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    named_classes = named_classes.join(merged, "component", "left").withColumn("component", F.coalesce("merged", "component"))
    least = _fitted(named_classes.groupBy("component").agg(F.min("rep").alias("component_id"), *[F.min(c).alias(c) for c in held]))
    lookup = _fitted(named_classes.drop(*held).join(least, "component").select("print", "component_id", *held))
    own = signed.select("doc_id", "text_hash", "n_shingles", "print").join(lookup, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        *([(F.col("print").isNull() | (_place() == F.col("first_row"))).alias("survivor")] if with_survivor else []),
    )


def _place() -> Column:
    """Order of the rows of a component: by id and text hash, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), "text_hash")


def _side(frame: DataFrame, name: str, *keys: str) -> DataFrame:
    """One side of a pair, its columns named after it: id, component, size, overlap, shingles beyond."""
    named = {"c": "component", "n": "n_shingles", "i": "common", "x": "beyond", "h": "halves"}
    return frame.select(*keys, F.col("cid").alias(name), *[F.col(of).alias(f"{short}_{name}") for short, of in named.items()])


def _between(found: DataFrame, placed: DataFrame) -> DataFrame:
    """The components (a, b) that links between classes join."""
    of_a = placed.select(F.col("cid").alias("a"), F.col("component").alias("c_a")).distinct()
    of_b = placed.select(F.col("cid").alias("b"), F.col("component").alias("c_b")).distinct()
    return found.join(of_a, "a").join(of_b, "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct()


def _centre_links(known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of classes outside a leading component with the class nearest its consensus."""
    centres = known.filter("component = led").groupBy("led").agg(F.min(F.struct("apart", "cid", "common", "n_shingles")).alias("centre"))
    beyond = F.least(F.col("n_shingles") - F.col("common"), F.col("centre.n_shingles") - F.col("centre.common"))
    at_most = F.least("common", "centre.common") + beyond
    asked = known.filter("component <> led").join(centres, "led").filter(
        (100 + percent) * at_most >= percent * (F.col("n_shingles") + F.col("centre.n_shingles"))
    )
    pairs = asked.select(F.least("cid", "centre.cid").alias("a"), F.greatest("cid", "centre.cid").alias("b")).distinct()
    return _overlaps(pairs, sets).filter(_linked(percent))


def _further_links(
    bucketed: DataFrame,
    leaders: DataFrame,
    so_far: DataFrame,
    classes: DataFrame,
    sets: DataFrame,
    pairs: list[tuple[int, int]],
    percent: int,
) -> DataFrame:
    """Links between the components ``so_far``, from classes that are outside their leaders' components."""
    placed = _fitted(bucketed.join(so_far, "cid", "left").withColumn("component", F.coalesce("component", "cid")))
    led = leaders.join(so_far.withColumnRenamed("cid", "leader"), "leader", "left").select(
        "key", "leader", F.coalesce("component", "leader").alias("led")
    )
    open_keys = _fitted(
        placed.join(led, "key").filter("component <> led").groupBy("key").agg(F.min("leader").alias("leader"), F.min("led").alias("led"))
    )
    held = _fitted(placed.join(open_keys, "key"))
    belongs = _fitted(held.groupBy("cid", "led", "component").agg(F.max(F.col("cid") != F.col("leader")).alias("follows")))
    consensus = _fitted(_consensus(belongs.filter("component = led").select("cid", "led"), sets), _SETS_PER_TASK)
    known = _fitted(
        belongs.join(_against(belongs, sets, consensus), ["cid", "led"])
        .withColumn("beyond", F.coalesce("beyond", F.array().cast("array<bigint>")))
        .join(classes.select("cid", "n_shingles", "halves"), "cid"),
        _SETS_PER_TASK,
    )
    near = _fitted(_between(_centre_links(known, sets, percent), placed))

    # Within its group, a component that the centre links counts as the leading one.
    both_ways = near.unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    adjacent = both_ways.select(F.col("a").alias("component"), F.col("b").alias("led"), F.lit(True).alias("linked"))
    known = known.join(adjacent, ["component", "led"], "left").withColumn(
        "component", F.when(F.col("linked"), F.col("led")).otherwise(F.col("component"))
    )
    possible = 100 * (F.col("common") + F.size("beyond")) >= percent * F.col("n_shingles")
    able = _fitted(known.filter(F.col("follows") & possible).drop("follows", "apart", "linked"))  # leaders have met all of theirs
    members = held.filter("cid <> leader").select("key", "place", "cid", "led")

    # A pair of two minor classes is met from both sides; it counts once, from the smaller id.
    once = (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("led")) | (F.col("a") < F.col("b")))
    agreeing = F.filter(F.sequence(F.lit(0), F.size("h_a") - 1), lambda k: F.get("h_a", k) == F.get("h_b", k))
    needed = percent * (F.col("n_a") + F.col("n_b"))
    by_consensus = (100 + percent) * F.least("i_a", "i_b") >= needed

    # Nothing in common beyond the consensus: the overlaps with it must suffice, with the smallest set at least.
    keyed = members.join(able, ["cid", "led"])
    smallest = keyed.groupBy("key").agg(F.min("n_shingles").alias("smallest"))
    enough = (100 + percent) * F.col("common") >= percent * (F.col("n_shingles") + F.col("smallest"))
    left = _fitted(keyed.join(smallest, "key").filter(enough).withColumn("beyond", F.lit(None).cast("array<bigint>")))
    places = F.array(*[F.array(F.lit(i), F.lit(j)) for i, j in pairs])
    in_first_table = F.slice(agreeing, 1, 2) == F.get(places, F.col("place"))
    met = (
        _side(left.filter("component <> led"), "a", "key", "place", "led")
        .join(_side(left, "b", "key"), "key")
        .filter(once & by_consensus & in_first_table)
    )

    # Shingles in common beyond the consensus: each pair counts at the first of them.
    spread = _fitted(
        able.withColumn("shingle", F.explode("beyond"))
        .withColumn("n_beyond", F.size("beyond"))
        .withColumn("beyond", F.when(F.size("beyond") <= _CARRIED, F.col("beyond")))
    )
    shared = F.array_intersect("x_a", "x_b")
    at_most = F.least("i_a", "i_b") + F.least("m_a", "m_b")
    exact = ((100 + percent) * (F.least("i_a", "i_b") + F.size(shared)) >= needed) & (F.array_min(shared) == F.col("shingle"))
    unknown = F.col("x_a").isNull() | F.col("x_b").isNull()
    beyond = (
        _side(spread.filter("component <> led"), "a", "led", "shingle", F.col("n_beyond").alias("m_a"))
        .join(_side(spread, "b", "led", "shingle", F.col("n_beyond").alias("m_b")), ["led", "shingle"])
        .filter(once & ((100 + percent) * at_most >= needed) & (unknown | exact) & (F.size(agreeing) >= 2))
    )
    further = met.select("a", "b").unionAll(beyond.select("a", "b")).distinct()
    found = _fitted(_overlaps(further, sets).filter(_linked(percent)))
    return near.unionAll(_between(found, placed)).distinct()


def report(docs: DataFrame, **settings) -> DataFrame:
    return classified(docs, **settings).drop("text_hash")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the smallest by id, then by text hash.

    So exactly one row stays of a group whose rows share an id or have none. Rows that repeat both
    id and text are one document.
    """
    found = classified(docs, doc_id=doc_id, text=text, with_survivor=True, **settings).filter("survivor").select("doc_id", "text_hash").distinct()
    held = docs.select(
        row_of(docs).alias("__row"), F.col(doc_id).alias("__id"), F.xxhash64(F.col(text)).alias("__hash")
    )
    same = F.col("__id").eqNullSafe(F.col("doc_id")) & F.col("__hash").eqNullSafe(F.col("text_hash"))
    number = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy(F.lit(0)))
    return held.join(found, same, "left_semi").withColumn("__number", number).filter("__number = 1").select("__row.*")
