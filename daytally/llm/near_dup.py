"""Near duplicates by a join over signature coordinates.

Every document has a set of word shingles and a MinHash signature. Documents are posted under the values of
groups of coordinates. Two documents that agree in at least ``matches`` coordinates differ in fewer coordinates
than there are groups, so they agree in all coordinates of some group and meet under it (the prefix: only as
many groups as that takes are posted). Where documents meet, the collisions over all coordinates are counted;
lists of one document are skipped. Pairs at or above the match threshold gather documents into families, and
the links of a family are confirmed on the full shingle sets. Components of the confirmed links are the groups.

What meets in a task is bounded: equal sets are one class with one representative, and a list or family beyond a
block is dealt out in two steps. First every block meets by itself, along with a few representatives of the whole group,
which joins nearly all of a group of near copies into one component, with rows in proportion to its members. Only what
then still lies apart meets across blocks: members outside the group's largest component meet all members, so every
pair of different components is covered, and pairs within one component need not be looked at. Only labels leave a block, never
its pairs.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty; a text without words has
no shingles, is linked with nothing and is kept. Fewer words than a shingle make one shingle of all of them.
A null id is never linked: its component is null and it is kept. Rows that repeat an id are one node: their
links are joined. Ties do not arise: the component is the smallest id. Other columns are not read.
Sets are compared by 64-bit shingle hashes, equal sets by two sums of 64 bits over them.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.llm.shared import (
    chunks, components, group_starts, minimum_labels, small, stored, task_count, text_of, whole_groups,
)
from daytally.llm.words import Words, distinct_per_row, mix

COORDINATES = 96
# Least similarity in percent, coordinates in a group, matches asked for. A pair at the least similarity misses
# them with a chance of about one in a million; every pair that has them is found.
PLANS = ((85, 3, 65), (80, 2, 58))
# Documents of one block, and shingles of one block of a family.
LIST_BLOCK = 1024
FAMILY_BLOCK = 512
FAMILY_SHINGLES = 4_000_000
# Members of a list or family that meet every block of it.
REPRESENTATIVES = 32
# Columns of the membership matrix that are multiplied at once.
_SLAB = 4096

_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _plan(percent: int) -> tuple[int, int, int]:
    """Coordinates in a group, matches asked for, groups posted."""
    for least, width, matches in PLANS:
        if percent >= least:
            return width, matches, COORDINATES - matches + 1
    raise ValueError(f"percent must be at least {PLANS[-1][0]}")


def _signatures(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Row by row, for each coordinate, the least of the permuted shingles; no row is empty."""
    out = np.empty((COORDINATES, len(first)), np.uint64)
    for k, factor in enumerate(_FACTORS):
        out[k] = np.minimum.reduceat(value * factor, first)
    return out


def features(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``id, n_shingles, s1, s2`` (marks of the set), ``keys`` (where to post) and ``sig`` (low bytes of the coordinates)."""
    group, _, groups = _plan(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            value, first = distinct_per_row(*words.shingles(width), batch.num_rows)
            count = np.diff(first)
            full = np.flatnonzero(count)
            s1, s2 = np.zeros((2, batch.num_rows), np.uint64)
            keys = np.zeros((batch.num_rows, groups), np.uint64)
            sig = np.zeros((batch.num_rows, COORDINATES), np.uint8)
            if len(full):
                s1[full] = np.add.reduceat(mix(value), first[full])
                s2[full] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), first[full])
                least = _signatures(value, first[full])
                sig[full] = (least >> np.uint64(40)).astype(np.uint8).T
                for g in range(groups):
                    key = np.full(len(full), g + 1, np.uint64)
                    for k in range(group):
                        key = mix(key + least[g * group + k])
                    keys[full, g] = key
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * groups
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(count.astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).reshape(-1))),
                pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(COORDINATES), batch.num_rows, [None, pa.py_buffer(sig.tobytes())]).cast(pa.binary()),
            ], ["id", "n_shingles", "s1", "s2", "keys", "sig"])

    schema = "id long, n_shingles long, s1 long, s2 long, keys array<long>, sig binary"
    return docs.mapInArrow(work, schema)


def _block(node: str, blocks: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(salt)), blocks).cast("int")


def _pairs(of: Column, to: Column) -> Column:
    return F.struct(of.cast("int").alias("i"), to.cast("int").alias("j"))


def _each(count: Column, pair: Callable[[Column], Column]) -> Column:
    """An array of ``pair`` for the numbers below ``count``; empty for none."""
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda x: x < count), pair)


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows at each place of their array ``at``, together with the other rows of the key at that place."""
    rows = rows.withColumn("at", F.explode("at")).withColumn("i", F.col("at.i")).withColumn("j", F.col("at.j")).drop("at")
    rows = rows.repartition(task_count(rows.sparkSession), key, "i", "j")
    return rows.sortWithinPartitions(key, "i", "j", "node")


def _met(roster: DataFrame, key: str, whole: Callable[[DataFrame], DataFrame], find: Callable) -> DataFrame:
    """Links ``a, b`` that join members of each group as all links among its members would.

    ``roster`` has ``node, blocks`` and the key of the group, ``whole`` adds to such rows what ``find`` compares.
    """
    own = _block("node", F.col("blocks"), 11)
    hot = roster.filter("blocks > 1")
    if hot.isEmpty():
        alone = roster.withColumn("at", F.array(_pairs(F.lit(0), F.lit(0)))).drop("blocks")
        return _dealt(whole(alone), key).mapInArrow(find, "a long, b long")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("node", F.lit(13)), "node"))
    chosen = hot.withColumn("_place", place).filter(F.col("_place") <= REPRESENTATIVES).select(key, "node", F.lit(True).alias("_chosen"))
    first = roster.join(small(stored(chosen)), [key, "node"], "left")
    everywhere = _each(F.col("blocks"), lambda x: _pairs(x, x))
    first = first.withColumn("at", F.when(F.col("_chosen"), everywhere).otherwise(F.array(_pairs(own, own))))
    near = _dealt(whole(first.drop("_chosen", "blocks")), key).mapInArrow(find, "a long, b long")

    # What still lies apart: members outside the largest component of their group meet all others.
    labels = stored(components(near).withColumnRenamed("component", "label"))
    near = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    placed = stored(hot.join(small(labels), "node", "left").withColumn("label", F.coalesce("label", "node")))
    parts = placed.groupBy(key, "label").agg(F.count("*").alias("n"))
    parts = parts.groupBy(key).agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("parts"))
    parts = stored(parts.filter("parts > 1").select(key, "top", (F.col("n") - F.col("top.n")).alias("rest"), "n"))
    apart = placed.join(small(parts), key)
    if apart.isEmpty():
        return near
    # Blocks as large as before, of the rest and of the largest component.
    share = F.col("blocks") / F.col("n")
    rest, main = F.ceil(F.col("rest") * share), F.ceil(F.col("top.n") * share)
    inner, outer = _block("node", rest, 17), _block("node", main, 19)
    # Places of two blocks of the rest have no negative number, those of a block of each have a negative first one.
    within = _each(rest, lambda x: _pairs(F.least(inner, x), F.greatest(inner, x)))
    within = F.when(rest == 1, within).otherwise(F.filter(within, lambda at: at["i"] != at["j"]))
    across = _each(main, lambda x: _pairs(-1 - x, inner))
    of_main = _each(rest, lambda x: _pairs(-1 - outer, x))
    apart = apart.withColumn("at", F.when(F.col("label") == F.col("top.label"), of_main).otherwise(F.concat(within, across)))
    far = _dealt(whole(apart.select(key, "node", "at")), key).mapInArrow(find, "a long, b long")
    return near.unionByName(far)


def _collisions(matches: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["key", "i", "j"]):
            node = table.column("node").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            starts = group_starts(table, ["key", "i", "j"])
            end = np.repeat(np.append(starts[1:], len(node)), np.diff(np.append(starts, len(node))))
            left, found = np.arange(len(node)), ([], [])
            offset = 1
            while len(left := left[left + offset < end[left]]):
                for part in np.array_split(left, len(left) // 50_000 + 1):
                    hit = part[(sig[part] == sig[part + offset]).sum(1) >= matches]
                    found[0].append(hit)
                    found[1].append(hit + offset)
                offset += 1
            if found[0]:
                label = minimum_labels(len(node), np.concatenate(found[0]), np.concatenate(found[1]))
                moved = np.flatnonzero(label != np.arange(len(node)))
                yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], ["a", "b"])

    return work


def _shingle_sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            value, first = distinct_per_row(*Words(batch.column("text")).shingles(width), batch.num_rows)
            sets = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            kept = [batch.column(name) for name in ("node", "family", "at")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.binary())], ["node", "family", "at", "shingles"])

    return work


def confirmed(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest member each member is linked to, over all pairs of ``sets``, directly or through others."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * common >= percent * (size.sum() - common) else 1])
    every = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), size)
    _, column, often = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1
    use = often[column] > 1
    member, column = member[use], shared[column[use]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _SLAB):
        a, b = np.searchsorted(column, [low, low + _SLAB])
        matrix = np.zeros((len(sets), _SLAB), np.float32)
        matrix[member[a:b], column[a:b] - low] = 1
        common += matrix @ matrix.T
    common = np.rint(common).astype(np.int64)
    a, b = np.nonzero(np.triu(100 * common >= percent * (size[:, None] + size[None, :] - common), 1))
    return minimum_labels(len(sets), a, b)


def _links(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["family", "i", "j"]):
            node = table.column("node").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            starts = group_starts(table, ["family", "i", "j"])
            out = ([], [])
            for a, b in zip(starts, np.append(starts[1:], len(node))):
                if b - a > 1:
                    label = confirmed(sets[a:b], percent)
                    moved = np.flatnonzero(label != np.arange(b - a))
                    out[0].append(node[a:b][moved])
                    out[1].append(node[a:b][label[moved]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["a", "b"])

    return work


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked if their sets of ``width``-word shingles overlap in at least ``percent`` percent of
    their union.
    """
    _, matches, _ = _plan(percent)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    rows = stored(features(texts, width, percent))
    mark = ["n_shingles", "s1", "s2"]
    known = rows.filter("id is not null and n_shingles > 0")
    classes = stored(known.groupBy(*mark).agg(
        F.min("id").alias("node"), F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    posted = classes.select(F.explode("keys").alias("key"), "node")
    lists = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    lists = lists.select("key", F.ceil(F.col("n") / LIST_BLOCK).cast("int").alias("blocks"))
    signatures = classes.select("node", "sig")
    pairs = _met(stored(posted.join(lists, "key")), "key", lambda df: df.join(signatures, "node"), _collisions(matches))

    families = components(pairs)
    families = families.join(classes.select("node", "n_shingles"), "node")
    size = families.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / FAMILY_BLOCK), F.ceil(F.col("s") / FAMILY_SHINGLES)).cast("int")
    families = stored(families.join(size.select("component", blocks.alias("blocks")), "component")
                      .select("node", F.col("component").alias("family"), "blocks"))

    def with_sets(roster: DataFrame) -> DataFrame:
        # A repeated id may have several texts: only the one whose set stands for the class is wanted, but an extra
        # member of a family can only add links of the same node.
        members = texts.join(small(stored(roster)), texts["id"] == F.col("node")).select("node", "family", "at", "text")
        return members.mapInArrow(
            _shingle_sets(width), "node long, family long, at array<struct<i: int, j: int>>, shingles binary")

    links = _met(families, "family", with_sets, _links(percent))

    # Each row's class. A class that holds a third of all rows is split, because both sides are shuffled for the join.
    named = rows.join(classes.select(*mark, "node"), mark, "left").withColumn("node", F.when(F.col("id").isNotNull(), F.col("node")))
    named = stored(named.select("id", "n_shingles", "node"))
    # Rows that repeat an id belong together, whatever class each is of.
    several = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("id", "a")
    same = named.join(several, "id").select("a", F.col("node").alias("b")).filter("b is not null")
    groups = stored(components(links.unionByName(same)))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id"))
    return named.join(small(groups), "node", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
