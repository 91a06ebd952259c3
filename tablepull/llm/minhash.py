"""Near-duplicate documents by MinHash with tensored tables, verified on full shingle sets.

Two small collections of MinHash values are taken of every set; each pair of a left and a
right value is the key of one table, so 2 * 8 values serve 64 tables. Documents of equal
sets fold into one class first. In each bucket all members meet its smallest one, which
costs a row per member; the similarity is computed on the sets themselves. Documents that are
close to each other, linked or not, make families; those that are
not linked to the document most of a family is linked to meet all others of it, in blocks.

The smallest document of a bucket can be a stranger to the others, which may still be linked to
each other. Of the documents that are left so, those that are linked share one of their rarest
shingles, and all such pairs of two families are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm.hashing import mix, shingle_sets
from tablepull.llm.tables import components, drop_stored, stored

# MinHash values on each side; two sets meet in a table for each pair of values. For a similarity of
# 0.75 a pair meets in no table with a probability of 2 * 0.25 ** 8 = 3e-5 at most.
SIDES = 8
# Two documents that are this similar, in percent, are of one family.
CLOSE = 40
# Members of a family that are compared in one task, against as many others.
BLOCK = 512
_SEEDS = np.random.default_rng(40).integers(1, 2**63, 2 * SIDES, dtype=np.uint64)
_DESCRIBED = "id long, n long, print binary, keys array<long>"


def tensor_keys(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The table keys of each set (a row each): every left value with every right value."""
    low = np.stack([np.minimum.reduceat(mix(shingles ^ seed), starts) for seed in _SEEDS], axis=1)
    low = mix(low + np.arange(1, 2 * SIDES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys = low[:, :SIDES, None] * np.uint64(0xD6E8FEB86659FD93) + low[:, None, SIDES:]
    return mix(keys).reshape(len(starts), SIDES * SIDES).view(np.int64)


def _listed(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _describe(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = list(shingle_sets(part.column("text"), size))
                counts = np.array([len(s) for s in sets])
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                keys = [np.zeros(0, np.int64)] * len(sets)
                some = np.flatnonzero(counts)
                if len(some):
                    starts = np.cumsum(counts[some]) - counts[some]
                    for row, values in zip(some, tensor_keys(np.concatenate([sets[i] for i in some]), starts)):
                        keys[row] = values
                yield pa.record_batch([part.column("id"), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), _listed(keys)], names=["id", "n", "print", "keys"])

    return run


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = _listed([s.view(np.int64) for s in shingle_sets(part.column("text"), size)])
                yield pa.record_batch([part.column("id"), sets], names=["id", "items"])

    return run


def _compared(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of at least ``CLOSE`` percent, whether they are ``linked`` and whether ``b`` is ``settled``.

    By the triangle inequality all that is linked to a settled ``b`` is of at least ``CLOSE`` percent with ``a``.
    """
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    union = F.size("x") + F.size("y") - F.col("common")
    joint = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    close = joint.where(100 * F.col("common") >= CLOSE * union)
    flags = [(100 * F.col("common") >= least * union).alias(name) for name, least in (("linked", percent), ("settled", CLOSE + 100 - percent))]
    return stored(close.select("a", "b", *flags), "pairs")


def _buckets(described: DataFrame) -> DataFrame:
    """(key, id, n) of all buckets with at least two members."""
    rows = described.select("id", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").drop("members")
    return stored(rows.join(shared, "key"), "buckets")


def _with_hubs(members: DataFrame) -> DataFrame:
    """The members of a bucket but its smallest one, which is their ``hub``."""
    hubs = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub"))
    return members.join(hubs, "key").where(F.col("hub.id") != F.col("id"))


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Every member of a bucket with its smallest one, where their sizes allow ``CLOSE`` percent."""
    pairs = _with_hubs(members)
    pairs = pairs.where(100 * F.least("n", "hub.n") >= CLOSE * F.greatest("n", "hub.n"))
    return pairs.select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()


def _strangers(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Ids that share a bucket with another one while its smallest member has settled neither."""
    settled = pairs.where("settled").select(F.col("a").alias("h_id"), F.col("b").alias("id"))
    rest = _with_hubs(members).select("key", "id", F.col("hub.id").alias("h_id")).join(settled, ["h_id", "id"], "left_anti")
    several = rest.groupBy("key").agg(F.count(F.lit(1)).alias("rest")).where("rest > 1").select("key")
    return stored(rest.join(several, "key", "left_semi").select("id").distinct(), "strangers")


def _stranger_links(strangers: DataFrame, families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between ``strangers`` of different families, by a join on the rarest shingles of each.

    In any order of all shingles, two linked sets share one among the first ``n - ceil(n * percent / 100) + 1``
    of both. Shingles that no other stranger has come first here and meet nothing.
    """
    family = families.withColumnRenamed("component", "family")
    people = sets.join(strangers, "id").join(family, "id", "left").withColumn("family", F.coalesce("family", "id"))
    items = people.select("id", "family", F.size("items").alias("n"), F.explode("items").alias("x"))
    # Within one family all is compared elsewhere.
    shared = items.groupBy("x").agg(F.count(F.lit(1)).alias("df"), F.min("family").alias("lo"), F.max("family").alias("hi")).where("df > 1")
    rows = items.join(shared.select("x", "df", (F.col("lo") < F.col("hi")).alias("meets")), "x")
    ranked = rows.groupBy("id", "family", "n").agg(F.sort_array(F.collect_list(F.struct("df", "x", "meets"))).alias("s"))
    ranked = ranked.withColumn("alone", F.col("n") - F.size("s")).withColumn("least", F.expr(f"int((n * {percent} + 99) div 100)"))
    first = ranked.select("id", "family", "n", "alone", F.posexplode(F.expr("slice(s, 1, greatest(n - least + 1 - alone, 0))")).alias("i", "e"))
    first = stored(first.where("e.meets").select("e.x", "id", "family", "n", (F.col("alone") + F.col("i")).alias("at")), "prefixes")
    a, b = (first.select("x", *[F.col(c).alias(f"{side}_{c}") for c in ("id", "family", "n", "at")]) for side in "ab")
    # What can still be common from the shared one on must do for a link; it is the first one of some row.
    most = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    meet = a.join(b, "x").where((F.col("a_id") < F.col("b_id")) & (F.col("a_family") != F.col("b_family")))
    meet = meet.where((100 + percent) * most >= percent * (F.col("a_n") + F.col("b_n")))
    pairs = stored(meet.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct(), "met")
    links = _compared(sets, pairs, percent)
    drop_stored(first, pairs)
    return links.where("linked").select("a", "b")


def _open_people(pairs: DataFrame, families: DataFrame) -> DataFrame:
    """(id, component, family) of the families, joined by all close pairs, of which not all are linked to one document.

    ``component`` is the smallest document that one is linked to, or itself: those of one
    component need not be compared.
    """
    linked = pairs.where("linked").groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
    people = families.withColumnRenamed("component", "family").join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    stats = people.groupBy("family").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    # A family of two is done: its only pair has been compared.
    return stored(people.join(stats.where("lo < hi and n > 2").select("family"), "family").select("id", "component", "family"), "people")


def _family_links(people: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of each family.

    All members that are not in the largest component of their family meet all members of other
    components, in blocks; only links leave a task, one for each member and component.
    """
    parts = people.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("family").agg(F.max(F.struct("size", F.col("component").alias("main"))).alias("top"), F.sum("size").alias("people"))
    total = people.count()
    rows = people.join(largest.select("family", "top.main", "people"), "family").join(sets, "id")
    rows = rows.withColumn("rest", F.col("component") != F.col("main")).withColumn("blocks", F.expr(f"int(ceil(people / {BLOCK}))"))
    rows = rows.withColumn("own", F.expr("int(pmod(xxhash64(id), blocks))"))
    # Small families share tasks; a large one has a task for each two of its blocks.
    share = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(max(1, total // BLOCK)))).otherwise(F.col("family"))
    rows = rows.withColumn("share", share).withColumn("each", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    fields = ["share", "blocks", "family", "id", "component", "items"]
    asked = rows.where("rest").select(*fields, F.col("own").alias("p"), F.col("each").alias("q"), F.lit(True).alias("asks"))
    others = rows.select(*fields, F.col("each").alias("p"), F.col("own").alias("q"), F.lit(False).alias("asks"))
    meet = asked.unionByName(others).withColumn("alone", F.col("blocks") == 1).drop("blocks")
    return stored(meet.groupBy("alone", "share", "p", "q").applyInArrow(_meeting(percent), "a long, b long"), "links")


def _meeting(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        family, ids, component = (table[c].to_numpy() for c in ("family", "id", "component"))
        asks = np.array(table["asks"].to_pylist(), dtype=bool)
        items = table["items"].combine_chunks()
        values, ends = items.flatten().to_numpy(), np.cumsum([0, *(items.value_lengths().to_pylist())])
        order = np.argsort(family, kind="stable")
        found: list[tuple[int, int]] = []
        for group in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            asking, others = group[asks[group]], group[~asks[group]]
            if len(asking) and len(others):
                found += _cross(asking, others, ids, component, values, ends, percent)
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _cross(asking, others, ids, component, values, ends, percent: int) -> Iterator[tuple[int, int]]:
    """Links of the rows ``asking`` to ``others`` of other components, one for each row and component."""
    lists = [values[ends[i] : ends[i + 1]] for i in others]
    sizes = np.array([len(x) for x in lists])
    known, codes = np.unique(np.concatenate(lists), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    for i in asking:
        apart = component[others] != component[i]
        if not apart.any():
            continue
        mine = values[ends[i] : ends[i + 1]]
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        marks = np.zeros(len(known), np.int32)
        marks[at[known[at] == mine]] = 1
        common = np.add.reduceat(marks[codes], starts)
        linked = np.flatnonzero(apart & (100 * common >= percent * (sizes + len(mine) - common)))
        for j in np.unique(component[others[linked]], return_index=True)[1]:
            yield int(ids[i]), int(ids[others[linked[j]]])


def _linked(texts: DataFrame, described: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) that join whatever all links between documents of a bucket join."""
    members = _buckets(described)
    ids = members.select("id").distinct()
    rows = texts.join(ids, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    sets = stored(rows.mapInArrow(_sets(size), "id long, items array<long>"), "sets")
    pairs = _compared(sets, _hub_pairs(members), percent)
    strangers = _strangers(members, pairs)
    drop_stored(members)
    families = components(pairs.select("a", "b"))
    people = _open_people(pairs, families)
    links = pairs.where("linked").select("a", "b")
    links = links if people.isEmpty() else links.union(_family_links(people, sets, percent))
    links = links if strangers.isEmpty() else links.union(_stranger_links(strangers, families, sets, percent))
    drop_stored(sets, people, strangers, families)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``id_col``, n_shingles, component_id and kept of every row.

    Texts are compared by the sets of their ``size``-word shingles (words between ASCII white
    space, A-Z lower-cased; fewer words count as one shingle). Two are linked if
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest id reachable.
    Null, empty and blank texts have no shingles and are linked with nothing. Rows with a null
    id are described, belong to no component and are kept. Rows that share an id are one
    node of the graph, whose links are confirmed on the smallest of their texts. Repeated rows
    come back as often as they occur. An empty table gives an empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = stored(texts.mapInArrow(_describe(size), _DESCRIBED), "described")
    usable = described.where("n > 0 and id is not null")
    classes = usable.groupBy("print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = classes.select(F.col("first").alias("id"), "n", "print", "keys", "copies")
    links = _linked(texts, classes.select("id", "n", "keys"), size, percent)
    copies = usable.join(classes.where("copies > 1").select("print", F.col("id").alias("a")), "print").select("a", F.col("id").alias("b")).where("a != b")
    labels = components(links.union(copies))
    out = described.select("id", "n").join(labels, "id", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``docs``, all columns, with one row of each component: the one of the smallest id; see ``near_duplicates``.

    Of rows that share an id one stays, by the smallest text; rows with a null id all stay.
    """
    kept = near_duplicates(docs, id_col, text_col, size, percent).where("kept").select(F.col(id_col).alias("k_id")).dropna().distinct()
    rows = docs.select(F.struct(*[qcol(c) for c in docs.columns]).alias("row"), qcol(id_col).cast("long").alias("k_id"), qcol(text_col).alias("k_text"))
    known = rows.where("k_id is not null").join(kept, "k_id", "left_semi")
    first = known.withColumn("k_no", F.row_number().over(Window.partitionBy("k_id").orderBy("k_text"))).where("k_no = 1")
    return first.select("row").unionByName(rows.where("k_id is null").select("row")).select("row.*")
