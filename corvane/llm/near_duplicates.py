"""Near duplicates: b-bit MinHash signatures and a multi-index Hamming join, links confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.llm.common import release, require
from corvane.llm.wordhash import blocks, mix, sequence_hashes, shingle_sets
from corvane.operators.groups import connected_components
from corvane.session import cut

#: A signature: so many symbols of sixteen bits, one of each MinHash function.
SYMBOLS, BITS = 64, 16
#: The share of linked pairs, of the least likeness that is linked, whose signatures may be farther apart than `distance_for` allows.
MISSED = 1e-7
#: Ids that are broadcast to pick rows from the corpus (16 bytes each); above, the rows are joined by shuffle.
MOST_BROADCAST_IDS = 2_000_000

#: Documents and shingles that one side of a comparison of a family's parts holds, about.
PART_DOCUMENTS, PART_SHINGLES = 4096, 2_000_000

_rng = np.random.default_rng(77)
_MULTIPLY = (_rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_ADD = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)[:, None]
_SALT = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The symbols of a non-empty shingle set."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (_MULTIPLY * shingles[None, i : i + 2048] + _ADD).min(axis=1), out=least)
    return (mix(least) >> np.uint64(64 - BITS)).astype(np.uint16)


def distance_for(percent: int, missed: float = MISSED) -> int:
    """The least distance that all but `missed` of the pairs of this likeness keep (more alike pairs, more of them).

    missed=0: every distance but that of signatures without one common symbol, which linked pairs have once in 1e52.
    """
    p, above, d = 1 - percent / 100, 1.0, -1
    while above > missed and d < SYMBOLS - 1:
        d += 1
        above -= comb(SYMBOLS, d) * p**d * (1 - p) ** (SYMBOLS - d)
    return d


def chunk_plan(distance: int) -> list[tuple[int, ...]]:
    """The positions of every key: each chunk with each of its symbols left out.

    In distance // 2 + 1 chunks, `distance` errors leave one chunk with at most one error, by pigeonhole. So
    signatures within the distance agree in all but one symbol of some chunk, and share a key.
    """
    chunks = np.array_split(np.arange(SYMBOLS), distance // 2 + 1)
    return [tuple(x for x in c.tolist() if x != out) for c in chunks for out in c.tolist()]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        counts, first, second, signs = [], [], [], []
        for _, _, words in blocks(batch.column("text")):
            for shingles, (h1, h2) in zip(shingle_sets(words), sequence_hashes(words), strict=True):
                counts.append(len(shingles))
                first.append(h1)
                second.append(h2)
                signs.append(signature(shingles).view(np.int64).tolist() if len(shingles) else None)
        columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (counts, first, second)), pa.array(signs, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "h1", "h2", "signature"])


def _keys(distance: int):
    plan = chunk_plan(distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            signs = np.array(batch.column("signature").to_pylist(), np.int64).view(np.uint16).reshape(len(nodes), SYMBOLS)
            salted = (signs.astype(np.uint64) + np.uint64(1)) * _SALT
            for at in range(0, len(nodes), 4096):
                part = salted[at : at + 4096]
                keys = [mix(part[:, list(p)].sum(axis=1) + np.uint64((k + 1) << 20)) for k, p in enumerate(plan)]
                flat = np.concatenate(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.tile(nodes[at : at + 4096], len(plan)))], names=["key", "node"])

    return run


def differing(a: Column, b: Column) -> Column:
    """In how many of the symbols two signatures (arrays of longs) differ."""

    low, high = 0x7FFF7FFF, 0x80008000

    def half(x: Column) -> Column:
        # The top bit of each 16-bit lane is set where the lane isn't zero.
        return F.bit_count((x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x).bitwiseAND(F.lit(high)))

    def of(i: int) -> Column:
        x = a[i].bitwiseXOR(b[i])
        return half(x.bitwiseAND(F.lit(0xFFFFFFFF))) + half(F.shiftrightunsigned(x, 32))

    return sum((of(i) for i in range(1, SYMBOLS * BITS // 64)), of(0))


def _near(percent: int, distance: int) -> Column:
    sizes = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    return sizes & (differing(F.col("sa"), F.col("sb")) <= distance)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            links = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                left = [s for _, _, words in blocks(part.column("ta")) for s in shingle_sets(words)]
                # Pairs come sorted by b, whose text is often the same.
                change = [i for i in range(len(b)) if i == 0 or b[i] != b[i - 1]]
                heads = [s for _, _, words in blocks(part.column("tb").take(pa.array(change, pa.int64()))) for s in shingle_sets(words)]
                which = np.searchsorted(change, np.arange(len(b)), "right") - 1
                for i in range(len(a)):
                    x, y = left[i], heads[which[i]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both and 100 * both >= percent * (len(x) + len(y) - both):
                        links.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose texts' shingle sets are alike enough."""
    pairs = cut(pairs.select("a", "b").distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = cut(ids)
    few = ids.count() <= MOST_BROADCAST_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "doc_id")
    side = lambda id_, text: wanted.select(F.col("doc_id").alias(id_), F.col("text").alias(text))
    both = pairs.join(side("a", "ta"), "a").join(side("b", "tb"), "b")
    return both.select("a", "ta", "b", "tb").mapInArrow(_confirm(percent), "a long, b long")


def _links_within(percent: int, distance: int):
    """Links among the documents (node, part, signature, text) of one task (family, i, j): within part i, or between i and j.

    Signatures first, then exact intersections; a document is not compared with those that it is already
    joined to, and one link is kept for each component that it joins.
    """

    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        table = table.sort_by("node")
        node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
        signs = np.array(table.column("signature").to_pylist(), np.int64).view(np.uint16).reshape(len(node), SYMBOLS)
        sets = [s for _, _, words in blocks(table.column("text").combine_chunks()) for s in shingle_sets(words)]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        starts = np.cumsum(sizes) - sizes
        names, ids = np.unique(np.concatenate(sets), return_inverse=True)
        mark, label, links = np.zeros(len(names), bool), np.arange(len(node)), []
        for x in range(1, len(node)):
            near = (label[:x] != label[x]) & (100 * np.minimum(sizes[:x], sizes[x]) >= percent * np.maximum(sizes[:x], sizes[x]))
            if i != j:
                near &= part[:x] != part[x]
            to = np.flatnonzero(near)
            to = to[(signs[to] != signs[x]).sum(axis=1) <= distance]
            if not len(to):
                continue
            mark[ids[starts[x] : starts[x] + sizes[x]]] = True
            first = np.cumsum(sizes[to]) - sizes[to]
            hits = mark[ids[np.repeat(starts[to] - first, sizes[to]) + np.arange(first[-1] + sizes[to[-1]])]]
            both = np.add.reduceat(hits, first, dtype=np.int64)
            mark[ids[starts[x] : starts[x] + sizes[x]]] = False
            for y in to[100 * both >= percent * (sizes[to] + sizes[x] - both)]:
                if label[y] != label[x]:
                    links.append((node[x], node[y]))
                    label[label == label[y]] = label[x]
        return pa.table([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])

    return run


def components(documents: DataFrame, percent: int = 80, missed: float = MISSED) -> DataFrame:
    """Classes of near duplicates among documents (doc_id, text).

    Documents are linked if their sets of 5-word shingles (words A-Z lower-cased) share at least `percent`
    of their union. Equal word sequences are one node. Nodes whose signatures agree on a chunk, but for the
    error it may hold, meet under its key (`chunk_plan`). Under each key the nodes are compared, signatures
    only, with the one of them that has most company in all its keys; nodes near such a hub form families. A
    family's texts meet in tasks of bounded size that confirm links on full sets and give no more of them than
    join its components. Pairs under a key from different families are compared in a join that gives only
    those near by signature, and confirmed on full sets too. So no pair is left out that the signatures admit,
    and what is written for a group of copies grows with its size, not its square. Signatures admit all but
    `missed` of the pairs that are just alike enough; missed=0 admits all, and compares many more pairs for it.

    Null, empty or blank text: no shingles, linked with nothing. Fewer than five words: one shingle of all.
    Repeated rows fall together; a doc_id with several texts is one document with the links of all. Null
    doc_id: its own class null, unless its words equal another document's. Extra columns are left aside.
    Returns doc_id, n_shingles, component_id, kept.
    """
    docs = require(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    distance = distance_for(percent, missed)
    schema = "doc_id long, n_shingles long, h1 long, h2 long, signature array<long>"
    sketches = cut(docs.mapInArrow(_sketch, schema))
    same = sketches.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"), F.min("signature").alias("signature")
    )
    same = cut(same)
    nodes = same.where("node is not null").select("node", "n", "signature")
    keys = nodes.select("node", "signature").mapInArrow(_keys(distance), "key long, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size")).where("low < high")
    members = cut(keys.join(shared.select("key", "size"), "key"))
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    hubs = members.join(company, "node").groupBy("key").agg(F.max_by("node", F.struct("company", -F.col("node"))).alias("hub"))
    stars = members.join(hubs, "key").where("node <> hub").select(F.least("node", "hub").alias("b"), F.greatest("node", "hub").alias("a")).distinct()
    signs = lambda id_, n, s: nodes.select(F.col("node").alias(id_), F.col("n").alias(n), F.col("signature").alias(s))
    near = stars.join(signs("a", "na", "sa"), "a").join(signs("b", "nb", "sb"), "b").where(_near(percent, distance)).select("a", "b")
    family = connected_components(near).select("node", F.col("component").alias("family"))
    placed = cut(nodes.join(family, "node"))
    parts_ = F.greatest(F.ceil(F.count("*") / PART_DOCUMENTS), F.ceil(F.sum("n") / PART_SHINGLES)).cast("int")
    wide = placed.groupBy("family").agg(parts_.alias("parts"))
    dealt = placed.join(wide, "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    few = placed.count() <= MOST_BROADCAST_IDS
    dealt = dealt.select(F.col("node").alias("doc_id"), "family", "parts", "part", "signature")
    texts = docs.join(F.broadcast(dealt.select("doc_id").distinct()) if few else dealt.select("doc_id").distinct(), "doc_id", "left_semi")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tasks = dealt.withColumn("other", other).select(
        F.col("doc_id").alias("node"), "family", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "signature"
    )
    met = tasks.join(texts.withColumnRenamed("doc_id", "node"), "node")
    within = met.groupBy("family", "i", "j").applyInArrow(_links_within(percent, distance), "a long, b long")
    # Keys whose nodes are of several families.
    named = members.select("key", "node").join(family, "node", "left").select("key", "node", F.coalesce("family", "node").alias("c"))
    open_ = named.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("key")
    rest = named.join(open_, "key").join(nodes, "node")
    left = rest.select("key", F.col("node").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    right = rest.select("key", F.col("node").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    across = left.join(right, (left["key"] == right["key"]) & (F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb")) & _near(percent, distance))
    found = connected_components(within.unionByName(confirmed(across.select("a", "b"), docs, percent)))
    classes = same.join(found, "node", "left").select("h1", "h2", F.coalesce("component", "node").alias("class"))
    # A doc_id with several texts has one class: its texts are one node.
    linked = sketches.where("n_shingles > 0").join(classes, ["h1", "h2"]).select("doc_id", "n_shingles", "class")
    alone = sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("class"))
    return linked.unionByName(alone).select(
        "doc_id", "n_shingles", F.col("class").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("class")).alias("kept")
    )


def drop_near_duplicates(documents: DataFrame, percent: int = 80, missed: float = MISSED) -> DataFrame:
    """documents without those that their class's first document stands for; repeated rows stay once.

    Null, empty and blank texts are like no other and stay; of several texts of one doc_id the first stays.
    Rows with null doc_id stay as they are. All columns are kept, whatever their names. No documents: no rows.
    """
    kept = components(documents, percent, missed).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = cut(kept.withColumnRenamed("doc_id", "kept_id"))
    few = kept.count() <= MOST_BROADCAST_IDS
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole"))
    chosen = whole.join(F.broadcast(kept) if few else kept, F.col("whole.doc_id") == F.col("kept_id"))
    first = W.partitionBy("kept_id").orderBy(F.col("whole.text").asc_nulls_last())
    repeated = chosen.where("rows > 1").withColumn("turn", F.row_number().over(first)).where("turn = 1")
    parts = [chosen.where("rows = 1"), repeated, whole.where("whole.doc_id is null")]
    return parts[0].select("whole.*").unionByName(parts[1].select("whole.*")).unionByName(parts[2].select("whole.*"))
