"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

1. Every document gets the set of its 5-word shingles, a digest of that set, one
   hash per band and a sketch (one byte of every MinHash).  Documents with the
   same set form a *class*; only one representative per class goes on, so exact
   copies never meet each other.
2. Representatives that share a band hash are candidates.  Bands and rows per
   band follow from the similarity threshold and the recall wanted there.
3. Candidates are compared in blocks instead of row by row.  Every shared band
   hash (bucket) belongs to a *context*: the cluster of its best connected
   representative.  All members of a context's buckets are cut into blocks of
   bounded size, and any two blocks of a context meet in one task.  A pair that
   shares several buckets belongs to the context of the smallest of them, so it is
   compared once.  No pair becomes a row, however many near copies a group has.
4. In a pair of blocks the sketches sort out what cannot be similar; the rest is
   verified on the full sets, which are only made for representatives still in
   question.  A task returns the number of links of each member, and the links
   that connect its members (a spanning forest).
5. These links give connected components, by repeated joins.

Result: one row per document with the number of documents it is linked to and
its class, the smallest id of its component.

Defined cases: null text counts as empty; a text without words has no shingle and no
link; a text of 1 to 4 words has one shingle, all its words; repeated rows are
documents of one class; null ids are carried and rank last; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, free_name, one_of_repeats
from orderlens.llm.hashing import U64, mix64, row_grams, separator_table, text_groups, word_hashes, word_spans

NGRAM = 5
SIMILARITY = 0.8
RECALL = 0.9999
#: Members of a block, about.
BLOCK = 256
#: Share of equal sketch bytes below which a pair is not verified: at the similarity
#: threshold it falls short of that by chance in less than one of 10^6 pairs.
SKETCH_SHARE = 0.6
#: Shingles that are compared at once in a pair of blocks.
COLUMNS = 1 << 16
#: Keeps rounding errors on the side of verification.
MARGIN = 1e-9


def banding(similarity: float = SIMILARITY, recall: float = RECALL, max_rows: int = 5) -> tuple[int, int]:
    """(bands, rows per band): the most selective bands whose recall at the threshold
    is reached with at most 24 bands, else the fewest bands of one row."""
    for rows in range(max_rows, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
        if bands <= 24:
            return bands, rows
    return bands, 1


def _sets(data, offsets, lut, n):
    starts, ends, first = word_spans(data, offsets, lut)
    return row_grams(word_hashes(data, starts, ends), first, n)


def signature_task(n: int, bands: int, rows: int, seed: int = 1):
    rng = np.random.default_rng(seed)
    salts = rng.integers(0, 2**64, bands * rows, dtype=np.uint64)
    factors = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | U64(1)
    lut = separator_table()

    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for lo, data, offsets in text_groups(batch.column(2)):
                grams, at = _sets(data, offsets, lut, n)
                count = len(at) - 1
                full = np.flatnonzero(np.diff(at))
                bandh = np.zeros((count, bands), U64)
                sketch = np.zeros((count, bands * rows), np.uint8)
                sizes = np.zeros(count, np.int32)
                digests = [None] * count
                for r in full:
                    own = np.unique(grams[at[r]:at[r + 1]])
                    sizes[r] = len(own)
                    digests[r] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if len(full):
                    for b in range(bands):
                        h = np.full(len(full), b + 1, U64)
                        for k in range(b * rows, (b + 1) * rows):
                            # rows without grams take no room, so the starts of the others are strictly rising
                            least = np.minimum.reduceat((grams ^ salts[k]) * factors[k], at[full])
                            h = mix64(h * U64(31) + least)
                            sketch[full, k] = mix64(least) & U64(255)
                        bandh[full, b] = h
                flat = pa.array(bandh.reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, count), keys.slice(lo, count), pa.array(digests, pa.binary()),
                     pa.array(sizes), lists, pa.array([x.tobytes() for x in sketch], pa.binary())],
                    ["id", "text_key", "node", "n_grams", "bands", "sketch"])
    return run


def grams_task(n: int):
    """(node, text) -> (node, grams): sorted distinct shingle hashes; the node is computed anew."""
    lut = separator_table()

    def run(batches):
        for batch in batches:
            for _, data, offsets in text_groups(batch.column(0)):
                grams, at = _sets(data, offsets, lut, n)
                own = [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:]) if b > a]
                nodes = [hashlib.blake2b(g.tobytes(), digest_size=16).digest() for g in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()),
                     pa.array([g.view(np.int64) for g in own], pa.list_(pa.int64()))], ["node", "grams"])
    return run


GROUP = ["d", "u", "v"]


def groups(batches, names: list[str]):
    """Runs of rows of one pair of blocks, of a partition sorted by ``GROUP``, as columns."""
    key, held = None, []
    for batch in batches:
        ids = np.stack([batch.column(c).to_numpy() for c in GROUP], axis=1)
        cut = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(ids)]):
            if lo == hi:
                continue
            part, mine = batch.slice(lo, hi - lo), tuple(ids[lo].tolist())
            if held and key != mine:
                yield key, [pa.chunked_array([p.column(n) for p in held]).combine_chunks() for n in names]
                held = []
            key = mine
            held.append(part)
    if held:
        yield key, [pa.chunked_array([p.column(n) for p in held]).combine_chunks() for n in names]


def owned_pairs(side: np.ndarray, same: bool, owner: np.ndarray, bucket: np.ndarray, context: np.ndarray, mine: int):
    """Pairs that this pair of blocks compares: each once (in a block with itself, or
    across the two), and only where the smallest bucket the two share is of context ``mine``.

    ``owner``, ``bucket`` and ``context`` list all buckets of all members.
    """
    count = len(side)
    open_ = np.triu(np.ones((count, count), bool), 1) if same else (side[:, None] == 0) & (side[None, :] == 1)
    out = np.zeros((count, count), bool)
    order = np.argsort(bucket, kind="stable")
    owner, bucket, context = owner[order], bucket[order], context[order]
    cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for lo, hi in zip([0, *cut], [*cut, len(bucket)]):
        if hi - lo > 1:
            members = np.ix_(owner[lo:hi], owner[lo:hi])
            if context[lo] == mine:
                out[members] |= open_[members]
            open_[members] = False
    return out


def flat(lists: pa.Array):
    """(row, values) of a list column."""
    ends = lists.offsets.to_numpy()
    return np.repeat(np.arange(len(lists)), np.diff(ends)), lists.values.slice(ends[0], ends[-1] - ends[0])


def sketch_task(similarity: float):
    """Members of pairs of blocks -> those with a partner that their sketches leave
    possible, each with its place in the group and those of its partners."""
    def run(batches):
        for (d, u, v), (side, node, n, sketch, buckets) in groups(
                batches, ["side", "node", "n_grams", "sketch", "buckets"]):
            if len(node) < 2:
                continue
            size = n.to_numpy()
            rows = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(node), -1)
            owner, held = flat(buckets)
            maybe = owned_pairs(side.to_numpy(), u == v, owner, held.field(0).to_numpy(), held.field(1).to_numpy(), d)
            maybe &= np.minimum(size[:, None], size) >= (similarity - MARGIN) * np.maximum(size[:, None], size)
            for i in np.flatnonzero(maybe.any(axis=1)):
                j = np.flatnonzero(maybe[i])
                maybe[i, j] = (rows[j] == rows[i]).sum(axis=1) >= SKETCH_SHARE * rows.shape[1]
            pick = np.flatnonzero(maybe.any(axis=0) | maybe.any(axis=1))
            if len(pick):
                first, second = np.nonzero(maybe[pick])
                ends = np.searchsorted(first, np.arange(len(pick) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pick), x)) for x in (d, u, v)]
                    + [pa.array(pick.astype(np.int32)), node.take(pa.array(pick)),
                       pa.ListArray.from_arrays(pa.array(ends), pa.array(second.astype(np.int32)))],
                    [*GROUP, "place", "node", "partners"])
    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by packed bits over the shingles that occur twice."""
    count = len(sets)
    out = np.zeros((count, count), np.int64)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    values, back, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    use = times[back] > 1
    owner, column = owner[use], column[back[use]]
    for lo in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        here = (column >= lo) & (column < lo + COLUMNS)
        width = min(COLUMNS, -(-(int(column.max()) + 1 - lo) // 64) * 64)
        bits = np.zeros((count, width), bool)
        bits[owner[here], column[here] - lo] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(count):
            out[i] += np.bitwise_count(packed & packed[i]).sum(axis=1, dtype=np.int64)
    return out


def verify_task(similarity: float):
    """Members of pairs of blocks with their sets -> (a, null, linked documents) and connecting links (a, z, 0)."""
    def run(batches):
        for _, (place, node, partners, docs, grams) in groups(batches, ["place", "node", "partners", "docs", "grams"]):
            if len(node) < 2:
                continue
            at = {p: i for i, p in enumerate(place.to_pylist())}
            first, second = flat(partners)
            second = np.array([at[p] for p in second.to_pylist()], np.int64)
            values, ends = grams.values.to_numpy(), grams.offsets.to_numpy()
            sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
            size, both = np.diff(ends), intersections(sets)[first, second]
            hit = both >= (similarity - MARGIN) * (size[first] + size[second] - both)
            linked = np.zeros((len(node), len(node)), bool)
            linked[first[hit], second[hit]] = linked[second[hit], first[hit]] = True
            near = linked @ docs.to_numpy()
            hit = np.flatnonzero(near)
            if not len(hit):
                continue
            forest = spanning(linked)
            names = node.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in hit] + [names[i] for i, _ in forest], pa.binary()),
                 pa.array([None] * len(hit) + [names[j] for _, j in forest], pa.binary()),
                 pa.array(near[hit].tolist() + [0] * len(forest), pa.int64())], ["a", "z", "near"])
    return run


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest."""
    left, out = set(range(len(linked))), []
    while left:
        todo = [left.pop()]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(linked[i]):
                if j in left:
                    left.discard(j)
                    out.append((i, int(j)))
                    todo.append(int(j))
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
               similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(id, text_key, node, n_grams, bands): the node is the digest of the shingle set, null without words."""
    bands, rows = banding(similarity, recall)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(
        signature_task(n, bands, rows),
        f"id {dict(docs.dtypes)[id_col]}, text_key bigint, node binary, n_grams int, bands array<bigint>, sketch binary")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM,
         similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(id, text_key, class_id, links, keeps): see the module's head; ``keeps`` marks the
    rows (id, text) of which one stays when near copies are removed."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    every = scratch.write(signatures(docs, id_col, text_col, n, similarity, recall), "signatures")
    classes = scratch.write(
        every.where("node is not null").groupBy("node").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("rep"),
            F.count(F.lit(1)).alias("docs"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch")), "classes")
    sig = scratch.write(every.select("id", "text_key", "node"), "nodes")
    scratch.drop("signatures")

    # candidates: representatives by shared band hash, each in the cluster of the best connected one
    buckets = classes.select("node", F.explode("bands").alias("b"))
    shared = scratch.write(buckets.groupBy("b").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    rows = scratch.write(buckets.join(shared, "b"), "rows")
    ranks = rows.groupBy("node").agg(F.sum("size").alias("rank"))
    ranked = scratch.write(rows.select("b", "node").join(ranks, "node"), "ranked")
    centres = scratch.write(ranked.groupBy("b").agg(F.max(F.struct("rank", "node")).alias("centre")), "centres")
    cluster = scratch.write(
        ranked.select("b", "node").join(centres, "b").groupBy("node").agg(F.max("centre").alias("centre"))
        .select("node", F.col("centre.node").alias("cluster")), "cluster")

    # contexts of the buckets, their members in blocks, and every pair of blocks of a context
    context = centres.select("b", F.col("centre.node").alias("node")).join(cluster, "node") \
        .select("b", F.xxhash64("cluster").alias("d"))
    located = scratch.write(rows.select("b", "node").join(context, "b"), "located")
    inside = located.select("d", "node").distinct()
    cut = inside.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))
    buckets = located.groupBy("node").agg(F.collect_list(F.struct("b", "d")).alias("buckets"))
    members = classes.select("node", "n_grams", "sketch").join(buckets, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = inside.join(cut, "d").select("d", "node", own.alias("k"), F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("j"))
    possible = scratch.write(
        met.select("d", F.least("k", "j").alias("u"), F.greatest("k", "j").alias("v"),
                   (F.col("k") > F.col("j")).cast("int").alias("side"), "node").join(members, "node")
        .repartition(*GROUP).sortWithinPartitions(*GROUP)
        .mapInArrow(sketch_task(similarity), "d bigint, u bigint, v bigint, place int, node binary, partners array<int>"),
        "possible")
    scratch.drop("shared", "rows", "ranked", "centres", "cluster", "located")
    scratch.release()

    # full sets of the representatives in question, brought to their pairs of blocks
    wanted = possible.select("node").distinct().join(classes.select("node", "docs", "rep"), "node")
    keys = wanted.select(F.col("rep.id").alias("rid"), F.col("rep.text_key").alias("rkey"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("text_key", F.xxhash64("text"))
    hit = texts.join(keys.hint("shuffle_hash"),
                     texts["id"].eqNullSafe(F.col("rid")) & (texts["text_key"] == F.col("rkey")), "left_semi")
    sets = hit.select("text").mapInArrow(grams_task(n), "node binary, grams array<bigint>").dropDuplicates(["node"])
    verified = scratch.write(
        possible.join(classes.select("node", "docs"), "node").join(sets, "node")
        .select(*GROUP, "place", "node", "partners", "docs", "grams")
        .repartition(*GROUP).sortWithinPartitions(*GROUP)
        .mapInArrow(verify_task(similarity), "a binary, z binary, near bigint"), "verified")
    scratch.drop("possible")
    scratch.release()

    # number of linked documents: own class and verified links
    near = verified.where("z is null").groupBy(F.col("a").alias("node")).agg(F.sum("near").alias("near"))
    counted = classes.select("node", "rep", "docs").join(near, "node", "left").select(
        "node", "rep", (F.col("docs") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    edges = verified.where("z is not null").select(F.col("a").alias("u"), F.col("z").alias("v")).distinct()
    label = components(edges, scratch).withColumnRenamed("vertex", "node")
    placed = scratch.write(counted.join(label, "node", "left").withColumn("root", F.coalesce("label", "node")), "placed")
    first = scratch.write(placed.groupBy("root").agg(F.min("rep").alias("first")), "first")
    named = placed.join(first, "root").select("node", "links", "first")

    out = sig.select("id", "text_key", "node").join(named, "node", "left")
    return out.select(
        "id", "text_key",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("links"),
        (F.col("node").isNull() | (F.col("id").eqNullSafe(F.col("first.id"))
                                   & (F.col("text_key") == F.col("first.text_key")))).alias("keeps"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(vertex, label): the smallest vertex of each connected component.

    Each round every vertex takes the smallest label among its neighbours', then
    the label of that label, until nothing changes; each round is a stored table.
    """
    both = scratch.write(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    labels = scratch.write(both.groupBy(F.col("u").alias("vertex")).agg(
        F.least(F.min("v"), F.col("vertex")).alias("label")), "labels-0")
    step = 0
    while True:
        near = both.join(labels.select(F.col("vertex").alias("v"), F.col("label").alias("l")), "v") \
            .groupBy("u").agg(F.min("l").alias("l"))
        lower = labels.join(near.withColumnRenamed("u", "vertex"), "vertex") \
            .select("vertex", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = lower.select(F.col("vertex").alias("label"), F.col("label").alias("next"))
        step += 1
        new = scratch.write(
            lower.join(jump, "label", "left").select("vertex", "old", F.least("label", "next").alias("label")),
            f"labels-{step}")
        changed = new.where("old != label").limit(1).count()
        scratch.drop(f"labels-{step - 1}")
        labels = new.select("vertex", "label")
        if not changed:
            return labels


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """Rows of ``docs`` of which one stays for each class of near copies."""
    keep, key, mine, n = (free_name(docs, x) for x in ("keep", "key", "mine", "rows"))
    kept = join(docs, id_col, text_col, **kwargs).where("keeps").groupBy(
        F.col("id").alias(keep), F.col("text_key").alias(key)).agg(F.count(F.lit(1)).alias(n))
    rows = docs.withColumn(mine, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    hit = rows.join(kept.hint("shuffle_hash"), rows[id_col].eqNullSafe(kept[keep]) & (rows[mine] == kept[key]))
    return one_of_repeats(hit, n, [id_col, mine]).select(*docs.columns)
