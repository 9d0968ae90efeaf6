"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them).  A flow routes the words of every pattern to the quotas of its sources;
taking a pattern a k-th time costs more than the (k-1)-th, so repetition is
spread evenly and used only where a quota needs it.  The graph has one node per
pattern and source, never one per document.  The flow of a pattern is then laid
over its documents in a seeded order: copy k of a document occupies a range on a
tape of ``k * words of the pattern + words before it``, and it is taken when the
middle of its range lies within the flow.

Defined cases: null size counts as 0; a document without words is never taken; a
null source is a source of its own that sorts last; an empty table yields no
rows; repeated ids are separate documents that share one place in the order.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, row_blocks, words

#: Patterns plus sources that the driver's flow graph may hold; beyond it the operator stops with an error.
MAX_NODES = 200_000


def capped_targets(sizes: list[int], weights: list[int], times: int = 3, total: int | None = None) -> list[Fraction]:
    """Shares of ``total`` (by default sum(sizes)) by weight, none above ``times`` its
    size; the excess is shared again by weight among the others until none is above."""
    total = sum(sizes) if total is None else total
    target = [Fraction(0)] * len(sizes)
    free, left = set(range(len(sizes))), Fraction(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        above = [i for i in free if unit * weights[i] > times * sizes[i]]
        if not above:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in above:
            target[i] = Fraction(times * sizes[i])
            left -= target[i]
            free.discard(i)
    return target


def whole_quotas(targets: list[Fraction]) -> list[int]:
    """Integers near the targets with the same (rounded) sum: largest remainders first."""
    floors = [int(t) for t in targets]
    short = round(sum(targets)) - sum(floors)
    order = sorted(range(len(targets)), key=lambda i: (floors[i] - targets[i], i))
    for i in order[:short]:
        floors[i] += 1
    return floors


def route(words: list[int], members: list[list[int]], quotas: list[int], times: int = 3) -> list[dict[int, int]]:
    """Flow from pattern p to each of its sources: as much of the quotas as can be
    met, at least total cost, where the k-th pass over a pattern costs k a word.

    Primal-dual: shortest distances give potentials, and a blocking flow then saturates every
    path of that cost at once.  Passes cost 0 to ``times - 1``, so there are few different costs.
    """
    n_p, n_s = len(words), len(quotas)
    sink = 1 + n_p + n_s
    to: list[int] = []             # arc i and i ^ 1 are each other's reverse
    room: list[int] = []
    price: list[int] = []
    out: list[list[int]] = [[] for _ in range(sink + 1)]

    def arc(a, b, capacity, cost):
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((capacity, 0))
        price.extend((cost, -cost))
        return len(to) - 2

    links: list[dict[int, int]] = []
    for p in range(n_p):
        for k in range(times):
            arc(0, 1 + p, words[p], k)
        links.append({s: arc(1 + p, 1 + n_p + s, times * words[p], 0) for s in members[p]})
    for s in range(n_s):
        arc(1 + n_p + s, sink, quotas[s], 0)

    potential = [0] * (sink + 1)

    def distances():
        dist: list = [None] * (sink + 1)
        dist[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for i in out[a]:
                if room[i] > 0:
                    b = to[i]
                    nd = d + price[i] + potential[a] - potential[b]
                    if dist[b] is None or nd < dist[b]:
                        dist[b] = nd
                        heapq.heappush(heap, (nd, b))
        return dist

    def levels():
        """Arcs between nodes on the cheapest paths, by breadth."""
        level = [-1] * (sink + 1)
        level[0], queue = 0, [0]
        for a in queue:
            for i in out[a]:
                b = to[i]
                if room[i] > 0 and level[b] < 0 and price[i] + potential[a] == potential[b]:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def block(level):
        """Push along paths of rising level until none is left; each node goes through its arcs once."""
        nxt, path, a = [0] * (sink + 1), [], 0
        while True:
            if a == sink:
                push = min(room[i] for i in path)
                for i in path:
                    room[i] -= push
                    room[i ^ 1] += push
                # back to the first arc that is full
                keep = next(k for k, i in enumerate(path) if room[i] == 0)
                a = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while nxt[a] < len(out[a]):
                i = out[a][nxt[a]]
                b = to[i]
                if room[i] > 0 and level[b] == level[a] + 1 and price[i] + potential[a] == potential[b]:
                    path.append(i)
                    a = b
                    break
                nxt[a] += 1
            else:
                if not path:
                    return
                a = to[path.pop() ^ 1]
                nxt[a] += 1

    while True:
        dist = distances()
        if dist[sink] is None:
            break
        far = max(d for d in dist if d is not None)
        potential = [v + (far if d is None else d) for v, d in zip(potential, dist)]
        while (level := levels())[sink] >= 0:
            block(level)
    return [{s: room[i ^ 1] for s, i in d.items()} for d in links]


def mix(docs: DataFrame, members: Column, size: Column, order_key: Column, carry: list[str],
        weights=None, times: int = 3) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, then size, source_size,
    target, taken and copies (the source of every taken copy, in order).

    ``members`` is an array of source names (null allowed), ``order_key`` a hex
    digest that gives the seeded order.  ``weights`` maps the sorted sources to
    their weights; by default they weigh 1, 2, 3, repeating.  ``source_size`` and
    ``target`` are those of the first source of the row's pattern.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    buckets = row_blocks(docs.count(), 10_000, 64)
    carried = F.struct(*carry)
    sized = docs.select(
        carried.alias("row"), F.xxhash64(*carry).alias("tie"), order_key.alias("key"),
        F.array_sort(F.array_distinct(members)).alias("members"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
    ).withColumn("pattern", F.to_json("members")).withColumn(
        "bucket", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint") * F.lit(buckets), 32))

    # words by pattern and stretch of the seeded order: all the driver needs comes from this small table
    totals = scratch.write(sized.groupBy("pattern", "bucket").agg(
        F.first("members").alias("members"), F.sum("size").alias("words")), "totals")
    per_pattern = totals.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("words").alias("words"))
    found = per_pattern.orderBy("pattern").limit(MAX_NODES + 1).collect()
    plan_df = spark.createDataFrame(
        flow_plan(found, weights or default_weights, times),
        "pattern string, words bigint, source_size bigint, target double, flow bigint, "
        "ends array<struct<source:string,until:bigint>>")

    # running sum in the seeded order without one task per source: offsets of the stretches, then sums inside each
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pattern", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")) \
        .join(plan_df, "pattern")
    inside = Window.partitionBy("pattern", "bucket").orderBy("key", "size", "tie") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(offsets, ["pattern", "bucket"])

    def twice_middle(k):
        return 2 * (k.cast("bigint") * F.col("words") + F.col("offset") + F.col("within")) + F.col("size")

    passes = F.filter(F.sequence(F.lit(0), F.lit(times - 1)), lambda k: twice_middle(k) < 2 * F.col("flow"))
    copies = F.when(F.col("size") > 0, F.transform(passes, lambda k: F.filter(
        F.col("ends"), lambda e: twice_middle(k) < 2 * e["until"])[0]["source"])) \
        .otherwise(F.array().cast("array<string>"))
    return placed.withColumn("copies", copies).select(
        "row.*", "size", "source_size", "target", (F.col("size") * F.size("copies")).alias("taken"), "copies")


def flow_plan(found: list, weights, times: int) -> list[tuple]:
    """Rows (pattern, words, source size, target, flow, ends of the sources' stretches of the flow)."""
    names = sorted({m for r in found for m in r["members"]}, key=lambda m: (m is None, m or ""))
    if len(found) + len(names) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} membership patterns and sources")
    at = {m: i for i, m in enumerate(names)}
    own = [0] * len(names)
    for r in found:
        for m in r["members"]:
            own[at[m]] += r["words"]
    # shares are taken of all words, each document counted once, also where sources overlap
    total = sum(r["words"] for r in found if r["members"])
    targets = capped_targets(own, weights(names), times, total)
    flows = route([r["words"] for r in found], [[at[m] for m in r["members"]] for r in found],
                  whole_quotas(targets), times)
    plan = []
    for r, flow in zip(found, flows):
        ends, end = [], 0
        for s in sorted(flow):
            end += flow[s]
            ends.append((names[s], end))
        first = at[r["members"][0]] if r["members"] else None
        plan.append((r["pattern"], r["words"], 0 if first is None else own[first],
                     0.0 if first is None else float(targets[first]), end, ends))
    return plan


def default_weights(names: list) -> list[int]:
    return [1 + i % 3 for i in range(len(names))]


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(words(text)).cast("bigint")


def seeded_key(id_col: Column, seed: int = 0, text: Column | None = None) -> Column:
    """Order of the documents: hex digest of seed and id; a document without an id goes by its text."""
    instead = F.lit("") if text is None else F.concat(F.lit("text "), F.sha2(F.coalesce(text, F.lit("")), 256))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), instead)))
