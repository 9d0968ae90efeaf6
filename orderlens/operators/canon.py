"""CP11: fuzzy canonicalisation of text values.

token = upper case without whitespace.  Tokens are ranked by (frequency desc,
token); each token joins the group of the first earlier *leader* whose
similarity is >= threshold, else it leads a new group; every raw value maps to
its group's leader.  Similarity is ``1 - levenshtein / max(length)`` (a
built-in, deterministic stand-in for a per-row sequence matcher).

Candidate pairs are exact without comparing all pairs.  Let ``k`` be the edits that the
threshold allows for the longer of two tokens, of length L.  Cut both into substrings of q
characters: an edit touches at most q of them, so similar tokens share at least
L - q + 1 - kq.  With all substrings put in one order, two tokens that share so many also
share one among the first kq + 1 of the longer one and, for each character that the other
is shorter, one less of the other.  The order is by rarity, so a token is met under
its rarest substrings, and what all tokens have in common (a prefix, a unit) is never used.
A key that is common all the same is dealt to blocks of at most ``BLOCK`` tokens, and a token is
compared with a block inside one row: pairs that are not similar never become rows.
Leaders are fixed by an iterative job over the
distinct tokens: each round decides at least the lowest-ranked undecided token,
rounds go on until none is left, and each is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.operators.running import global_rank
from orderlens.session import materialize_table


def token(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(F.regexp_replace(col.cast("string"), r"\s+", ""))


def _edits(length, threshold: float) -> F.Column:
    """Edits that a pair may have whose longer token has ``length`` characters."""
    return F.floor(length * F.lit(1 - threshold) + F.lit(1e-9)).cast("int")


#: Longest substrings that tokens are met under, and tokens of one key that are compared within a row.
LONGEST_GRAM = 3
BLOCK = 256


def _roles(tokens: DataFrame, threshold: float) -> DataFrame:
    """(token, n, longer, q, keep): for each length of a longer or equal partner, how long the
    substrings are and how many of a token's rarest ones meet it."""
    n = F.length("token")
    longest = F.greatest(n, F.floor(n / F.lit(threshold) + F.lit(1e-9)).cast("int"))
    r = tokens.select("token", n.alias("n"), F.explode(F.sequence(n, longest)).alias("longer"))
    r = r.withColumn("k", _edits(F.col("longer"), threshold)).where((F.col("k") > 0) & (F.col("longer") - F.col("n") <= F.col("k")))
    # q is such that a shared substring is certain: longer - q + 1 - kq >= 1
    q = F.least(F.lit(LONGEST_GRAM), F.floor(F.col("longer") / (F.col("k") + 1)).cast("int"))
    return r.withColumn("q", F.greatest(F.lit(1), q)).select(
        "token", "n", "longer", "q", (F.col("k") * F.col("q") + 1 - (F.col("longer") - F.col("n"))).alias("keep"))


def _rare_first(roles: DataFrame) -> DataFrame:
    """(token, q, grams): the substrings of each token, rarest first; repeats within a token are numbered."""
    held = roles.select("token", "n", "q").distinct()
    plain = F.transform(F.sequence(F.lit(1), F.col("n") - F.col("q") + 1), lambda i: F.substr("token", i, F.col("q")))
    numbered = F.transform(F.col("plain"), lambda g, i: F.struct(
        g.alias("gram"), F.size(F.filter(F.slice(F.col("plain"), 1, i), lambda x: x == g)).alias("nth")))
    each = held.select("token", "q", plain.alias("plain")).select("token", "q", F.explode(numbered).alias("g"))
    counts = each.groupBy("q", "g").agg(F.count(F.lit(1)).alias("tokens"))
    # at most one row for each character of a token
    return each.join(counts, ["q", "g"]).groupBy("token", "q").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("tokens", "g"))), lambda x: x["g"]).alias("grams"))


def candidates(tokens: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(longer, g, block, token) and (longer, g, block, others): tokens meet the blocks of ``others``,
    their longer or equal partners, under every key."""
    roles = _roles(tokens, threshold)
    keys = roles.join(_rare_first(roles), ["token", "q"]).select(
        "token", "n", "longer", F.explode(F.slice("grams", 1, F.col("keep"))).alias("g"))
    own = keys.where("n = longer")
    blocks = own.groupBy("longer", "g").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))
    dealt = own.join(blocks, ["longer", "g"]).groupBy(
        "longer", "g", F.pmod(F.xxhash64("token"), F.col("blocks")).alias("block")).agg(
        F.collect_list("token").alias("others"))
    met = keys.join(blocks, ["longer", "g"]).select(
        "token", "longer", "g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    return met, dealt


def similar_pairs(tokens: DataFrame, threshold: float = 0.92) -> DataFrame:
    """(token, earlier) pairs: ``earlier`` ranks before ``token`` and is similar enough."""
    met, dealt = candidates(tokens.select("token"), threshold)
    similar = lambda a, b: (a != b) & (F.lit(1.0) - F.try_divide(
        F.levenshtein(a, b), F.greatest(F.length(a), F.length(b), F.lit(1))) >= F.lit(threshold))
    pairs = met.join(dealt, ["longer", "g", "block"]).select(
        F.col("token").alias("a"), F.explode(F.filter("others", lambda x: similar(F.col("token"), x))).alias("b")).distinct()
    both = pairs.select(F.col("a").alias("token"), F.col("b").alias("earlier")).unionByName(
        pairs.select(F.col("b").alias("token"), F.col("a").alias("earlier"))).distinct()
    r = tokens.select("token", "rank")
    return (both.join(r, "token").join(r.withColumnRenamed("token", "earlier").withColumnRenamed("rank", "earlier_rank"),
                                       "earlier").where(F.col("earlier_rank") < F.col("rank"))
            .select("token", "rank", "earlier", "earlier_rank"))


def canonical_map(df: DataFrame, col: str, threshold: float = 0.92) -> DataFrame:
    """Mapping ``(raw, token, canonical)`` for one text column; every value gets a leader."""
    raw = df.select(F.col(col).cast("string").alias("raw")).where(F.col("raw").isNotNull())
    freq = raw.select(token("raw").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    # rank of every distinct token by (frequency desc, token): a distributed rank
    tokens = materialize_table(global_rank(freq, [F.col("freq").desc(), F.col("token")]), "canon-tokens")
    pairs = materialize_table(similar_pairs(tokens, threshold), "canon-pairs")
    # status: leader (own token) / follower (leader token); NULL = undecided
    status = tokens.select("token", "rank", F.lit(None).cast("string").alias("leader"))
    left = status.count()
    while left:
        undecided = status.where(F.col("leader").isNull())
        # earlier similar tokens with their current decision
        e = pairs.join(status.select(F.col("token").alias("earlier"), F.col("leader").alias("e_leader")), "earlier")
        agg = e.groupBy("token").agg(
            F.count_if(F.col("e_leader").isNull()).alias("open"),
            F.min_by("earlier", F.when(F.col("e_leader") == F.col("earlier"), F.col("earlier_rank"))).alias("lead"))
        decided = (undecided.join(agg, "token", "left")
                   .where(F.coalesce(F.col("open"), F.lit(0)) == 0)
                   .select("token", F.coalesce(F.col("lead"), F.col("token")).alias("new_leader")))
        status = materialize_table(status.join(decided, "token", "left").select(
            "token", "rank", F.coalesce("leader", "new_leader").alias("leader")), "canon-status")
        before, left = left, status.where(F.col("leader").isNull()).count()
        if left == before:
            raise RuntimeError(f"{left} tokens cannot be decided")
    m = raw.distinct().withColumn("token", token("raw"))
    return m.join(status.select("token", F.col("leader").alias("canonical")), "token").select("raw", "token", "canonical")


def canonicalise(df: DataFrame, cols, threshold: float = 0.92) -> tuple[DataFrame, DataFrame]:
    """Replace each column's values by their canonical token; report distinct
    counts before / after (NULL counted as a value)."""
    out, reports = df, []
    for c in cols:
        m = canonical_map(df, c, threshold).select(F.col("raw").alias(c), F.col("canonical").alias(f"_{c}_canon"))
        before = df.select(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\u0000"))).alias("n")).scalar()
        out = out.join(m, c, "left").withColumn(c, F.col(f"_{c}_canon")).drop(f"_{c}_canon")
        after = out.select(F.count_distinct(F.coalesce(F.col(c), F.lit("\u0000"))).alias("n")).scalar()
        reports.append(df.sparkSession.range(1).select(F.lit(c).alias("column"), before.alias("before_unique"),
                                                       after.alias("after_unique")))
    rep = reports[0]
    for r in reports[1:]:
        rep = rep.unionByName(r)
    return out, rep


def brute_force_map(values, threshold: float = 0.92) -> dict:
    """Reference implementation for tests: same similarity, sequential greedy grouping."""
    from collections import Counter

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]

    toks = ["".join(v.split()).upper() for v in values if v is not None]
    freq = Counter(toks)
    leaders, canon = [], {}
    for t in sorted(freq, key=lambda x: (-freq[x], x)):
        for ld in leaders:
            if 1 - lev(t, ld) / max(len(t), len(ld), 1) >= threshold - 1e-12:
                canon[t] = ld
                break
        else:
            leaders.append(t)
            canon[t] = t
    return canon

