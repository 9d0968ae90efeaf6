"""Print the executed physical plan of a DataFrame with per-node SQL metrics.

Runs the action itself (noop write) and then walks the final adaptive plan via
the JVM, so no web UI is involved.
"""

from __future__ import annotations

INTERESTING = ("time", "duration", "number of output rows", "spill", "data size", "shuffle bytes written")


def run_with_metrics(df, min_ms: int = 200):
    qe = df._jdf.queryExecution()
    spark = df.sparkSession
    # execute through the same QueryExecution so metrics land on its plan
    df.write.format("noop").mode("overwrite").save()
    plan = spark._jvm.org.apache.spark.sql.execution.SQLExecution  # noqa: F841
    return qe


def walk(node, depth=0, out=None, min_ms=200):
    out = [] if out is None else out
    name = node.nodeName()
    metrics = {}
    it = node.metrics().iterator()
    while it.hasNext():
        kv = it.next()
        k, m = kv._1(), kv._2()
        label = m.name().get() if m.name().isDefined() else k
        if any(s in label for s in INTERESTING):
            metrics[label] = m.value()
    t = max([v for k, v in metrics.items() if "time" in k or "duration" in k] or [0])
    out.append((depth, name, metrics, t))
    kids = []
    if name in ("AdaptiveSparkPlan",):
        kids = [node.executedPlan()]
    elif "QueryStage" in name:
        kids = [node.plan()]
    elif name == "ReusedExchange":
        kids = []
    else:
        ch = node.children().iterator()
        while ch.hasNext():
            kids.append(ch.next())
        if name == "WholeStageCodegen":
            kids = [node.child()]
    for k in kids:
        walk(k, depth + 1, out, min_ms)
    return out


def profile(df, min_ms: int = 200):
    """Execute ``df`` (noop sink) and print plan nodes with their metrics."""
    spark = df.sparkSession
    jdf = df._jdf
    qe = jdf.queryExecution()
    # collect() through the JVM so the executed plan object is this qe's plan
    qe.executedPlan().execute().count()
    for depth, name, metrics, t in walk(qe.executedPlan()):
        if t >= min_ms or name in ("Exchange", "ShuffleQueryStage", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate", "Window"):
            ms = ", ".join(f"{k}={v}" for k, v in metrics.items())
            print("  " * depth + f"{name} [{ms}]")
