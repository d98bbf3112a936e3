"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of columns (domain, language, source). Each node splits what it gets by its children's
weights; a child that cannot use its share (it has too few tokens, even over ``max_epochs`` passes) leaves the rest to its
siblings, and only what all siblings together cannot use goes back to the ancestors, which offer it to their other
children. A leaf takes the longest prefix of its documents that fits its budget, in the order of seeded hashes: epoch
after epoch, each with an order of its own, a document at most once an epoch.

Words are counted in one scan, which leaves one narrow row a document in the shared folder; budgets come from one row a leaf,
of which there may be ``MOST_LEAVES`` (more is an error). A leaf's prefix ends at a threshold of the hash order. It is found without ordering a leaf: token sums of 2^10 hash
ranges give the range in which the budget ends, those of its 2^10 parts the part, and only documents of that part are ordered.
The documents are then read once more and held against the thresholds of their leaf, one row a leaf and epoch.

Defined cases: null level values form leaves of their own (written as ''); null text has no tokens; documents without
tokens take part in no leaf and are not returned; the order hashes id and text, so null ids and repeated ids are ordered by their texts and no id is
favoured; rows that repeat an id and its text stand in one place and are selected together or not at all; a negative or missing weight is an error;
weights that sum to 0 give nothing; very long texts count whole; extra columns pass through, but those named ``_mix_...``
are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import has_words, stored, word_count

MOST_LEAVES = 1_000_000
# Hashes that order a leaf have 40 bits; two steps of 10 bits find where its budget ends.
BITS, STEP = 40, 10


def split_budget(budget: float, nodes: Mapping[str, tuple[float, float]]) -> dict[str, float]:
    """Share budget among nodes (weight, capacity) by weight; what one cannot hold goes to its siblings, until all are full or it is used up."""
    out = dict.fromkeys(nodes, 0.0)
    open_ = {k for k, (w, c) in nodes.items() if w > 0 and c > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(nodes[k][0] for k in open_)
        full = {k for k in open_ if out[k] + left * nodes[k][0] / total >= nodes[k][1]}
        if not full:
            for k in open_:
                out[k] += left * nodes[k][0] / total
            break
        for k in full:
            left -= nodes[k][1] - out[k]
            out[k] = nodes[k][1]
        open_ -= full
    return out


def leaf_budgets(capacity: Mapping[tuple[str, ...], float], weights: Mapping[tuple[str, ...], float], budget: float) -> dict[tuple[str, ...], float]:
    """Budgets of the leaves. weights: of any node, by its path; '*' stands for any name, first in the last place, then in the others. Nodes without a weight weigh as they have tokens.

    Capacities are summed up the tree counting only what positive weights can reach, so a shortage that siblings cannot take up is seen, and passed on, one level above.
    """
    depth = max((len(p) for p in capacity), default=0)
    below: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    size: dict[tuple[str, ...], float] = {}
    for path, c in capacity.items():
        for k in range(depth):
            below.setdefault(path[:k], set()).add(path[: k + 1])
            size[path[: k + 1]] = size.get(path[: k + 1], 0.0) + c
    any_ = lambda path: ("*",) * (len(path) - 1)
    patterns = lambda path: (path, (*path[:-1], "*"), (*any_(path), path[-1]), (*any_(path), "*"))
    weight = {p: float(next((weights[x] for x in patterns(p) if x in weights), size[p])) for p in size}
    if any(w < 0 or w != w for w in weight.values()):
        raise ValueError("weights must not be negative")
    usable: dict[tuple[str, ...], float] = {}
    for path in sorted(size, key=len, reverse=True):
        inside = capacity[path] if len(path) == depth else sum(usable[x] for x in below[path])
        usable[path] = inside if weight[path] > 0 else 0.0
    out, todo = {}, [((), budget)] if capacity else []
    while todo:
        path, b = todo.pop()
        if len(path) == depth:
            out[path] = b
            continue
        todo += split_budget(b, {x: (weight[x], usable[x]) for x in sorted(below.get(path, ()))}).items()
    return out


def thresholds(rows: DataFrame, epochs: DataFrame, names: list[str], seed: int) -> DataFrame:
    """Of each leaf and epoch that is used in part: _mix_cut, the place (order, base) of the last document that fits."""
    group = [*names, "_mix_epoch"]
    part = rows.join(epochs.where("not _mix_all"), names).withColumn("_mix_order", order_in(F.col("_mix_epoch"), seed)).withColumn("_mix_ahead", F.lit(0).cast("long"))
    so_far = lambda *by: Window.partitionBy(*group).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    for k in (1, 2):
        place = F.shiftright("_mix_order", BITS - k * STEP)
        sums = part.groupBy(*group, "_mix_budget", "_mix_ahead", place.alias("_mix_range")).agg(F.sum("_mix_tokens").alias("n"))
        sums = sums.withColumn("_mix_to", F.col("_mix_ahead") + F.sum("n").over(so_far("_mix_range")))
        # Where the budget ends: the first range that does not fit whole. A leaf and epoch used in part has one.
        ends = sums.where("_mix_to > _mix_budget").groupBy(*group).agg(F.min_by(F.struct("_mix_range", (F.col("_mix_to") - F.col("n")).alias("ahead")), "_mix_range").alias("x"))
        ends = F.broadcast(ends.select(*group, F.col("x._mix_range").alias("_mix_range"), F.col("x.ahead").alias("_mix_next")))  # one row a leaf and epoch
        part = part.withColumn("_mix_range", place).join(ends, [*group, "_mix_range"]).withColumn("_mix_ahead", F.col("_mix_next")).drop("_mix_range", "_mix_next")
    last = part.groupBy(*group, "_mix_budget", "_mix_ahead", "_mix_order", "_mix_base").agg(F.sum("_mix_tokens").alias("n"))
    last = last.withColumn("_mix_to", F.col("_mix_ahead") + F.sum("n").over(so_far("_mix_order", "_mix_base")))
    # All before the first document that does not fit.
    return last.where("_mix_to > _mix_budget").groupBy(*group).agg(F.min(F.struct("_mix_order", "_mix_base")).alias("_mix_cut"))


def order_in(epoch: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64("_mix_base", epoch, F.lit(seed)), F.lit(1 << BITS))


def mix(docs: DataFrame, levels: Sequence[str | Column], weights: Mapping[tuple[str, ...], float], budget_share: float = 1.0, max_epochs: int = 2,
        seed: int = 1, tokens: Column | None = None) -> DataFrame:
    """Rows of docs that are selected, once an epoch, with _mix_epoch and _mix_leaf added. The budget is ``budget_share`` of all tokens."""
    spark = docs.sparkSession
    docs = docs.drop(*(c for c in docs.columns if c.startswith("_mix_")))
    names = [f"_mix_l{i}" for i in range(len(levels))]
    leaf = [F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("")).alias(n) for x, n in zip(levels, names, strict=True)]
    base = F.xxhash64("doc_id", "text").alias("_mix_base")
    rows = docs.select(*leaf, base, (word_count("text") if tokens is None else tokens).cast("long").alias("_mix_tokens")).where("_mix_tokens > 0")
    rows = stored(rows, "mix-rows")
    sizes = rows.groupBy(*names).agg(F.sum("_mix_tokens").alias("n")).limit(MOST_LEAVES + 1).collect()  # one row a leaf
    if len(sizes) > MOST_LEAVES:
        raise ValueError(f"over {MOST_LEAVES} leaves")
    total = sum(r["n"] for r in sizes)
    paths = {tuple(r[n] for n in names): r["n"] for r in sizes}
    budgets = leaf_budgets({p: float(n * max_epochs) for p, n in paths.items()}, weights, total * budget_share)
    plan = []
    for p, n in paths.items():
        b = min(int(budgets[p] + 1e-6), n * max_epochs)
        for epoch in range(max_epochs):
            if part := min(max(b - epoch * n, 0), n):
                plan.append((*p, epoch, part, part == n))
    schema = ", ".join(f"{n} string" for n in names) + ", _mix_epoch int, _mix_budget long, _mix_all boolean"
    epochs = F.broadcast(spark.createDataFrame(plan, schema))  # leaves times epochs rows at most, and leaves are bounded above
    cuts = F.broadcast(stored(epochs.join(thresholds(rows, epochs, names, seed), [*names, "_mix_epoch"], "left"), "mix-cuts"))
    counted = has_words("text") if tokens is None else tokens.cast("long") > 0
    place = F.struct(order_in(F.col("_mix_epoch"), seed).alias("_mix_order"), "_mix_base")
    chosen = docs.select("*", *leaf, base).join(cuts, names).where((F.col("_mix_all") | (place < F.col("_mix_cut"))) & counted)
    return chosen.select(*docs.columns, "_mix_epoch", F.concat_ws("/", *names).alias("_mix_leaf"))
