"""Splits that keep related records together.

Method: hash-to-min components over documents that share a record, then weighted rendezvous hashing of components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.plans.scratch import materialize, release
from clinweave.plans.skew import join_by_key_stats

#: A component with at least this share of the rows draws its split before the others; there are 1 / HEAVY_SHARE at most.
HEAVY_SHARE = 0.002


def plain_id(c: Column) -> Column:
    """An identifier without case, braces and outer blanks; null where nothing is left."""
    bare = F.regexp_replace(F.lower(c), r"^[{}\s\p{Z}\p{Cf}]+|[{}\s\p{Z}\p{Cf}]+$", "")
    return F.when(bare != "", bare)


def hash_to_min(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (string columns a, b): one row (root, node) per node that is not its root.

    Each node v holds a cluster of nodes. In a round it sends the cluster to the cluster's minimum and the minimum
    to each member, until no cluster changes (about log(diameter) rounds). Clusters are rows (v, u), so no
    component is ever gathered in one task; nodes with very large clusters are joined map-side.
    Self-links and repeated links are harmless; null ends are ignored; no links give no rows.
    """
    links = links.filter("a is not null and b is not null and a <> b").distinct()
    ends = links.select(F.explode(F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x, y in ("aa", "ab", "ba", "bb")])).alias("p"))
    clusters = materialize(ends.select("p.v", "p.u").distinct(), "clusters")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())

    before = state(clusters)
    for _ in range(most_rounds):
        lowest = materialize(clusters.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")), "lowest")
        told = join_by_key_stats(clusters, lowest, ["v"], "n", before[0])
        sent = told.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("p"))
        fresh = materialize(sent.select("p.v", "p.u").distinct(), "clusters")
        release(clusters, lowest)
        clusters = fresh
        after = state(clusters)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return clusters.filter("v > u").select(F.col("u").alias("root"), F.col("v").alias("node"))


def _pairs(records: DataFrame) -> DataFrame:
    return records.select(plain_id(F.col("record_id")).alias("rid"), plain_id(F.col("document_id")).alias("did"))


def linked_documents(records: DataFrame) -> DataFrame:
    """(group_document_id, document_id): documents joined through records that occur under both, also at several removes."""
    pairs = materialize(_pairs(records).filter("rid is not null and did is not null").distinct(), "id-pairs")
    total = pairs.count()
    hubs = materialize(pairs.groupBy("rid").agg(F.min("did").alias("a"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    links = join_by_key_stats(pairs, hubs, ["rid"], "n", total).select("a", F.col("did").alias("b"))
    return hash_to_min(links).select(F.col("root").alias("group_document_id"), F.col("node").alias("document_id"))


def row_groups(records: DataFrame) -> DataFrame:
    """(row_id, group_key) for every row.

    The key is the smallest document of the row's component. A row without a document goes with the documents of
    its record, or with the other rows of that record; one with neither id stands alone.
    """
    rows = records.select("row_id", plain_id(F.col("record_id")).alias("rid"), plain_id(F.col("document_id")).alias("did"))
    rows = materialize(rows, "id-rows")
    total = rows.count()
    roots = linked_documents(records).select(F.col("document_id").alias("did"), F.col("group_document_id").alias("root"))
    sized = materialize(rows.filter("did is not null").groupBy("did").agg(F.count("*").alias("n")).join(roots, "did", "left"), "roots")
    having = join_by_key_stats(rows, sized, ["did"], "n", total).select("row_id", F.coalesce("root", "did").alias("group_key"))
    lone = materialize(rows.filter("did is null"), "lone-rows")
    of_record = rows.filter("did is not null and rid is not null").join(lone.select("rid").distinct(), "rid", "left_semi").groupBy("rid").agg(F.min("did").alias("did"))
    homes = of_record.join(roots, "did", "left").select("rid", F.coalesce("root", "did").alias("home"))
    per_record = materialize(lone.filter("rid is not null").groupBy("rid").agg(F.count("*").alias("n")).join(homes, "rid", "left"), "homes")
    through = join_by_key_stats(lone, per_record, ["rid"], "n", total).select("row_id", F.coalesce("home", F.concat(F.lit("record:"), "rid")).alias("group_key"))
    alone = lone.filter("rid is null").select("row_id", F.concat(F.lit("row:"), F.col("row_id").cast("string")).alias("group_key"))
    return having.unionByName(through).unionByName(alone)


def _draw(key: Column, split: str, seed: int, weight: float) -> Column:
    """Weighted rendezvous: the split with the smallest -ln(u) / weight wins."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:{split}:"), key)), 1, 13)
    return -F.log((F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(weight)


def assign_splits(records: DataFrame, config: DataFrame) -> DataFrame:
    """(row_id, group_key, split_name): whole components to splits, with shares of rows close to ``config``.

    ``config`` has split_name, ratio and seed_value, one row per split (a handful of rows, read by the driver).
    Every component draws a split by weighted rendezvous hashing of its key. Those with at least HEAVY_SHARE of all
    rows, 1 / HEAVY_SHARE of them at most, draw first, largest first, with the ratios as weights and among the splits
    that have room for them (the one with most room, if none has). The others draw with what is left as weights. Hashes
    are the same in both draws, so a component that grows across the line keeps its split but for the change of weights.
    """
    rows = materialize(row_groups(records), "row-groups")
    total = rows.count()
    splits = sorted((r.split_name, float(r.ratio), int(r.seed_value)) for r in config.select("split_name", "ratio", "seed_value").distinct().collect())
    if not splits:
        raise ValueError("the split configuration is empty")
    scale = sum(r for _, r, _ in splits)
    sizes = materialize(rows.groupBy("group_key").agg(F.count("*").alias("n")), "group-sizes")

    def draws(weights: dict[str, float]) -> Column:
        return F.array_sort(F.array(*[F.struct(_draw(F.col("group_key"), name, seed, weights[name]).alias("d"), F.lit(name).alias("s")) for name, _, seed in splits]))

    left = {name: ratio / scale * total for name, ratio, _ in splits}
    large = sizes.filter(F.col("n") >= max(2.0, HEAVY_SHARE * total)).select("group_key", "n", draws({name: ratio for name, ratio, _ in splits}).alias("draws"))
    placed = {}
    for r in large.orderBy(F.desc("n"), "group_key").collect() if total else []:
        best = next((x.s for x in r.draws if left[x.s] >= r.n), max(left, key=lambda s: left[s]))
        placed[r.group_key] = best
        left[best] -= r.n
    drawn = draws({s: max(x, 1e-9) for s, x in left.items()})[0]["s"]
    if placed:
        fixed = F.create_map(*[x for k, s in placed.items() for x in (F.lit(k), F.lit(s))])
        drawn = F.coalesce(F.try_element_at(fixed, F.col("group_key")), drawn)
    return rows.select("row_id", "group_key", drawn.alias("split_name"))
