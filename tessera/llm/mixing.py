"""Mixing sources to target weights.

The size of the mix is cut into blocks of equal tokens. Sainte-Lague's method
gives each block to the source with the highest quotient share / (2 blocks +
1); the same method spreads a source's blocks over groups of shards and those
of a group over its shards, by their tokens. A shard then takes its quota from its own texts in a seeded order. No step
sorts or gathers more than one shard, and shards have a bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import tokens
from tessera.plans.runtime import bounded_rows, materialize, spread


#: Groups of shards of a source, which are apportioned on the driver; the shards of a group are, in a task of their own.
GROUPS = 64
QUOTA_SCHEMA = "source string, shard int, quota bigint, held bigint, cap int"


def sainte_lague(weights: dict, seats: int, caps: dict | None = None) -> dict:
    """Seats by the highest quotients weight / (2 seats + 1), none above its cap.

    Ties go to the smaller key. All seats but a few a party follow from one
    common divisor; only the rest are dealt one by one, so the cost doesn't
    depend on the number of seats.
    """
    caps = caps or {}
    parties = sorted((k for k, w in weights.items() if w > 0), key=str)
    out = {k: 0 for k in weights}
    if not parties or seats <= 0:
        return out
    top = lambda k: caps.get(k, math.inf)

    def given(scale: float) -> dict:
        # seats whose quotient is at least 1/scale: s >= 0 with weight / (2s + 1) >= 1 / (2 scale)
        return {k: int(min(top(k), max(0, math.floor(weights[k] * scale - 0.5) + 1))) if weights[k] * scale >= 0.5 else 0 for k in parties}

    low, high = 0.0, 1.0
    total = sum(top(k) for k in parties)
    seats = int(min(seats, total))
    while sum(given(high).values()) < seats:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if sum(given(mid).values()) <= seats:
            low = mid
        else:
            high = mid
    # a little below the divisor, so that equal quotients are dealt one by one and not as rounding has it
    out.update(given(low * (1 - 1e-9)))
    left = seats - sum(out.values())
    heap = [(-weights[k] / (2 * out[k] + 1), str(k), k) for k in parties if out[k] < top(k)]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, _, k = heapq.heappop(heap)
        out[k] += 1
        left -= 1
        if out[k] < top(k):
            heapq.heappush(heap, (-weights[k] / (2 * out[k] + 1), str(k), k))
    return out


def token_table(documents: DataFrame, seed: int, vocabulary: str = tokens.DEFAULT_VOCABULARY) -> DataFrame:
    """One row per distinct non-blank text: (doc_id, source, tokens, place, key).

    Equal texts are one text, whatever their ids and sources; it belongs to
    the row with the smallest (doc_id, source). ``place`` is its seeded place
    in the order of its source. Null sources take no part.
    """

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            pdf["tokens"] = [tokens.count(t, vocabulary) for t in pdf["text"]]
            yield pdf[["doc_id", "source", "tokens", "h1", "h2"]]

    rows = spread(documents.select("doc_id", "source", "text")).where("source IS NOT NULL AND doc_id IS NOT NULL AND trim(text) <> ''").select(
        "doc_id", "source", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2")
    )
    counted = rows.mapInPandas(run, "doc_id bigint, source string, tokens bigint, h1 bigint, h2 bigint")
    one = counted.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("r"))
    return one.select("r.*", F.xxhash64(F.lit(seed), "h1", "h2").alias("place"), F.xxhash64(F.lit(seed + 1), "h2", "h1").alias("key"))


def source_blocks(have: dict[str, int], wanted: dict[str, tuple[float, int]], total_tokens: int | None, block_tokens: int) -> dict[str, int]:
    """Blocks of each source that has texts and a target; ``wanted`` has (target_share, max_repeats)."""
    shares = {s: w for s, (w, r) in wanted.items() if w > 0 and r > 0 and have.get(s)}
    if not shares:
        return {}
    scale = sum(w for w, _ in wanted.values())
    room = {s: have[s] * wanted[s][1] for s in shares}
    if total_tokens is None:
        total_tokens = min(int(room[s] * scale / shares[s]) for s in shares)
    return sainte_lague(shares, max(1, round(total_tokens / block_tokens)), {s: max(1, room[s] // block_tokens) for s in shares})


def wanted_shares(targets: DataFrame) -> dict[str, tuple[float, int]]:
    """(target_share, max_repeats) of each source of a small table."""
    one = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    return {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in bounded_rows(one)}


def shard_quotas(shards: DataFrame, seats: dict[str, int], repeats: dict[str, int], block_tokens: int) -> DataFrame:
    """The tokens each shard is to give: ``QUOTA_SCHEMA``, written.

    ``shards`` has (source, shard, held). A source's blocks go to GROUPS groups
    of its shards on the driver, those of a group to its shards in a task.
    """
    cap = F.coalesce(*[F.when(F.col("source") == s, F.lit(r)) for s, r in repeats.items()])
    shards = materialize(
        shards.withColumn("cap", cap).withColumn("group", F.pmod("shard", F.lit(GROUPS)).cast("int")).withColumn("most", F.greatest(F.lit(1), F.floor(F.col("held") * F.col("cap") / block_tokens)).cast("long"))
    )
    groups = bounded_rows(shards.groupBy("source", "group").agg(F.sum("held").alias("held"), F.sum("most").alias("most")))
    given = []
    for s in seats:
        own = {r["group"]: r for r in groups if r["source"] == s}
        blocks = sainte_lague({g: r["held"] for g, r in own.items()}, seats[s], {g: r["most"] for g, r in own.items()})
        given += [(s, g, b) for g, b in blocks.items()]
    names = [c.split()[0] for c in QUOTA_SCHEMA.split(", ")]

    def apportion(pdf: pd.DataFrame) -> pd.DataFrame:
        by = {k: (int(h), int(m), int(c)) for k, h, m, c in zip(pdf["shard"].tolist(), pdf["held"], pdf["most"], pdf["cap"])}
        blocks = sainte_lague({k: h for k, (h, _, _) in by.items()}, int(pdf["blocks"].iloc[0]), {k: m for k, (_, m, _) in by.items()})
        return pd.DataFrame([(pdf["source"].iloc[0], k, min(blocks[k] * block_tokens, h * c), h, c) for k, (h, _, c) in by.items()], columns=names)

    few = F.broadcast(shards.sparkSession.createDataFrame(given, "source string, group int, blocks bigint"))
    return materialize(shards.join(few, ["source", "group"]).groupBy("source", "group").applyInPandas(apportion, QUOTA_SCHEMA))


def mix(
    documents: DataFrame,
    targets: DataFrame,
    total_tokens: int | None = None,
    block_tokens: int = 512,
    shard_tokens: int = 20_000_000,
    seed: int = 17,
    vocabulary: str = tokens.DEFAULT_VOCABULARY,
) -> DataFrame:
    """The chosen texts: (doc_id, source, tokens, repeats), repeats >= 1.

    ``targets`` has (source, target_share, max_repeats), one row a source and a
    few rows in all; shares are scaled to sum to one. Without ``total_tokens``
    the mix is as large as the scarcest source allows when each of its texts is
    used max_repeats times. A text is never used more often than its source's
    ``max_repeats``; sources without target, and null or blank texts, are left
    out; a target without texts gets nothing and its share shows it.

    Every full pass over a shard uses each of its texts once; the part of a
    pass that is left takes blocks of the shard in seeded order. Texts longer
    than a block are placed first, so that the short ones settle the rest and
    the quota is met to within half a short text a shard.
    """
    rows = materialize(token_table(documents, seed, vocabulary))
    wanted = wanted_shares(targets)
    have = {r["source"]: r["tokens"] for r in bounded_rows(rows.where(F.col("source").isin(list(wanted))).groupBy("source").agg(F.sum("tokens").alias("tokens")))}
    empty = documents.sparkSession.createDataFrame([], "doc_id bigint, source string, tokens bigint, repeats int")
    seats = source_blocks(have, wanted, total_tokens, block_tokens)
    shares = {s: wanted[s][0] for s in seats}
    if not shares:
        return empty
    parts = {s: max(1, math.ceil(have[s] / shard_tokens)) for s in shares}
    n = F.coalesce(*[F.when(F.col("source") == s, F.lit(p)) for s, p in parts.items()])
    placed = rows.where(F.col("source").isin(list(shares))).withColumn("shard", F.pmod(F.col("key"), n.cast("long")).cast("int"))
    plan = shard_quotas(placed.groupBy("source", "shard").agg(F.sum("tokens").alias("held")), seats, {s: wanted[s][1] for s in shares}, block_tokens)

    base = placed.join(plan, ["source", "shard"]).withColumn("passes", F.least(F.expr("quota div held"), F.col("cap").cast("long")))
    rest = F.when(F.col("passes") < F.col("cap"), F.col("quota") - F.col("passes") * F.col("held")).otherwise(0)
    base = base.withColumn("rest", rest).withColumn("long_text", F.col("tokens") > block_tokens)
    by = Window.partitionBy("source", "shard", "long_text").orderBy("place", "doc_id")
    # the long texts' part of what is left, met as closely as their sizes allow
    share_of_long = F.sum(F.when(F.col("long_text"), F.col("tokens")).otherwise(0)).over(Window.partitionBy("source", "shard"))
    base = base.withColumn("before", F.sum("tokens").over(by) - F.col("tokens")).withColumn("long_all", share_of_long)
    aim = F.col("rest") * F.col("long_all") / F.col("held")
    base = base.withColumn("extra", F.when(F.col("long_text"), (F.col("before") + F.col("tokens") / 2 <= aim).cast("int")))
    taken = F.coalesce(F.sum(F.when(F.col("long_text"), F.col("extra") * F.col("tokens"))).over(Window.partitionBy("source", "shard")), F.lit(0))
    base = base.withColumn("open", F.col("rest") - taken)
    # blocks of the short texts: the order of the places is the seeded order of the blocks
    short = (F.col("before") + F.col("tokens") / 2 <= F.col("open")).cast("int")
    repeats = (F.col("passes") + F.coalesce("extra", short)).cast("int")
    return base.select("doc_id", "source", "tokens", repeats.alias("repeats")).where("repeats > 0")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Wanted and actual share of each target source: (source, target_share, actual_share, tokens, texts, most_repeats)."""
    got = chosen.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("texts"), F.max("repeats").alias("most_repeats")
    )
    wanted = targets.select("source", "target_share").distinct()
    joined = wanted.join(got, "source", "left")
    whole = F.sum("tokens").over(Window.partitionBy())
    return joined.select(
        "source", "target_share", F.coalesce(F.col("tokens") / whole, F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
