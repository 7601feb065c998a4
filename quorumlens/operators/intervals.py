"""Lookups of addresses and networks in tables of networks, as joins on prefix keys.

A network is its own key: (family, prefix length, leading bits).  An address lies in a network if it has that network's key at
that network's length, so a probe has one key for every length present in the table, and containment in either
direction is a hash join.  Only keys are probed: what belongs to an entry stays where it is, and the answer is joined
to it by indicator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlens.functions.addresses import ADDRESS_COLUMNS, v6_network
from quorumlens.operators.ordered import collapsed
from quorumlens.session import written

#: Networks up to which a table's keys are broadcast (at most 130 keys each); beyond, the join shuffles keys.
BROADCAST_NETWORKS = 1_000

_KEY = ["_how", "_f", "_p", "_k4", "_k6"]
_INSIDE, _AROUND, _EXACT = 0, 1, 2


def _keyed(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the key columns of rows with ``_how``, ``family``, ``_p``, ``lo`` and ``lo6``."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - F.col("_p"))
    four = F.col("family") == 4
    return df.select(
        *keep,
        "_how",
        F.col("family").cast("int").alias("_f"),
        "_p",
        F.when(four, F.col("lo") - F.col("lo") % size).otherwise(F.lit(-1)).alias("_k4"),
        F.when(four, F.lit(b"")).otherwise(v6_network("lo6", "_p")).alias("_k6"),
    )


def _lengths(found) -> Column:
    """Prefix lengths of the row's ``family`` among (family, length) rows (at most 162)."""
    found = set(found)
    of = lambda f: F.array(*[F.lit(p) for p in sorted(p for x, p in found if x == f)]).cast("array<int>")
    return F.when(F.col("family") == 4, of(4)).otherwise(of(6))


def _fetched(networks: DataFrame) -> tuple[DataFrame, Column, bool]:
    """A table of networks, the lengths in it, and whether it is small; a small one is fetched once and computed no more."""
    rows = networks.limit(BROADCAST_NETWORKS + 1).collect()
    small = len(rows) <= BROADCAST_NETWORKS
    if small:
        networks = networks.sparkSession.createDataFrame(rows, networks.schema)
    else:
        rows = networks.select("family", "prefix").distinct().collect()
    return networks, _lengths((r["family"], r["prefix"]) for r in rows), small


def overlapping(entries: DataFrame, allowed: DataFrame) -> DataFrame:
    """Indicators of ``entries`` that lie in a network of ``allowed`` or contain (part of) one."""
    nets, lengths, small = _fetched(allowed.select("family", "prefix", "lo", "lo6").distinct())
    upward = F.sequence(F.lit(0), F.col("prefix").cast("int"))
    keys = _keyed(nets.select("*", F.lit(_INSIDE).alias("_how"), F.col("prefix").cast("int").alias("_p"))).union(
        _keyed(nets.select("*", F.lit(_AROUND).alias("_how"), F.explode(upward).alias("_p"))).distinct()
    )
    if small:
        keys = F.broadcast(keys)
    width = F.coalesce(F.col("prefix"), F.when(F.col("family") == 4, 32).otherwise(128)).cast("int")
    inside = F.transform(
        F.filter(lengths, lambda p: p <= width), lambda p: F.struct(F.lit(_INSIDE).alias("_how"), p.alias("_p"))
    )
    own = F.struct(F.lit(_AROUND).alias("_how"), F.col("prefix").cast("int").alias("_p"))
    around = F.when(F.col("prefix").isNotNull(), F.array(own)).otherwise(F.array().cast("array<struct<_how:int,_p:int>>"))
    probes = entries.select("indicator", "family", "lo", "lo6", F.inline(F.concat(inside, around)))
    return _keyed(probes, "indicator").join(keys, _KEY, "left_semi").select("indicator").distinct()


def flag_overlap(entries: DataFrame, allowed: DataFrame, out: str = "allowlisted") -> DataFrame:
    """Add boolean ``out``: the entry lies in an allowed network, or contains (part of) one.

    ``allowed`` holds networks with the address columns; ``entries`` are distinct indicators, stored or kept, for their
    addresses are read apart from the rest.
    """
    hits = overlapping(entries.select(*ADDRESS_COLUMNS), allowed).withColumn(out, F.lit(True))
    return entries.join(hits, "indicator", "left").select(
        *entries.columns, F.coalesce(F.col(out), F.lit(False)).alias(out)
    )


def without_overlap(entries: DataFrame, allowed: DataFrame) -> DataFrame:
    """Entries that touch no allowed network in either direction."""
    return entries.join(overlapping(entries, allowed), "indicator", "left_anti").select(*entries.columns)


def explain_targets(targets: DataFrame, published: DataFrame) -> DataFrame:
    """For each looked-up address: the published entry of that very text, else the first published
    network (in address order) containing it.  Adds ``matched`` and ``match_kind``.

    ``targets`` holds ``target`` and its address columns; the address is NULL where unreadable.  The keys of
    ``published``, texts and networks, are written once to the shared folder.
    """
    text = F.struct(
        F.lit(_EXACT).alias("_how"), F.lit(0).alias("_f"), F.lit(-1).alias("_p"), F.lit(-1).cast("bigint").alias("_k4"),
        F.col("indicator").cast("binary").alias("_k6"),
    )
    net = F.struct(
        F.lit(_INSIDE).alias("_how"),
        F.col("family").cast("int").alias("_f"),
        F.col("prefix").cast("int").alias("_p"),
        F.coalesce("lo", F.lit(-1).cast("bigint")).alias("_k4"),
        F.coalesce("lo6", F.lit(b"")).alias("_k6"),
    )
    both = F.when(F.col("is_net"), F.array(text, net)).otherwise(F.array(text))
    keys = written(published.select(F.col("indicator").alias("found"), F.inline(both)), "published-keys")
    lengths = _lengths(keys.where("_p >= 0").select("_f", "_p").distinct().collect())
    single = ~F.coalesce("is_net", F.lit(True))
    pair = "array<struct<_how:int,_p:int>>"
    exact = F.array(F.struct(F.lit(_EXACT).alias("_how"), F.lit(-1).alias("_p"))).cast(pair)
    inside = F.transform(lengths, lambda p: F.struct(F.lit(_INSIDE).alias("_how"), p.alias("_p"))).cast(pair)
    wanted = targets.select("target", "indicator", "family", "is_net", "lo", "lo6").distinct()
    # One row a target for its text, whether or not anything is listed under it, and one for each length.
    probes = wanted.select(
        "target", "indicator", "family", "lo", "lo6", single.alias("single"),
        F.inline(F.when(single, F.concat(exact, inside)).otherwise(exact)),
    )
    by_text = F.col("_how") == _EXACT
    probes = _keyed(probes, "target", "indicator", "single").select(
        "target",
        "single",
        "_how",
        F.when(by_text, 0).otherwise(F.col("_f")).alias("_f"),
        "_p",
        F.when(by_text, -1).otherwise(F.col("_k4")).alias("_k4"),
        F.when(by_text, F.col("indicator").cast("binary")).otherwise(F.col("_k6")).alias("_k6"),
    )
    hits = probes.join(keys, _KEY, "left").groupBy("target", "single").agg(
        F.max(F.when(F.col("_p") < 0, F.col("found"))).alias("listed"),
        # The widest network around an address is the first in address order.
        F.min(F.when(F.col("found").isNotNull() & (F.col("_p") >= 0), F.struct("_p", "found")))
        .getField("found")
        .alias("around"),
    )
    return hits.select(
        "target",
        F.coalesce("listed", "around").alias("matched"),
        F.when(F.col("listed").isNotNull(), "exact")
        .when(~F.col("single"), "invalid")
        .when(F.col("around").isNotNull(), "inside")
        .otherwise("absent")
        .alias("match_kind"),
    )


def aggregated_runs(networks: DataFrame) -> DataFrame:
    """IPv6 networks that collapse into a larger block together: (block, block_prefix, member, members) rows."""
    return collapsed(networks).filter("members > 1")
