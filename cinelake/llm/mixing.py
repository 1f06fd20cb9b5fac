"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Targets: source k by code point (null last) weighs WEIGHTS[k mod 3]; all sizes are shared by weight, no source gets more
than ``max_repeat`` times its size, and the excess goes to the others by weight until none is above. The documents
of a source then want target / size copies each: the whole part is sure, the fraction is a probability.

Rounding: first each document above 1/HEADS of its source is paired with the pool of all smaller ones, the largest
first; that decides it and shifts the pool's probability. Then, in a group of about ``fan_in`` documents (sorted by size, the largest first, then by a seeded hash) the
pending fraction meets the next one; mass is moved between the two at random, so that expectations and the words of
the pair stay as they are, until one of them is 0 or 1. What stays pending at the end of a group goes to the next
level, which groups the groups: a reduction tree of depth log(documents). The last fraction of a source goes to the
nearest whole number. So the words taken from a source differ from its target by at most half of one document, and
that a small one unless a document outweighs the rest of its source. Large documents come first since the last fraction
left over must be a small document's; there are at most HEADS of them in a source, so one row holds them.

Defined results: a null text has size 0 and takes nothing; null sources form a source; a source of size 0 has target
0; rows repeated in full are mixed one by one; an empty table gives an empty table; columns named like those added
are replaced. Reruns agree: draws are hashes of the row, the level and the seed; of rows that agree in id, text and source,
the first in the order of a hash of all their columns get the extra copies. Sources, not documents, meet in one window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.scratch import Scratch

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
FAN_IN = 64
MAX_REPEAT = 3.0
MAX_BROADCAST_BYTES = 8 << 20  # of the sources' facts
SALTS = 64
HEADS = 128


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """sizes(source, source_size) -> with target. One row per source: the windows see sources, not documents.

    Filling by weight up to a cap: sources in the order of cap / weight are capped as long as the level that the rest
    would reach is not below their own.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(max_repeat))
    t = t.withColumn("ratio", F.col("cap") / F.col("weight"))
    fill = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("left_mass", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    t = t.withColumn("level", F.col("left_mass") / F.col("left_weight"))
    # The first source that the level does not fill sets the level of all after it.
    t = t.withColumn("pos", F.row_number().over(fill))
    t = t.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("pos", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def _unit(*cols: Column) -> Column:
    """A draw in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _reduce(items: DataFrame, level: int, seed: int, id_type: str) -> DataFrame:
    """items(source, grp, id, n, p, h) -> one row per (source, grp): the decided items, the pending one or null."""
    item = F.struct((-F.col("n")).alias("neg"), "h", "id", "n", "p")
    groups = items.groupBy("source", "grp").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = f"array<struct<id:struct<doc:{id_type},h:bigint,c:bigint>,n:bigint,up:bigint>>"

    def done(x: Column, p: Column) -> Column:
        return F.struct(x["id"].alias("id"), x["n"].alias("n"), F.round(p).cast("long").alias("up"))

    def step(state: Column, x: Column) -> Column:
        a, p, b, q = state["n"].cast("double"), state["p"], x["n"].cast("double"), x["p"]
        rise, fall = F.least(a * (1 - p), b * q), F.least(a * p, b * (1 - q))
        up = _unit(state["h"], x["h"], F.lit(level), F.lit(seed)) * (rise + fall) < fall
        # Which of the two reaches 0 or 1 is known from the smaller bound, so it is set exactly.
        left = F.when(up, a * (1 - p) <= b * q).otherwise(a * p <= b * (1 - q))
        p2 = F.when(left, F.when(up, 1.0).otherwise(0.0)).otherwise(F.when(up, p + b * q / a).otherwise(p - b * (1 - q) / a))
        q2 = F.when(~left, F.when(up, 0.0).otherwise(1.0)).otherwise(F.when(up, q - a * (1 - p) / b).otherwise(q + a * p / b))
        gone = F.when(left, done(state, p2)).otherwise(done(x, q2))

        def keep(field: str, own: Column, other: Column) -> Column:
            return F.when(left, other).otherwise(own).alias(field)

        moved = F.struct(
            keep("h", state["h"], x["h"]), keep("id", state["id"], x["id"]), keep("n", state["n"], x["n"]),
            F.least(F.greatest(F.when(left, q2).otherwise(p2), F.lit(0.0)), F.lit(1.0)).alias("p"),
            F.concat(state["out"], F.array(gone)).alias("out"),
        )
        return moved

    first = F.col("items")[0]
    start = F.struct(first["h"].alias("h"), first["id"].alias("id"), first["n"].alias("n"), first["p"].alias("p"), F.array().cast(empty).alias("out"))
    rest = F.slice("items", F.lit(2), F.greatest(F.size("items") - 1, F.lit(0)))
    return groups.select("source", "grp", F.aggregate(rest, start, step).alias("s")).select(
        "source", "grp", "s.h", "s.id", "s.n", "s.p", F.col("s.out").alias("out")
    )


def _heads(items: DataFrame, seed: int, id_type: str) -> DataFrame:
    """The large documents of each source, at most HEADS, each paired with the pool of all smaller ones.

    The pool has one probability p for its mass; moving mass between a document and the pool until one is whole decides
    the document (or, if it outweighs the pool, the pool). Returns source, out (decisions) and p (the pool's at the end).
    """
    item = F.struct((-F.col("n")).alias("neg"), "h", "id", "n")
    groups = items.groupBy("source").agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("source_size").cast("double").alias("mass"), F.max("p").alias("p")
    )
    empty = f"array<struct<id:struct<doc:{id_type},h:bigint,c:bigint>,n:bigint,up:bigint>>"

    def step(state: Column, x: Column) -> Column:
        a, p = x["n"].cast("double"), state["p"]
        pool = F.greatest(state["mass"] - a, F.lit(0.0))
        rise, fall = F.least(a * (1 - p), pool * p), F.least(a * p, pool * (1 - p))
        up = _unit(x["h"], F.lit(-1), F.lit(seed)) * (rise + fall) < fall
        own = F.when(up, p + rise / a).otherwise(p - fall / a)
        rest = F.when(pool <= 0, p).when(up, p - rise / pool).otherwise(p + fall / pool)
        gone = F.struct(x["id"].alias("id"), x["n"].alias("n"), F.round(own).cast("long").alias("up"))
        return F.struct(
            pool.alias("mass"), F.least(F.greatest(rest, F.lit(0.0)), F.lit(1.0)).alias("p"),
            F.concat(state["out"], F.array(gone)).alias("out"),
        )

    start = F.struct("mass", "p", F.array().cast(empty).alias("out"))
    return groups.select("source", F.aggregate("items", start, step).alias("s")).select("source", "s.out", "s.p")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_repeat: float = MAX_REPEAT,
    seed: int = 17,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The rows of docs with size, source_size, target, copies and taken (= size * copies)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    id_type = docs.schema[id_col].dataType.simpleString()
    h = F.xxhash64(F.col(id_col), F.col(text_col))
    # Rows that agree in id, text and source are one entry with a count m.
    flat = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc"), h.alias("h"), word_count(F.col(text_col)).alias("n"))
    entries = scratch.keep(flat.groupBy("source", "doc", "h", "n").agg(F.count(F.lit(1)).alias("m")), "entries")
    sizes = entries.groupBy("source").agg(F.sum(F.col("n") * F.col("m")).alias("source_size"), F.sum("m").alias("members"))
    sizes = scratch.keep(sizes, "sizes")
    targets = _by_source(source_targets(sizes, weights, max_repeat), sizes.select("source", "members"), 0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = scratch.keep(targets.withColumn("rate", F.least(rate, F.lit(max_repeat))), "targets")
    wide, most = targets.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 96), F.max("members")).first()
    repeats = entries.agg(F.max("m")).first()[0]
    full = _by_source(entries, targets, wide or 0).withColumn("whole", F.floor("rate").cast("long"))
    width = F.greatest(F.ceil(F.col("members") / F.lit(fan_in)), F.lit(1)).cast("long")
    each = full.where((F.col("n") > 0) & (F.col("rate") > F.col("whole"))).select(
        "source", "source_size", "members", (F.col("rate") - F.col("whole")).alias("p"), "doc", "h", "n",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("c"),
    )
    each = each.select(
        "source", "source_size", "p", "n", F.struct("doc", "h", "c").alias("id"), F.xxhash64("h", "doc", "c", F.lit(seed)).alias("h"), width.alias("w")
    )
    large = F.col("n") * F.lit(HEADS) > F.col("source_size")
    heads = scratch.keep(_heads(each.where(large), seed, id_type), "heads")
    after = heads.select("source", F.col("p").alias("after"))
    tail = _by_source(each.where(~large), after, wide or 0, outer=True).withColumn("p", F.coalesce("after", "p"))
    items = tail.select("source", F.pmod("h", "w").alias("grp"), "id", "n", "p", "h")
    levels = 1 + max(0, math.ceil(math.log(max((most or 1) / fan_in, 1), fan_in)))
    ups = [heads.select("source", F.explode("out").alias("x")).select("source", "x.id", "x.up")]
    for level in range(levels):
        reduced = scratch.keep(_reduce(items, level, seed, id_type), f"level{level}")
        ups.append(reduced.select("source", F.explode("out").alias("x")).select("source", "x.id", "x.up"))
        items = reduced.select("source", F.floor(F.col("grp") / F.lit(fan_in)).cast("long").alias("grp"), "id", "n", "p", "h")
    decided = items.select("source", "id", F.round("p").cast("long").alias("up"))
    for u in ups:
        decided = decided.unionByName(u)
    extra = decided.where("up > 0").groupBy("source", "id.doc", "id.h").agg(F.sum("up").alias("ups"))
    extra = extra.select(F.col("source").alias("s2"), F.col("doc").alias("d2"), F.col("h").alias("h2"), "ups")
    same = F.col("source").eqNullSafe(F.col("s2")) & F.col("doc").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2"))
    plan = full.join(extra, same, "left").select(
        F.col("source").alias("__s"), F.col("doc").alias("__d"), F.col("h").alias("__h"), F.col("n").alias("size"),
        "source_size", "target", "whole", F.coalesce("ups", F.lit(0).cast("long")).alias("__ups"),
    )
    plan = scratch.keep(plan, "plan")
    scratch.release(plan)
    added = ("size", "source_size", "target", "copies", "taken")
    rows = docs.select(*(c for c in docs.columns if c not in added or c in (id_col, text_col, source_col)), h.alias("__k"))
    same = F.col(source_col).eqNullSafe(F.col("__s")) & F.col(id_col).eqNullSafe(F.col("__d")) & (F.col("__k") == F.col("__h"))
    out = rows.join(plan, same)
    rank = F.lit(1)
    if (repeats or 1) > 1:  # the extra copies of an entry go to its first rows
        told = F.xxhash64(*(F.to_json(F.struct(c)) for c in docs.columns))
        rank = F.row_number().over(Window.partitionBy("__s", "__d", "__h").orderBy(told))
    out = out.withColumn("__rank", rank)
    copies = F.when(F.col("size") > 0, F.col("whole") + (F.col("__rank") <= F.col("__ups")).cast("long")).otherwise(F.lit(0))
    out = out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("size") * F.col("copies"))
    keep = [c for c in rows.columns if c != "__k"]
    return out.select(*keep, *(c for c in added))


def _by_source(rows: DataFrame, facts: DataFrame, size: int, outer: bool = False) -> DataFrame:
    """rows joined with their source's facts: broadcast where their bytes are known and few, else salted against hot sources
    (size 0: one row per source on either side)."""
    facts = facts.withColumnRenamed("source", "__s2")
    on = F.col("source").eqNullSafe(F.col("__s2"))
    drop = ["__s2", *[c for c in facts.columns if c in rows.columns]]
    facts = facts.drop(*[c for c in drop if c != "__s2"])
    if 0 < size <= MAX_BROADCAST_BYTES:
        facts = F.broadcast(facts)
    elif size:
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt2")
        facts = facts.select("*", salt)
        rows = rows.withColumn("__salt", F.pmod(F.col("h"), F.lit(SALTS)))
        on = on & (F.col("__salt") == F.col("__salt2"))
    return rows.join(facts, on, "left" if outer else "inner").drop("__s2", "__salt", "__salt2")
