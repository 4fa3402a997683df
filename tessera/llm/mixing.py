"""Mixing sources to target weights by pivotal dependent rounding.

Native: DataFrame functions only. Every document of a source should be taken target / size
times; its whole copies are fixed and the fraction is rounded. Two documents with a fraction
are paired and words move at random from one to the other, without bias, until one of them
is taken wholly or not at all; the other goes on. This runs over chunks of a source, then
over what is left of the chunks, and so on up a tree, so a source of any size is never in
one task. The words taken stay constant all along. What is left at the root of a source,
one document, is taken in part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, numbered, running_totals, working, written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
_NEAR = 1e-9


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, units, target) from (source, source_size, units), one row for each source.

    Weights repeat over the sources by code point, null last. Targets are share of all sizes, dealt by weight; none is
    over most times its source's size, and the excess goes to the others by weight. Where share is most or more, all
    targets are at that limit. Sources may be as many as hosts: they are numbered and summed up by running totals.
    """
    sized = sizes.withColumn("last", F.col("source").isNull())
    sized = numbered(sized, ["last", "source"], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sized = sized.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    # sources by the level at which they reach their limit: the level that holds is the first with no limit below it
    ranked = sized.withColumn("limit", F.col("most") / F.col("weight"))
    before = {"most_before": F.col("most"), "weight_before": F.col("weight")}
    ranked = written(running_totals(ranked, ["limit", "place"], before), "levels")
    sums = ranked.agg(F.sum("source_size").alias("all_sizes"), F.sum("weight").alias("all_weights"))
    levels = ranked.join(F.broadcast(sums), F.lit(True))  # one row
    level = (F.col("all_sizes") * F.lit(float(share)) - F.col("most_before")) / (F.col("all_weights") - F.col("weight_before"))
    levels = levels.withColumn("level", level).filter(F.col("level") * F.col("weight") <= F.col("most"))
    water = levels.agg(F.min_by("level", F.struct("limit", "place")).alias("water"))  # one row
    target = F.coalesce(F.least(F.col("most"), F.col("water") * F.col("weight")), F.col("most"))
    return ranked.join(F.broadcast(water), F.lit(True)).select("source", "source_size", "units", target.alias("target"))


def _draw(seed: int, a: Column, b: Column) -> Column:
    """A number in [0, 1) that the pair alone decides."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), a, b), 11) / F.lit(float(1 << 53))


def _pivot(units: Column, kind: str, seed: int) -> Column:
    """Folds sorted units (id, size, times, base, h, x) into {left: the unit that still has a fraction or null, done}."""
    entry = lambda u, x: F.struct(
        u["id"].alias("id"),
        u["size"].alias("size"),
        u["times"].alias("times"),
        u["base"].alias("base"),
        F.when(x > 0.5, u["size"]).otherwise(F.lit(0).cast("long")).alias("extra"),
    )
    moved = lambda u, x: F.struct(
        *(u[n].alias(n) for n in ("id", "size", "times", "base", "h")), x.alias("x")
    )
    whole = lambda x: (x < _NEAR) | (x > 1 - _NEAR)
    bind = lambda value, then: F.transform(F.array(value), then)[0]
    state = lambda left, done: F.struct(left.alias("left"), done.alias("done"))

    def meet(s: Column, b: Column) -> Column:
        a = s["left"]
        words = F.struct(
            ((1 - a["x"]) * a["size"]).alias("a_up"),
            (a["x"] * a["size"]).alias("a_down"),
            ((1 - b["x"]) * b["size"]).alias("b_up"),
            (b["x"] * b["size"]).alias("b_down"),
        )

        def settle(v: Column) -> Column:
            up, down = F.least(v["a_up"], v["b_down"]), F.least(v["a_down"], v["b_up"])
            rises = _draw(seed, a["h"], b["h"]) * (up + down) < down
            x_a = F.when(
                rises, F.when(v["a_up"] <= v["b_down"], F.lit(1.0)).otherwise(a["x"] + v["b_down"] / a["size"])
            ).otherwise(F.when(v["a_down"] <= v["b_up"], F.lit(0.0)).otherwise(a["x"] - v["b_up"] / a["size"]))
            x_b = F.when(
                rises, F.when(v["b_down"] <= v["a_up"], F.lit(0.0)).otherwise(b["x"] - v["a_up"] / b["size"])
            ).otherwise(F.when(v["b_up"] <= v["a_down"], F.lit(1.0)).otherwise(b["x"] + v["a_down"] / b["size"]))
            return F.struct(x_a.alias("a"), x_b.alias("b"))

        def onwards(x: Column) -> Column:
            out_a, out_b = F.array_append(s["done"], entry(a, x["a"])), F.array_append(s["done"], entry(b, x["b"]))
            none = F.lit(None).cast(kind)
            return (
                F.when(whole(x["a"]) & whole(x["b"]), state(none, F.array_append(out_a, entry(b, x["b"]))))
                .when(whole(x["a"]), state(moved(b, x["b"]), out_a))
                .otherwise(state(moved(a, x["a"]), out_b))
            )

        return F.when(a.isNull(), state(b, s["done"])).otherwise(bind(bind(words, settle), onwards))

    done = kind.replace("h: bigint, x: double", "extra: bigint")
    return F.aggregate(units, state(F.lit(None).cast(kind), F.array().cast(f"array<{done}>")), meet)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    chunk: int = 128,
    seed: int = 7,
) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken.

    size is the number of words; taken, the words that the mix takes of the row with repeats, is a multiple of size but
    for one row of each source that is taken in part, and at most ``most`` times size. The sum of taken over a source
    is its target, rounded. Reruns agree: draws depend on ids, sizes and seed alone.

    Null and empty texts have size 0 and nothing is taken; null sources are one source, null ids ids like any other;
    rows with the same source, id and size share their copies as evenly as can be. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size")
    )
    with working(docs.sparkSession) as keep:
        return keep(_mixed(rows, docs.schema[id_col].dataType.simpleString(), weights, share, most, chunk, seed), "mix")


def _mixed(rows: DataFrame, id_kind: str, weights, share: float, most: float, chunk: int, seed: int) -> DataFrame:
    """mix of rows (id, source, size)."""
    units = written(rows.groupBy("source", "id", "size").agg(F.count("*").alias("times")), "units")
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("units")
    )
    aims = written(targets(sums, weights, share, most), "targets")
    named = aims.withColumnRenamed("source", "name")
    same = lambda df: df.join(named, df["source"].eqNullSafe(named["name"])).drop("name")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = wanted * F.col("times")
    dealt = same(units).select(
        "source", "id", "size", "times", F.floor(wanted + _NEAR).alias("base"), wanted.alias("wanted"), "units"
    )
    x = F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0))
    settled = (F.col("size") == 0) | (x < _NEAR)
    columns = ["source", "id", "size", "times", "base", "extra"]
    parts = [dealt.filter(settled).withColumn("extra", F.lit(0).cast("long")).select(columns)]
    level = dealt.filter(~settled).select(
        "source",
        F.ceil(F.col("units") / chunk).alias("chunks"),
        F.struct("id", "size", "times", "base", F.xxhash64(F.lit(seed), "source", "id", "size").alias("h"), x.alias("x")).alias(
            "unit"
        ),
    )
    kind = f"struct<id: {id_kind}, size: bigint, times: bigint, base: bigint, h: bigint, x: double>"
    left = aims.agg(F.max("units")).first()[0] or 0
    while True:
        # hash bits of another kind at each level, so the units of a chunk don't meet again
        place = F.pmod(F.xxhash64(F.lit(seed + left), F.col("unit.h")), F.col("chunks"))
        grouped = level.groupBy("source", place.alias("place"), "chunks").agg(
            F.array_sort(F.collect_list(F.struct("unit.h", "unit"))).alias("all")
        )
        units_in = F.transform("all", lambda e: e["unit"])
        done = written(grouped.select("source", "chunks", _pivot(units_in, kind, seed).alias("s")), "pivot")
        parts.append(done.select("source", F.explode("s.done").alias("e")).select("source", "e.*").select(columns))
        rest = done.filter("s.left IS NOT NULL")
        if left <= chunk:
            break
        left = -(-left // chunk)
        level = rest.select("source", F.ceil(F.col("chunks") / chunk).alias("chunks"), F.col("s.left").alias("unit"))
    root = rest.select("source", "s.left.*").withColumn("extra", F.round(F.col("x") * F.col("size")).cast("long"))
    parts.append(root.select(columns))
    each = reduce(DataFrame.union, parts).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    some = F.expr("base % times")
    taken = (
        F.col("size") * (F.expr("base div times") + F.when(F.col("k") <= some, 1).otherwise(0))
        + F.when(F.col("k") == some + 1, F.col("extra")).otherwise(0)
    ).cast("long")
    return same(each).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken")
    )
