"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of the source is to be
copied ``target / source size`` times in expectation. The whole part of that
number is given to every document, the fraction is rounded dependently: pairs
of documents of one source randomly transfer words of expected mass until one
of the two is at zero or one copy more, which keeps the source's expected words
exactly. Blocks of documents reduce to one undecided document each, and blocks
combine level by level in a tree (fan-in ``FAN_IN``) until each source has one
undecided document, which is rounded to the nearer side. A source's taken words
therefore differ from its target by at most half of one document.

Within a block documents are paired from the largest to the smallest, so that
what stays undecided tends to be small. All random choices are hashes of the
identifiers and the seed: reruns agree, whatever the partitioning.

Built-in functions only. A source with a third of all rows is spread over its
blocks; no task sees more than about ``FAN_IN`` documents of a block at once.

Defined results: null text has size 0 and is never copied beyond the whole part;
a null source is a source of its own, ordered last; rows that agree in
identifier, source and size count as one document with their total size and are
taken alike; documents of equal size meet in the order of a hash of their identifiers; a
very long text weighs by all its words; an empty table gives an empty result; other columns are ignored by
``mix_sources`` and returned as they are by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD_REGEX, stage, whole_row

FAN_IN = 128
_EPS = 1e-12


def text_words(text_col: str = "text"):
    """Number of words of the whole text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def _ordinals(keys: DataFrame, order) -> DataFrame:
    """0-based position of each row in ``order``, without a global sort in one
    task: ranges are numbered, only the counts per range meet in one place."""
    ranged, _ = stage(keys.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "sources")
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return ranged.join(before, "__part").withColumn("__pos", F.col("__before") + place).drop("__part", "__before")


def source_targets(sizes: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Weights repeat over the sources in code point order, null last. Targets
    stop at ``most`` times the source's size; what is over is shared again by
    weight among the others until none is above.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    order = F.col("source").asc_nulls_last()
    table = F.array(*[F.lit(float(w)) for w in weights])
    placed, _ = stage(
        _ordinals(totals, order).select(
            "source",
            "source_size",
            "units",
            F.element_at(table, (F.pmod("__pos", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        ),
        "sources",
    )
    full = placed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    wanted = share * full
    # level: words per unit of weight for the sources below their limit
    level = 0.0
    while True:
        capped = most * F.col("source_size") <= F.lit(level) * F.col("weight")
        row = placed.agg(
            F.sum(F.when(capped, most * F.col("source_size"))).alias("c"),
            F.sum(F.when(~capped, F.col("weight"))).alias("w"),
        ).first()
        new = (wanted - (row["c"] or 0.0)) / row["w"] if row["w"] else level
        if new <= level:
            break
        level = new
    return placed.withColumn("target", F.least(most * F.col("source_size"), F.lit(level) * F.col("weight")))


def _uniform(seed: int, *cols):
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _pair(seed: int):
    """One step of the fold over a block: the undecided document meets the
    next; one of them is decided, the other goes on."""

    def step(state, x):
        c = state["open"]
        up = F.least((1 - c["p"]) * c["w"], x["p"] * x["w"])
        down = F.least(c["p"] * c["w"], (1 - x["p"]) * x["w"])
        chance = F.when(up + down > 0, down / (up + down)).otherwise(F.lit(0.5))
        raise_c = _uniform(seed, c["doc_id"], c["size"], x["doc_id"], x["size"]) < chance
        c_done = F.when(raise_c, (1 - c["p"]) * c["w"] <= x["p"] * x["w"]).otherwise(
            c["p"] * c["w"] <= (1 - x["p"]) * x["w"]
        )
        moved = F.when(raise_c, up).otherwise(-down)

        def decided(u, more):
            return F.struct(u["doc_id"], u["size"], u["copies"], u["base"], more.cast("int").alias("more"))

        def going_on(u, p):
            clear = F.when(p < _EPS, F.lit(0.0)).when(p > 1 - _EPS, F.lit(1.0)).otherwise(p)
            return F.struct(
                u["w"].alias("w"), u["h"].alias("h"), u["doc_id"], u["size"], u["copies"], u["base"], clear.alias("p")
            )

        # c ends at 1 when raised, at 0 when lowered; x the other way round
        result = F.when(c_done, decided(c, raise_c)).otherwise(decided(x, ~raise_c))
        rest = F.when(c_done, going_on(x, x["p"] - moved / x["w"])).otherwise(going_on(c, c["p"] + moved / c["w"]))
        return F.when(c.isNull(), F.struct(x.alias("open"), state["done"].alias("done"))).otherwise(
            F.struct(rest.alias("open"), F.array_append(state["done"], result).alias("done"))
        )

    return step


_UNIT = "struct<w:double,h:bigint,doc_id:{id},size:bigint,copies:bigint,base:int,p:double>"
_DONE = "array<struct<doc_id:{id},size:bigint,copies:bigint,base:int,more:int>>"


def mix_units(
    sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17
) -> DataFrame:
    """From ``doc_id, source, size`` rows: one row per distinct such row with
    ``source_size``, ``target``, ``times`` (how often each such row is taken) and
    ``copies`` (how many such rows there are)."""
    spark = sizes.sparkSession
    units, _ = stage(
        sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-units"
    )
    targets = source_targets(
        units.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, share, most
    )
    id_type = units.schema["doc_id"].dataType.simpleString()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(ratio + F.lit(_EPS)).cast("int")
    part = F.greatest(F.lit(0.0), ratio - base)
    part = F.when(part < _EPS, F.lit(0.0)).otherwise(part)
    keys = ["source", "source_size", "target"]
    named = targets.select(F.col("source").alias("__source"), "source_size", "target", "units")
    started = (
        units.join(named, F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("base", base)
        .withColumn("p", part)
    )
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    result = started.where(~open_).select(*keys, "doc_id", "size", "copies", "base", F.lit(0).alias("more"))
    h = F.xxhash64(F.lit(seed), "doc_id", "size")
    rows = started.where(open_).select(
        *keys,
        "units",
        h.alias("at"),
        F.struct(
            (F.col("size") * F.col("copies")).cast("double").alias("w"), h.alias("h"), "doc_id", "size", "copies", "base", "p"
        )
        .cast(_UNIT.format(id=id_type))
        .alias("unit"),
    )
    largest = targets.agg(F.max("units")).first()[0] or 0
    level, blocks = 0, largest
    while blocks > 0:
        blocks = -(-blocks // FAN_IN)
        here = F.ceil(F.col("units") / F.lit(float(FAN_IN ** (level + 1))))
        grouped = (
            rows.withColumn("at", F.pmod("at", here))
            .groupBy(*keys, "units", "at")
            .agg(F.sort_array(F.collect_list("unit"), asc=False).alias("all"))
        )
        start = F.struct(
            F.lit(None).cast(_UNIT.format(id=id_type)).alias("open"), F.array().cast(_DONE.format(id=id_type)).alias("done")
        )
        folded, _ = stage(
            grouped.select(*keys, "units", "at", F.aggregate("all", start, _pair(seed + level)).alias("r")), "mix-level"
        )
        result = result.union(
            folded.select(*keys, F.explode("r.done").alias("d")).select(*keys, "d.*")
        )
        rows = folded.where("r.open is not null").select(*keys, "units", "at", F.col("r.open").alias("unit"))
        level += 1
        if blocks == 1:
            break
    last = rows.select(*keys, "unit.doc_id", "unit.size", "unit.copies", "unit.base", F.round("unit.p").cast("int"))
    return result.union(last).select(*keys, "doc_id", "size", "copies", (F.col("base") + F.col("more")).alias("times"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    sizes = docs.select("doc_id", "source", text_words().alias("size"))
    mixed = mix_units(sizes, **options)
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"),
        "source",
        F.col("times").cast("int").alias("times"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"),
    ).drop("__copy")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns."""
    sizes = docs.select("doc_id", "source", text_words().alias("size"))
    # a text without words adds nothing to a mix measured in words; it stays once
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("times"))
    taken, _ = stage(
        mix_units(sizes, **options).where((F.col("times") > 0) | (F.col("size") == 0)).select(
            F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
            times.alias("__times"),
        ),
        "mix-taken",
    )
    rows = docs.select(whole_row(docs).alias("row"), text_words().alias("words")).join(
        taken,
        F.col("row.doc_id").eqNullSafe(F.col("__id"))
        & F.col("row.source").eqNullSafe(F.col("__source"))
        & (F.col("words") == F.col("__size")),
    )
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("row.*")
