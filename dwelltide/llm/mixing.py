"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of about equal size by a hash of the document ids, so that a
block is a random part of its source. A source's target says how many of its blocks the mix
takes, once or more often. The quotas of all sources are dealt to the output shards by a
tree: a node draws, without replacement, the blocks that go to its left half, so the quotas
of its children are a multivariate-hypergeometric draw and add up exactly. A leaf then owns
its blocks alone, and its rows are shuffled inside the shard. What is taken of a document
is what the leaves' blocks hold of it, in both ``taken_words`` and ``mixed``.

Only DataFrame operations; tables that are joined by broadcast have one row per source or
per block, and both numbers are checked or follow from the parameters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwelltide.llm.rows import columns, quoted, row_hash
from dwelltide.llm.words import word_count, words
from dwelltide.session import shared_folder

KEY_BITS = 60
#: Bits of the order that one level of the search for a source's last words looks at, and rows
#: of a source that are few enough to be looked at one by one.
PART_BITS = 12
FEW_ROWS = 10_000
#: Columns that place a row in its source's random order.
ORDER = ("key", "tie", "row")
#: Words of a shard that one task shuffles and sorts, about; a larger shard goes to several.
WORDS_PER_TASK = 2_000_000
#: Sources, and blocks, up to which their tables are sent to all executors.
BROADCAST_ROWS = 100_000
#: Sub-blocks of a block, at most; copies of a row that are made in one place.
SUB_BLOCKS = 1 << 20
COPIES_AT_ONCE = 1_000


@dataclass(frozen=True)
class Mix:
    """What a mix takes: ``sized`` documents, a row of ``rules`` per source, ``units``: the
    blocks of each pass over a source, with their shards."""

    sized: DataFrame
    rules: DataFrame
    units: DataFrame
    sources: int
    blocks: int
    tasks_per_shard: int
    seed: int
    id_col: str
    text_col: str
    source_col: str


def _key(id_col: str, seed: int) -> Column:
    """The place of a document in its source's random order, a number of 60 bits."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long")


def _tie(text: Column) -> Column:
    """The place of a row among rows of the same key, by its text: 60 bits."""
    digits = F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _row(docs: DataFrame) -> Column:
    """The place of a row among rows of the same key and text, by all its columns: 60 bits."""
    return F.shiftrightunsigned(row_hash(docs), 64 - KEY_BITS)


def _sent(rows: DataFrame, count: int) -> DataFrame:
    return F.broadcast(rows) if count <= BROADCAST_ROWS else rows


def ranked_weights(sizes: DataFrame, cycle: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """``(source, weight)``: weights repeat along the sources by code point, null last.
    One row per source passes one task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(cycle)
    weight = F.element_at(F.array(*map(F.lit, map(float, cycle))), place + 1)
    return sizes.select("source", weight.alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, share: float, ceiling: float) -> DataFrame:
    """``(source, source_size, target)``: shares by weight of ``share`` times all sizes; a
    target stops at ``ceiling`` times its source's size, and what is above goes to the others
    by weight, until none is above. Sources of no or no positive weight get nothing."""
    known = weights.select(F.col("source").alias("w_source"), "weight")
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("w_source")), "left").select(
        "source", "source_size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
    )
    rows = rows.checkpoint()
    level = 0.0
    full_before = -1
    stop = F.col("source_size") * F.lit(float(ceiling))
    while True:
        full = F.col("weight") * F.lit(level) > stop
        found = rows.agg(
            F.sum("source_size").alias("all"),
            F.count_if(full).alias("full"),
            F.sum(F.when(full, stop).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not found["all"] or not found["weight"] or found["full"] == full_before:
            break
        full_before = found["full"]
        level = (share * found["all"] - found["stopped"]) / found["weight"]
    return rows.select(
        "source",
        "source_size",
        F.least(F.col("weight") * F.lit(level), stop).alias("target"),
    )


def plan_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = 1.5,
    ceiling: float = 2.0,
    shards: int = 64,
    blocks_per_shard: int = 32,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    """Decide what of every document a mix takes and into which shard it goes.

    ``weights(source, weight)``; by default 5, 2 and 1 in turn along the sources. The mix has
    ``share`` times the words of all documents, no source more than ``ceiling`` times its
    own. A source is passed over as often as its target holds it whole; the last pass takes
    documents in the order of a hash of their ids and ends inside one of them, so that what
    is taken is the target rounded to a word. Among rows of the same id the order goes on by a
    hash of the text, then of all columns, and equal rows are numbered; so all are taken whole
    but the one in which a pass ends, in ``taken_words`` and ``mixed`` alike.

    A null source is a source; null texts and texts without words have size 0 and are taken
    with 0 words; a null id counts as the empty one. Repeated rows are rows. An empty table,
    or one without words, gives targets of 0. Other columns are kept and only break ties.

    Sizes are aggregated before the shuffle, and a source's boundary is found by sums over
    parts of its key range, level by level, so a hot source never meets in one task.
    """
    shared_folder(docs.sparkSession)
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        _key(id_col, seed).alias("key"),
        _tie(F.col(text_col).cast("string")).alias("tie"),
        _row(docs).alias("row"),
    ).checkpoint()
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size")).checkpoint()
    if weights is None:
        weights = ranked_weights(sizes)
    rules = targets(sizes, weights, share, ceiling).checkpoint()
    totals = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    sources, taken = int(totals[0]), float(totals[1])
    per_block = max(1, math.ceil(taken / (shards * blocks_per_shard)))
    blocks = sources + math.ceil(taken / per_block)
    rounded = F.floor(F.col("target") + 0.5)
    passes = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    rules = rules.select(
        "source",
        "source_size",
        "target",
        passes.alias("passes"),
        (rounded - passes * F.col("source_size")).alias("rest"),
        F.ceil(
            F.lit(1 << KEY_BITS)
            / F.greatest(F.lit(1), F.round(F.col("source_size") / F.lit(per_block)))
        ).alias("block_width"),
    ).checkpoint()
    ends = _ends(sized, rules, sources).withColumnRenamed("source", "e_source")
    rules = rules.join(
        _sent(ends, sources), F.col("source").eqNullSafe(F.col("e_source")), "left"
    ).drop("e_source").checkpoint()
    units = _units(sized, rules, sources, shards, seed, per_block)
    tasks = max(1, math.ceil(taken / shards / WORDS_PER_TASK))
    return Mix(sized, rules, units, sources, blocks, tasks, seed, id_col, text_col, source_col)


def _crossing(sums: DataFrame, *order: str) -> DataFrame:
    """Of ``(source, ..., words, rest)`` per source the row in which its words pass the rest, with
    ``left``: what the rest still holds there. A source whose words do not has no row."""
    so_far = F.sum("words").over(
        Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    left = F.col("rest") - F.col("so_far") + F.col("words")
    found = sums.withColumn("so_far", so_far).withColumn("left", left)
    return found.filter((F.col("so_far") > F.col("rest")) & (F.col("left") >= 0)).drop("so_far", "words", "rest")


def _ends(sized: DataFrame, rules: DataFrame, sources: int) -> DataFrame:
    """``(source, end_key, end_tie, end_row, end_rest)``: the row at which a source's last pass
    ends, and the words still taken from the rows that equal it. A source whose last pass
    takes all words, or none, has no row.

    Words are summed by parts of the order, and only the part in which the pass ends is looked
    at further, until a source has few rows there or all of them are equal."""
    rest = rules.filter("rest > 0").select(F.col("source").alias("s_source"), "rest")
    inside = sized.filter("size > 0").join(_sent(rest, sources), F.col("source").eqNullSafe(F.col("s_source")))
    inside = inside.select("source", *ORDER, "size", "rest")
    steps = [(column, shift) for column in ORDER for shift in range(KEY_BITS - PART_BITS, -1, -PART_BITS)]
    for column, shift in steps:
        part = F.shiftright(column, shift)
        sums = inside.groupBy("source", "rest", part.alias("part")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        at = _crossing(sums, "part").select(
            F.col("source").alias("s_source"), F.col("part").alias("s_part"), "left", "rows"
        ).checkpoint()
        inside = inside.join(
            _sent(at, sources), F.col("source").eqNullSafe(F.col("s_source")) & (part == F.col("s_part"))
        ).select("source", *ORDER, "size", F.col("left").alias("rest"))
        if (at.agg(F.max("rows")).first()[0] or 0) <= FEW_ROWS:
            break
        inside = inside.checkpoint()
    # Few rows, or equal ones, which the aggregation makes one.
    equal = inside.groupBy("source", "rest", *ORDER).agg(F.sum("size").alias("words"))
    return _crossing(equal, *ORDER).select(
        "source", *(F.col(c).alias(f"end_{c}") for c in ORDER), F.col("left").alias("end_rest")
    )


def _block(key_block: str, sub: Column) -> Column:
    return F.expr(key_block) * F.lit(SUB_BLOCKS) + sub


def _units(
    sized: DataFrame, rules: DataFrame, sources: int, shards: int, seed: int, per_block: int
) -> DataFrame:
    """``(source, pass, block, shard, key_block, parts)`` of every block of every pass.

    A range of keys that holds more than a block's words, as the rows of one id may, is cut
    into several blocks by the hash of the whole rows."""
    rule = rules.select(
        F.col("source").alias("r_source"), "passes", "rest", "block_width", "end_key"
    )
    blocks = (
        sized.filter(F.col("size") > 0)
        .join(_sent(rule, sources), F.col("source").eqNullSafe(F.col("r_source")))
        .groupBy("source", "passes", "rest", "end_key", "block_width", F.expr("key div block_width").alias("key_block"))
        .agg(F.sum("size").alias("words"))
        .withColumn("parts", F.expr(f"least({SUB_BLOCKS}, greatest(1, words div {per_block}))").cast("long"))
        .withColumn("sub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("block", _block("key_block", F.col("sub")))
    )
    last = (F.col("rest") > 0) & (
        F.col("end_key").isNull() | (F.col("key_block") <= F.expr("end_key div block_width"))
    )
    passes = F.col("passes") + last.cast("long")
    units = (
        blocks.withColumn("passes_of_block", passes)
        .filter(F.col("passes_of_block") > 0)
        .select("source", "block", "key_block", "parts", F.explode(F.sequence(F.lit(1).cast("long"), "passes_of_block")).alias("pass"))
    )
    # A source's blocks in random order; the tree deals places of that order.
    order = Window.partitionBy("source").orderBy(
        F.xxhash64(F.lit(seed), "source", "pass", "block"), "pass", "block"
    )
    placed = units.withColumn("place", F.row_number().over(order)).select(
        "*", F.lit(0).alias("shard"), F.lit(shards).alias("width")
    )
    for level in range(math.ceil(math.log2(max(1, shards)))):
        node = Window.partitionBy("shard", "width")
        drawn = node.orderBy(
            F.xxhash64(F.lit(seed), F.lit(level), "source", "place"), "source", "place"
        )
        placed = (
            placed.withColumn("left_width", F.expr("width div 2"))
            .withColumn("left_blocks", F.expr("count(1) OVER (PARTITION BY shard, width) * left_width div width"))
            .withColumn("goes_left", F.row_number().over(drawn) <= F.col("left_blocks"))
            .select(
                "source",
                "pass",
                "block",
                "key_block",
                "parts",
                "place",
                F.when(F.col("goes_left"), F.col("shard"))
                .otherwise(F.col("shard") + F.col("left_width"))
                .alias("shard"),
                F.when(F.col("goes_left"), F.col("left_width"))
                .otherwise(F.col("width") - F.col("left_width"))
                .alias("width"),
            )
        )
    return placed.select("source", "pass", "block", "shard", "key_block", "parts").checkpoint()


def _last(size: Column) -> Column:
    """Words that the last pass takes of a document: whole ones as long as the words last."""
    before = F.lit(False)
    for column in reversed(ORDER):
        own, end = F.col(column), F.col(f"end_{column}")
        before = (own < end) | ((own == end) & before)
    left = F.col("end_rest") - F.col("copy") * size
    return (
        F.when(F.col("rest") <= 0, F.lit(0))
        .when(F.col("end_key").isNull() | before, size)
        .when(_ends_here(), F.greatest(F.lit(0), F.least(size, left)))
        .otherwise(F.lit(0))
        .cast("long")
    )


def _ends_here() -> Column:
    here = F.lit(True)
    for column in ORDER:
        here = here & (F.col(column) == F.col(f"end_{column}"))
    return here


def _numbered(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """``rows`` of ``(doc, source, key, tie, row)`` with ``copy``: equal rows are numbered from 0."""
    same = ["source", *ORDER]
    repeated = (
        sized.filter(F.col("size") > 0).groupBy(*same).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(*(F.col(c).alias(f"r_{c}") for c in same)).checkpoint()
    )
    first = F.lit(0).cast("long")
    if repeated.isEmpty():
        return rows.withColumn("copy", first)
    found = F.col("source").eqNullSafe(F.col("r_source"))
    for column in ORDER:
        found = found & (F.col(column) == F.col(f"r_{column}"))
    once = rows.join(repeated, found, "left_anti").withColumn("copy", first)
    # Equal rows become one with their number, and as many again, in several places.
    counted = rows.join(repeated, found, "left_semi").groupBy(*same).agg(
        F.first("doc").alias("doc"), F.count(F.lit(1)).alias("n")
    )
    chunks = counted.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES_AT_ONCE})")))
    made = chunks.repartition(*ORDER, "chunk").withColumn(
        "copy",
        F.explode(F.expr(f"sequence(chunk * {COPIES_AT_ONCE}, least(n, (chunk + 1) * {COPIES_AT_ONCE}) - 1)")),
    )
    return once.unionByName(made.select("doc", *same, "copy"))


def _placed(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` of ``(doc, source, key, tie, row, copy)`` with their source's rule and the block
    that holds them."""
    rule = mix.rules.withColumnRenamed("source", "r_source")
    split = mix.units.filter("parts > 1").select(
        F.col("source").alias("s_source"), F.col("key_block").alias("s_block"), "parts"
    ).distinct()
    source = F.col("source")
    rows = rows.join(_sent(rule, mix.sources), source.eqNullSafe(F.col("r_source"))).join(
        _sent(split, mix.blocks * 2),
        source.eqNullSafe(F.col("s_source")) & (F.expr("key div block_width") == F.col("s_block")),
        "left",
    )
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    sub = F.pmod(F.xxhash64(F.lit(mix.seed), "tie", "row", "copy"), parts)
    return rows.withColumn("block", _block("key div block_width", sub))


def taken_words(mix: Mix) -> DataFrame:
    """``(id, size, source_size, target, taken)`` of every document: what the blocks that the tree
    dealt to the shards hold of it, over all passes."""
    rows = mix.sized.select(F.struct("id", "size").alias("doc"), "source", *ORDER)
    rows = _placed(_numbered(rows, mix.sized), mix)
    size = F.col("doc.size")
    whole = F.col("pass") <= F.col("passes")
    dealt = (
        mix.units.join(
            _sent(mix.rules.select(F.col("source").alias("p_source"), "passes"), mix.sources),
            F.col("source").eqNullSafe(F.col("p_source")),
        )
        .groupBy(F.col("source").alias("u_source"), F.col("block").alias("u_block"))
        .agg(F.count_if(whole).alias("whole"), F.count_if(~whole).alias("ending"))
    )
    held = F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block")) & (size > 0)
    taken = F.coalesce(F.col("whole") * size + F.col("ending") * _last(size), F.lit(0).cast("long"))
    return rows.join(_sent(dealt, mix.blocks * 6), held, "left").select(
        F.col("doc.id").alias(mix.id_col), size.alias("size"), "source_size", "target", taken.alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix, shard_col: str | None = None) -> DataFrame:
    """The rows of the mix, by shard and in random order inside each, with the columns of
    ``docs`` (and the shard, if ``shard_col`` names it).

    A document stands there once per pass that takes it. Of the one in which a source's last
    pass ends, that pass takes the first words, with single spaces between. Documents
    without words are in no mix. A task gets a range of a shard's random order, of about
    ``WORDS_PER_TASK`` words however large the shard is, and sorts it.
    """
    text, own = F.col(f"doc.{quoted(mix.text_col)}").cast("string"), docs.columns
    unit = mix.units.select(
        F.col("source").alias("u_source"), F.col("pass").alias("u_pass"), F.col("block").alias("u_block"), "shard"
    )
    rows = docs.select(
        F.struct(*columns(docs)).alias("doc"),
        F.col(mix.source_col).cast("string").alias("source"),
        _key(mix.id_col, mix.seed).alias("key"),
        _tie(F.col(mix.text_col).cast("string")).alias("tie"),
        _row(docs).alias("row"),
    )
    rows = _placed(_numbered(rows, mix.sized), mix)
    # Sizes are counted again only where a pass ends.
    rows = rows.withColumn("size", F.when(_ends_here(), word_count(text)).otherwise(text.rlike(r"[^\x20\x09-\x0D]").cast("long")))
    rows = rows.filter(F.col("size") > 0).withColumn("last", _last(F.col("size")))
    passes = F.col("passes") + (F.col("last") > 0).cast("long")
    rows = rows.withColumn("n", passes).filter(F.col("n") > 0)
    rows = rows.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    rows = rows.join(
        _sent(unit, mix.blocks * 6),
        F.col("source").eqNullSafe(F.col("u_source"))
        & (F.col("pass") == F.col("u_pass"))
        & (F.col("block") == F.col("u_block")),
    )
    cut = _ends_here() & (F.col("pass") > F.col("passes")) & (F.col("last") < F.col("size"))
    first = F.array_join(F.slice(words(text), 1, F.col("last").cast("int")), " ")
    kept = [
        (F.when(cut, first).otherwise(text) if c == mix.text_col else F.col(f"doc.{quoted(c)}")).alias(c)
        for c in own
    ]
    place = F.xxhash64(F.lit(mix.seed), *ORDER, "copy", "pass")
    part = F.floor((F.col("place") / 2.0**64 + 0.5) * mix.tasks_per_shard)
    return (
        rows.select(F.struct(*kept).alias("doc"), "shard", place.alias("place"))
        .withColumn("part", part)
        .repartition("shard", "part")
        .sortWithinPartitions("shard", "place")
        .select("doc.*", *([F.col("shard").alias(shard_col)] if shard_col else []))
    )
