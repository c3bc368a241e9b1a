"""Mixing sources to target weights by proportionate-fair scheduling.

The rows of a source are cut into blocks of equal size. With weight w, block i of a source
(from 1) is released at slot floor((i-1)/w) and due by slot ceil(i/w), and the schedule keeps
every source within less than one block of its target after any number of slots.

One earliest-deadline-first run over all sources is sequential in the blocks, so sources are paired
into groups, groups into larger ones, up to a single group of weight 1, and each pair is scheduled
on its own: of two groups with shares p and 1-p, unit i of the first stands at the middle of its
window, slot ceil((i - 1/2) / p), and the second group's units take the other slots in their
order; no unit leaves its window, and the two never ask for the same slot. A pair adds at most half
a unit of deviation, so d levels add at most d / 2; blocks are cut into more than d / 2 units, which
keeps the sum below one block. A unit's slot follows from its number in d steps of exact integer
arithmetic, without the schedule before it: no frame is repeated and no weight is rounded.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.arrow import carried, quoted, unpacked
from shelfcast.session import cut_lineage

#: Powers of row counts count in parts of this many, given weights in at most as many decimal
#: places as keep their sum below LARGEST.
POWER_PARTS, GIVEN_PLACES, LARGEST = 10**6, 12, 10**18
#: Rows that are ranked together at most, on average, and buckets whose counts are added together.
BUCKET_ROWS, SUPER = 512, 1024


def _weighed(sizes, weights, temperature):
    """Sources with their rows and integer weight; a source that `weights` lacks has weight 0."""
    if weights is None:
        weight = F.round(F.pow("rows", F.lit(float(temperature))) * POWER_PARTS)
    else:
        whole = len(str(int(sum(weights.values()))))
        parts = 10 ** max(0, min(GIVEN_PLACES, len(str(LARGEST)) - 1 - whole))
        table = F.create_map(*[F.lit(x) for s, w in weights.items() for x in (s, round(w * parts))])
        weight = F.coalesce(table[F.col("__source")], F.lit(0))
    return sizes.withColumn("__weight", weight.cast("decimal(20,0)"))


def _paths(weighed, levels):
    """For each source of positive weight the groups above it: (left half?, own weight, pair's weight)."""
    order = Window.orderBy("__source")  # one row a source
    placed = weighed.where("__weight > 0").withColumn("i", F.row_number().over(order) - 1)
    spread = placed.select("i", "__weight", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("k"))
    nodes = spread.groupBy("k", F.expr("shiftright(i, k)").alias("node")).agg(
        F.sum("__weight").cast("decimal(20,0)").alias("weight")
    )
    steps = placed.select("__source", "i", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("k"))
    own = steps.where(F.col("k") < levels).withColumn("node", F.expr("shiftright(i, k)")).join(nodes, ["k", "node"])
    pair = nodes.select((F.col("k") - 1).alias("k"), F.col("node").alias("pair"), F.col("weight").alias("both"))
    joined = own.withColumn("pair", F.expr("shiftright(node, 1)")).join(pair, ["k", "pair"])
    step = F.struct("k", (F.col("node") % 2 == 0).alias("left"), F.col("weight").alias("own"), "both")
    return joined.groupBy("__source").agg(F.sort_array(F.collect_list(step)).alias("__path"))


def _slot_of(unit):
    """Slot (from 1) of a source's unit: its place in ever larger groups."""
    return F.expr(f"""aggregate(__path, cast({unit} as decimal(20,0)), (n, p) -> cast(if(p.left,
        ((2 * n - 1) * p.both + 2 * p.own - 1) div (2 * p.own), ((2 * n - 1) * p.both) div (2 * p.own) + 1)
        as decimal(20,0)), n -> cast(n as long))""")


def _per_source(weighed, levels, unit_rows):
    """What the rows of a source need: its path, weight, the sum of weights, where it stands if it has none."""
    units = F.ceil(F.col("rows") / unit_rows)
    total = weighed.agg(F.sum("__weight").cast("decimal(20,0)").alias("__total"))
    paths = _paths(weighed, levels) if levels else weighed.where("__weight > 0").select(
        "__source", F.expr("cast(array() as array<struct<k:int,left:boolean,own:decimal(20,0),both:decimal(20,0)>>)").alias("__path")
    )
    with_paths = weighed.join(paths, "__source", "left").withColumn("__units", units.cast("long"))
    ends = with_paths.where("__weight > 0").agg(
        F.min(_slot_of("__units + 1")).alias("__end"), F.coalesce(F.max(_slot_of("__units")), F.lit(0)).alias("__last")
    )
    before = Window.orderBy("__source").rowsBetween(Window.unboundedPreceding, -1)  # one row a source
    rest = weighed.where("__weight = 0").select(
        F.col("__source").alias("__idle"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__after")
    )
    joined = with_paths.join(ends).join(total)
    return joined.join(rest, joined["__source"] == rest["__idle"], "left").drop("__idle")


def _starts(dealt, per_source):
    """(source, bucket) with the rank of its first row and what `per_source` has of the source.

    The sum of the counts before a bucket is added up in two levels, so that no task sees all
    buckets of a large source.
    """
    counts = dealt.groupBy("__source", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("super", F.floor(F.col("__bucket") / SUPER))
    within = Window.partitionBy("__source", "super").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("__source").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = counts.groupBy("__source", "super").agg(F.sum("n").alias("all"))
    supers = supers.select("__source", "super", F.coalesce(F.sum("all").over(across), F.lit(0)).alias("base"))
    placed = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return placed.join(supers, ["__source", "super"]).join(per_source, "__source").select(
        F.col("__source").alias("__s"), F.col("__bucket").alias("__b"),
        (F.col("base") + F.col("inside")).alias("__start"), "__path", "__weight", "__total", "__end", "__last", "__after",
    )


def mix(docs, weights=None, temperature=0.7, block_rows=64, doc_id="doc_id", source="source"):
    """All columns of `docs` with block, release, deadline, slot, position and balanced.

    `weights` maps sources to target weights of any sum; without it a source weighs its rows to
    the power of `temperature`. `block` counts from 1, `release` and `deadline` are its window in
    slots of a block, exact for its weight (null for weight 0), `position` orders all rows (with
    gaps where a last unit is short or a source has run out) and `slot` is position div
    block_rows. No row is left out: `balanced` tells whether a row comes before the first source
    runs out, up to which point all targets hold. Sources of weight 0, or not in `weights`, follow
    after everything else, one after another.

    `block_rows` is taken as a multiple of the units of a block (a power of two above half the
    number of levels); smaller blocks are single rows. Rows of a source come in the order of
    md5(id), so blocks are random but stable; rows that repeat an id follow each other. A null
    source and the empty one are the same source; a null id is hashed as empty. Columns of the
    result's names that were there, in whatever case, are replaced.
    """
    added = ("block", "release", "deadline", "slot", "position", "balanced")
    keyed = carried(
        docs, __source=F.coalesce(quoted(source), F.lit("")), __id=quoted(doc_id),
        __md5=F.md5(F.coalesce(quoted(doc_id).cast("string"), F.lit("")).cast("binary")),
    )
    weighed = cut_lineage(_weighed(keyed.groupBy("__source").agg(F.count(F.lit(1)).alias("rows")), weights, temperature))
    rows, sources = weighed.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count_if(F.col("__weight") > 0)).first()
    levels = max(0, sources - 1).bit_length()
    units = 1 << (levels // 2).bit_length()
    unit_rows = max(1, block_rows // units)
    # every source is dealt into as many buckets: about BUCKET_ROWS rows of all sources each
    buckets = max(1, -(-rows // BUCKET_ROWS))
    leading = F.conv(F.substring("__md5", 1, 8), 16, 10).cast("long")
    dealt = keyed.withColumn("__bucket", F.floor(leading * F.lit(buckets) / F.lit(2**32)))
    starts = _starts(dealt, _per_source(weighed, levels, unit_rows))
    order = Window.partitionBy("__source", "__bucket").orderBy("__md5", "__id")
    numbered = dealt.withColumn("__n", F.row_number().over(order) - 1)
    joined = numbered.join(starts, (F.col("__source") == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    ranked = joined.withColumn("__rank", F.col("__start") + F.col("__n"))
    placed = ranked.withColumn("__at", F.when(F.col("__weight") > 0, _slot_of(f"__rank div {unit_rows} + 1") - 1))
    position = F.coalesce(
        F.col("__at") * unit_rows + F.col("__rank") % unit_rows,
        F.coalesce("__last", F.lit(0)) * unit_rows + F.col("__after") + F.col("__rank"),
    )
    return unpacked(placed.withColumns({
        "block": F.expr(f"__rank div {block_rows} + 1"), "position": position,
        "balanced": F.coalesce(F.col("__at") + 1 < F.col("__end"), F.lit(False)),
    }).withColumns({
        "release": F.expr("if(__weight > 0, ((block - 1) * __total) div __weight, null)"),
        "deadline": F.expr("if(__weight > 0, (block * __total + __weight - 1) div __weight, null)"),
        "slot": F.expr(f"position div {block_rows}"),
    }), docs.columns, added)
