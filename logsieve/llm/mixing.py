"""Mixing sources to target weights by a low-discrepancy schedule.

Golden-ratio points t * phi mod 1 are mapped through the cumulative target weights, so that
each slot t draws from one source and every stretch of the schedule holds each source in
proportion. Slots are ranked per source, and the r-th slot of a source takes the r-th block of
its shuffled documents, laid end to end and cut into blocks of equal token counts; after the
last block the source starts over, up to `max_passes` times.

The circle has as many slots whatever the input (`slots`), so its size is bounded; a block's tokens
grow with the input instead. A source whose target is less than FINE such blocks is too small for
the circle, whose points may miss it: it has blocks of its own, a FINE-th of its target or one word,
and as many slots of its own as its target needs, evenly spread over the schedule. So each source
takes about its target at any size, and the schedule has `slots` + 2 * FINE rows a small source at
most. Documents are never gathered by source: their places come from chunked running totals
(`blocks.with_running`).

Defined cases: null source is a source of its own, last in order; null or empty text has size 0
and is taken 0 times; a source without words has target 0; a null doc_id is a row like others;
rows with equal doc_id are separate documents, and equal rows are interchangeable; an empty
table gives no rows. Columns other than doc_id, text and source are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import with_running, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
SLOTS = 1 << 16
#: a source of fewer blocks than this is scheduled by blocks of its own
FINE = 64
#: floor(2**32 / golden ratio): the step of the golden-ratio points on a 32-bit circle.
GOLDEN = 2654435769
CIRCLE = 1 << 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    """60 bits of the id's MD5: the documents' shuffled order, the same in each run."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """sizes (source, source_size) with each source's weight and target.

    A target is min(level * weight, max_passes * source_size) at the one level at which the
    targets sum up to the share of all sizes: what resharing the excess by weight ends at.
    One row per source, so the windows below run over as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(max_passes))
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    s = (s.withColumn("capped", F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("left_w", F.sum("weight").over(whole)
                     - F.coalesce(F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("level", (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce("capped", F.lit(0)))
                     / F.col("left_w")))
    # The first source, in order of cap per weight, that its level doesn't fill sets the level. Levels only fall
    # after it (each capped source there takes more than its share), so it's the highest of those.
    s = s.withColumn("final", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole))
    return s.select("source", "source_size",
                    F.when(F.col("final").isNull(), F.col("cap").cast("double"))
                    .otherwise(F.least(F.col("final") * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def schedule(goals: DataFrame, slots: int = SLOTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """slot, source, rank, pass, block, block_tokens: what each slot of the mix takes.

    goals: source, source_size, target. The circle's slots are as many as given for any input; those that fall to a
    source of fewer than FINE blocks stay empty, and `_fine` schedules it.
    """
    whole = Window.partitionBy()
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    g = (goals.where("target > 0").withColumn("milli", F.round(F.col("target") * 1000).cast("long"))
         .withColumn("cum", F.sum("milli").over(upto)).withColumn("total", F.sum("milli").over(whole)))
    g = (g.withColumn("hi", F.floor(F.col("cum") * F.lit(float(CIRCLE)) / F.col("total")).cast("long"))
         .withColumn("block_tokens", F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(1000.0 * slots))).cast("long"))
         .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block_tokens")).cast("long")))
    g = (g.withColumn("n_slots", F.ceil(F.col("total") / (F.lit(1000.0) * F.col("block_tokens"))).cast("long"))
         .withColumn("small", F.col("target") < F.col("block_tokens") * F.lit(FINE))
         .withColumn("goal", F.struct("source", "n_blocks", "block_tokens", "n_slots", "small")))
    spark = goals.sparkSession
    points = spark.range(0, slots, 1, 8).select(F.col("id").alias("slot"),
                                                ((F.col("id") * F.lit(GOLDEN)) % F.lit(CIRCLE)).alias("at"))
    # Points and upper ends in one order: a point belongs to the first end above it.
    ends = g.select(F.lit(None).cast("long").alias("slot"), F.col("hi").alias("at"), "goal")
    line = points.withColumn("goal", F.lit(None).cast(g.schema["goal"].dataType)).unionByName(ends)
    down = Window.orderBy(F.col("at").desc(), F.col("slot").asc_nulls_first(), F.col("goal.source").desc_nulls_first())
    line = line.withColumn("goal", F.last("goal", ignorenulls=True).over(
        down.rowsBetween(Window.unboundedPreceding, 0))).where("slot < goal.n_slots and not goal.small")
    rank = Window.partitionBy("goal.source").orderBy("slot")
    out = line.select("slot", "goal.source", "goal.n_blocks", "goal.block_tokens", (F.row_number().over(rank) - 1).cast("long").alias("rank"))
    return (out.withColumn("pass", F.floor(F.col("rank") / F.col("n_blocks")).cast("long"))
            .withColumn("block", F.col("rank") % F.col("n_blocks"))
            .where(F.col("pass") < max_passes)
            .select("slot", "source", "rank", "pass", "block", "block_tokens")
            .unionByName(_fine(g.where("small"), max_passes)))


def _fine(g: DataFrame, max_passes: int) -> DataFrame:
    """The schedule's rows of small sources: whole passes, then as many blocks as come nearest to the target.

    The rank-th of a source's slots stands in the rank-th of so many equal stretches of the circle's slots, at a
    place within it that goes by the source's name.
    """
    g = (g.withColumn("block_tokens", F.greatest(F.lit(1), F.ceil(F.col("target") / F.lit(FINE))).cast("long"))
         .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block_tokens")).cast("long"))
         .withColumn("whole", F.least(F.lit(max_passes), F.floor(F.col("target") / F.col("source_size"))).cast("long"))
         .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
         .withColumn("n", (F.col("whole") * F.col("n_blocks") + F.round(F.col("rest") / F.col("block_tokens"))).cast("long"))
         .withColumn("at", F.pmod(F.xxhash64("source"), F.lit(CIRCLE)) / F.lit(float(CIRCLE))))
    out = (g.where("n > 0").withColumn("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
           .withColumn("slot", F.floor((F.col("rank") + F.col("at")) * F.col("n_slots") / F.col("n")).cast("long"))
           .withColumn("pass", F.floor(F.col("rank") / F.col("n_blocks")).cast("long"))
           .withColumn("block", F.col("rank") % F.col("n_blocks")))
    return out.where(F.col("pass") < max_passes).select("slot", "source", "rank", "pass", "block", "block_tokens")


def placed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, source, size, ...) with `start`: its first word's place in its source's shuffled order."""
    keyed = docs.withColumn("okey", order_key(F.col("doc_id")))
    return with_running(keyed, ["source"], ["okey", "doc_id", "size"], F.col("size"), "start", key_bits=60)


def pieces(places: DataFrame, plan: DataFrame) -> DataFrame:
    """One row for each scheduled piece of a document: slot, pass, block, first and end word within it.

    A document meets the blocks that it overlaps: documents + blocks rows at most in all.
    """
    # one row for each source in the plan, written so that its size is known before the join
    width = written(plan.groupBy(F.col("source").alias("_s")).agg(F.max("block_tokens").alias("block_tokens")), "widths")
    cut = (places.where("size > 0").join(width, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
           .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("block_tokens")),
                                                     F.floor((F.col("start") + F.col("size") - 1) / F.col("block_tokens"))))))
    cut = (cut.withColumn("first_word", F.greatest(F.lit(0), F.col("block") * F.col("block_tokens") - F.col("start")))
           .withColumn("end_word", F.least(F.col("size"), (F.col("block") + 1) * F.col("block_tokens") - F.col("start")))
           .drop("block_tokens"))
    p = plan.select("slot", "pass", F.col("block").alias("_b"), F.col("source").alias("_s"))
    return cut.join(p, (F.col("block") == F.col("_b")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_b", "_s")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
        slots: int = SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, schedule, pieces) of the mix over docs (doc_id, text, source).

    documents: doc_id, source, size, source_size, target, start, taken.
    """
    base = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    sizes = base.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    goals = written(targets(sizes, weights, share, max_passes), "targets")
    plan = written(schedule(goals, slots, max_passes), "schedule")
    places = written(placed(base), "places")
    cut = pieces(places, plan)
    taken = (cut.withColumn("n", F.col("end_word") - F.col("first_word"))
             .groupBy("source", "start").agg(F.sum("n").alias("_n"))
             .select(F.col("source").alias("_s"), F.col("start").alias("_at"), "_n"))
    g = goals.select(F.col("source").alias("_gs"), "source_size", "target")
    out = (places.join(taken, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_at"))
                       & (F.col("size") > 0), "left")
           .join(g, F.col("source").eqNullSafe(F.col("_gs")), "left"))
    return (out.select("doc_id", "source", "size", "source_size", "target", "start",
                       F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("taken")), plan, cut)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of docs, one for each pass that takes words of them, all columns kept.

    A document that a pass takes only in part (at the end of its source's last pass) keeps its
    first words up to there. Documents that the targets leave out are left out.
    """
    _, _, cut = mix(docs, **options)
    per_pass = (cut.groupBy("doc_id", "source", "start", "size", "pass")
                .agg(F.max("end_word").alias("words"))
                .select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_n"), "start",
                        F.col("pass").alias("_p"), "words"))
    # All columns of docs travel in one, so that none meets ours.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    text = F.col("_row.text")
    # Rows with equal doc_id, source and size are numbered alike on both sides.
    rows = rows.withColumn("_size", n_words(text))
    side = Window.partitionBy("_row.doc_id", "_row.source", "_size").orderBy(F.xxhash64(text))
    rows = rows.withColumn("_k", F.row_number().over(side))
    places = per_pass.withColumn("_pk", F.dense_rank().over(Window.partitionBy("_d", "_s", "_n").orderBy("start")))
    out = rows.join(places, F.col("_row.doc_id").eqNullSafe(F.col("_d")) & F.col("_row.source").eqNullSafe(F.col("_s"))
                    & (F.col("_size") == F.col("_n")) & (F.col("_k") == F.col("_pk")))
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)")),
                                F.lit(1), F.col("words").cast("int")), "")
    taken = F.when(F.col("words") < F.col("_size"), part).otherwise(text)
    return out.select(*[(taken if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken", "source", "start")


ORACLE = f"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as okey from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight,
    2 * source_size as cap from s),
r as (select *, cap / weight as ratio from w),
l as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (order by ratio, source nulls last
    rows between unbounded preceding and 1 preceding), 0)) / sum(weight) over (order by ratio, source nulls last
    rows between current row and unbounded following) as level from r),
f as (select *, max(case when level <= ratio then level end) over () as final from l),
g as (select source, source_size, case when final is null then cap::double else least(final * weight, cap::double) end
    as target from f),
m as (select *, round(target * 1000)::bigint as milli from g where target > 0),
c as (select *, sum(milli) over (order by source nulls last)::bigint as cum, sum(milli) over ()::bigint as total from m),
e as (select *, floor(cum * {CIRCLE}.0::double / total)::bigint as hi,
    greatest(1, ceil(total / (1000.0::double * {SLOTS})))::bigint as block_tokens from c),
e2 as (select *, coalesce(lag(hi) over (order by source nulls last), -1) as lo,
    ceil(source_size::double / block_tokens)::bigint as n_blocks,
    ceil(total / (1000.0::double * block_tokens))::bigint as n_slots from e),
pts as (select t as slot, (t * {GOLDEN}) % {CIRCLE} as at from range({SLOTS}) x(t)),
sl as (select p.slot, e2.source, n_blocks, block_tokens,
    row_number() over (partition by e2.source order by p.slot) - 1 as rank
    from pts p join e2 on p.at > e2.lo and p.at <= e2.hi and p.slot < e2.n_slots),
tk as (select source, block_tokens, rank % n_blocks as block, count(*) as times from sl
    where rank // n_blocks < 2 group by all),
p as (select d.*, coalesce(sum(size) over (partition by source order by okey, doc_id, size
    rows between unbounded preceding and 1 preceding), 0)::bigint as start from d),
x as (select p.source, p.start, sum(tk.times * (least(start + size, (block + 1) * block_tokens)
    - greatest(start, block * block_tokens)))::bigint as n from p join tk on p.source is not distinct from tk.source
    and tk.block * tk.block_tokens < p.start + p.size and (tk.block + 1) * tk.block_tokens > p.start
    where p.size > 0 group by all)
select p.doc_id, p.size, g.source_size, g.target, coalesce(x.n, 0)::bigint as taken, p.source, p.start
from p join g on p.source is not distinct from g.source
left join x on p.size > 0 and p.source is not distinct from x.source and p.start = x.start
"""
