"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Targets: the sources share all words by weight; a target stops at a multiple of its source's size and the excess is shared
again. Blocks: all words make blocks of equal length, and each block goes to the source with the highest quotient of its target
and 1, 3, 5, ...; each source's quota is dealt over its shards in the same way. Selection: a shard's documents lie end to end
in a seeded order, cut into blocks; its quota takes the blocks from the first, going round again when the end is reached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.llm.common import row_hash, stored
from civiclake.operators.lookups import lookup_key
from civiclake.operators.numbering import surrogate_key

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
#: How often a source's words, and a document's, may be taken.
REPEATS = 3
#: Words in a block.
BLOCK = 16
#: Documents in a shard, on average. A large source has many shards, so no task gets a whole source.
SHARD_DOCUMENTS = 4096
SEED = 17
#: Numbers of so many sources are broadcast (five longs each); beyond that they are joined by a shuffle.
SOURCES_TO_SEND = 1 << 20


def words(text: str) -> Column:
    """Number of words of a text column; null and blank texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, repeats: int = REPEATS) -> float:
    """What a weight of one gets once no target exceeds ``repeats`` times its source's size (columns size, weight).

    Each pass shares the words of the sources that aren't at their limit. The sources at their limit only get more, so this
    ends; two sums come to the driver in each pass.
    """
    total = sources.agg(F.sum("size")).first()[0] or 0
    level, stopped = 0.0, -1
    while total:
        full = F.col("size") * repeats < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("size") * repeats)), F.lit(0)).alias("words"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count(F.when(full, 1)).alias("stopped"),
        ).first()
        if row["stopped"] == stopped:
            break
        stopped, level = row["stopped"], float(total - row["words"]) / float(row["weight"])
    return level


def apportion(parties: DataFrame, group: str | None, party: str, share: str, seats: str) -> DataFrame:
    """Sainte-Laguë: ``party`` and its ``quota`` of the group's ``seats``, by ``share``; ties go to the smaller party.

    The share rounded at the mean number of words per seat misses the seats by at most half the number of parties. Only the
    quotients next to it are ranked, (share / shares) * parties / 2 + 1 for each party, since a divisor that settles the rest
    moves no party further. So ranking takes 1.5 rows per party, whatever the number of seats.
    """
    keyed = parties.where(F.col(share) > 0).select(
        # without a group, one key for all; computed, so that the joins below stay joins on a key
        (F.col(group) if group else F.col(party) * 0).alias("g"), F.col(party).alias("p"),
        F.col(share).cast("double").alias("s"), F.col(seats).alias("n"),
    )
    sums = keyed.groupBy("g").agg(F.sum("s").alias("all"), F.count("*").alias("parties"))
    rounded = keyed.join(sums, "g").withColumn("r", F.floor(F.col("s") * F.col("n") / F.col("all") + 0.5).cast("long"))
    missing = rounded.groupBy("g").agg((F.first("n") - F.sum("r")).alias("missing"))
    rounded = stored(rounded.join(missing, "g"), "seats")
    reach = (F.ceil(F.col("s") / F.col("all") * F.col("parties") / 2) + 1).cast("long")
    seat = (
        F.when(F.col("missing") > 0, F.sequence(F.col("r") + 1, F.col("r") + reach))
        .when((F.col("missing") < 0) & (F.col("r") > 0), F.sequence(F.greatest(F.lit(1), F.col("r") - reach + 1), F.col("r")))
    )
    contested = rounded.withColumn("seat", F.explode(seat))
    # seats to add are ranked from the highest quotient, seats to take away from the lowest
    sign = F.signum("missing")
    order = {"rank_by": -sign * F.col("s") / (2 * F.col("seat") - 1), "tie": sign * F.col("p")}
    contested = contested.select("g", "p", "missing", *[of.alias(name) for name, of in order.items()], "seat")
    if group:
        place = F.row_number().over(Window.partitionBy("g").orderBy(*order, "seat"))
        ranked = contested.withColumn("place", place)
    else:
        ranked = surrogate_key(contested, "place", [*order, "seat"])
    changed = ranked.where(F.col("place") <= F.abs("missing")).groupBy("g", "p").agg(
        F.sum(F.signum("missing")).cast("long").alias("change")
    )
    quota = F.col("r") + F.coalesce("change", F.lit(0))
    found = rounded.join(changed, ["g", "p"], "left")
    return found.select(*([F.col("g").alias(group)] if group else []), F.col("p").alias(party), quota.alias("quota"))


def _sendable(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= SOURCES_TO_SEND else table


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, shard_documents: int = SHARD_DOCUMENTS,
    seed: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` in words, ``source_size``, ``target``, ``taken``.

    Sources in code point order, null last, get the ``weights`` in turn. No document is taken more than ``repeats`` times: it
    is taken floor(taken / size) times whole, and its first taken mod size words once more. Null and blank texts have size 0
    and nothing of them is taken. Rows with one id lie next to each other by size; rows that are equal in both are alike.
    An empty table gives an empty one; if there are no words at all, targets are 0. Other columns are ignored. What a row draws
    depends on ``seed``, its id unless given.
    """
    drawn = F.col(id_column) if seed is None else seed
    seeded = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(drawn.cast("string"), F.lit(""))).cast("binary"))
    sizes = stored(docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(source_column).alias("source"), words(text_column).alias("size"),
        seeded.alias("place"),
    ), "sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("documents"))
    sources = stored(surrogate_key(sources.withColumn("missing", F.isnull("source")), "number", ["missing", "source"]), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int")).cast("long")
    weighed = sources.withColumn("weight", weight)
    level = F.lit(water_level(weighed, repeats))
    total, count = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    targets = weighed.select(
        "number", F.col("size").alias("source_size"),
        F.least((F.col("size") * repeats).cast("double"), level * F.col("weight")).alias("target"),
        F.greatest(F.lit(1), F.ceil(F.col("documents") / shard_documents)).cast("long").alias("shards"),
        F.lit(total // block).cast("long").alias("blocks"),
    )
    quotas = apportion(targets, None, "number", "target", "blocks").withColumnRenamed("quota", "source_quota")
    plan = stored(targets.join(quotas, "number", "left").na.fill(0, ["source_quota"]).drop("blocks"), "targets")
    numbered = lookup_key(sizes, sources, "number", {"source": "source"}, null_safe=["source"], spread=["doc_id", "size"])
    shard = F.pmod(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), F.col("shards"))
    rows = numbered.join(_sendable(plan, count), "number").select(
        "doc_id", "size", "place", "number", shard.alias("shard"), "source_size", "target", "source_quota"
    )
    cells = stored(
        rows.groupBy("number", "shard").agg(F.sum("size").alias("cell"), F.first("source_quota").alias("source_quota")), "cells"
    )
    shares = apportion(cells, "number", "shard", "cell", "source_quota")
    line = Window.partitionBy("number", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0)))
    wanted = cells.join(shares, ["number", "shard"], "left").select(
        "number", "shard", "cell", F.least(F.coalesce("quota", F.lit(0)) * block, F.col("cell") * repeats).alias("wanted")
    )
    rounds = F.when(F.col("cell") > 0, F.expr("wanted div cell")).otherwise(0)
    rest = F.col("wanted") - rounds * F.col("cell")
    once_more = F.greatest(F.lit(0), F.least(F.col("start") + F.col("size"), rest) - F.col("start"))
    return laid.join(wanted, ["number", "shard"]).select(
        "doc_id", "size", "source_size", "target", (rounds * F.col("size") + once_more).cast("long").alias("taken")
    )


def sample(docs: DataFrame, text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mixed rows of ``docs``, with its columns: each document as often as the mix takes it, the last time perhaps only
    its first words. Documents the mix takes nothing of, and those without words, are not in it. What a row draws depends on its
    values alone, not on how ``docs`` is laid out in files or partitions; which of several equal rows is taken does not show."""
    if "_row" in docs.columns:
        raise ValueError("column _row exists")
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "mixed")
    drawn = row_hash(docs)
    takes = mix(rows, "_row", text_column, source_column, seed=drawn).where("taken > 0").select(
        F.col("doc_id").alias("_row"), F.expr("taken div size").alias("_whole"), F.expr("taken % size").alias("_rest")
    )
    copies = F.array_repeat(F.lit(0).cast("long"), F.col("_whole").cast("int"))
    cut = F.explode(F.when(F.col("_rest") > 0, F.array_append(copies, F.col("_rest"))).otherwise(copies))
    text = F.col(text_column)
    # what is left of the text after its first _words words, if it has more
    leads = F.when(text.rlike(f"^{GAP}"), 1).otherwise(0)
    after = F.element_at(F.split(text, GAP, (F.col("_words") + 1 + leads).cast("int")), -1)
    first = F.substring(text, F.lit(1), F.char_length(text) - F.char_length(after))
    chosen = rows.join(takes, "_row").withColumn("_words", cut)
    shown = F.when(F.col("_words") > 0, F.rtrim(first)).otherwise(text)
    return chosen.select(*[shown.alias(text_column) if name == text_column else F.col(name) for name in docs.columns])


def result(docs: DataFrame) -> DataFrame:
    return mix(docs)


def oracle() -> str:
    """The mix in DuckDB's SQL, with the same parameters."""
    weights = ", ".join(map(str, WEIGHTS))

    def seats(name: str, source: str) -> str:
        # source has g, p, s, n; the result has g, p, quota
        return f"""
        {name}_sums as (select g, sum(s) as everything, count(*) as parties from {source} where s > 0 group by g),
        {name}_rounded as (select x.g, p, s, n, everything, parties, cast(floor(s * n / everything + 0.5) as bigint) as r
            from {source} x join {name}_sums y on x.g = y.g where s > 0),
        {name}_missing as (select g, first(n) - sum(r) as missing from {name}_rounded group by g),
        {name}_contested as (
            select x.g, p, s, missing, unnest(case
                when missing > 0 then range(r + 1, r + reach + 1)
                when missing < 0 and r > 0 then range(greatest(1, r - reach + 1), r + 1) else [] end) as seat
            from (select *, cast(ceil(s / everything * parties / 2) + 1 as bigint) as reach from {name}_rounded) x
            join {name}_missing y on x.g = y.g),
        {name}_ranked as (
            select *, row_number() over (partition by g order by -sign(missing) * s / (2 * seat - 1), sign(missing) * p, seat)
            as place from {name}_contested),
        {name} as (
            select x.g, x.p, r + coalesce(change, 0) as quota from {name}_rounded x left join (
                select g, p, sum(sign(missing)) as change from {name}_ranked where place <= abs(missing) group by g, p
            ) y on x.g = y.g and x.p = y.p)"""

    return rf"""
    with sizes as (
        select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as size,
            md5(concat('{SEED}:', coalesce(cast(doc_id as varchar), ''))) as place from documents),
    sources as (
        select source, row_number() over (order by source nulls last) as number, sum(size)::bigint as size,
            count(*) as documents from sizes group by source),
    weighed as (select *, list_extract([{weights}], ((number - 1) % {len(WEIGHTS)} + 1)::int)::bigint as weight from sources),
    fills as (
        select *, (sum(size) over () - coalesce(sum({REPEATS} * size) over before, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
        from weighed window before as (order by size::double / weight, number rows between unbounded preceding and 1 preceding)),
    water as (
        select coalesce(max(level), 0.0) as level from fills),  -- it rises while sources stop, then falls
    targets as (
        select source, number, size as source_size, least(({REPEATS} * size)::double, level * weight) as target,
            greatest(1, ceil(documents / {SHARD_DOCUMENTS}))::bigint as shards,
            (select sum(size) from sources)::bigint // {BLOCK} as blocks from weighed, water),
    parties as (select 0 as g, number as p, target as s, blocks as n from targets),
    {seats("quotas", "parties")},
    numbered as (
        select doc_id, size, place, number, source_size, target, coalesce(quota, 0) as source_quota,
            ('0x' || place[1:8])::bigint % shards as shard
        from sizes x join targets t on x.source is not distinct from t.source left join quotas q on q.p = t.number),
    cells as (select number, shard, sum(size)::bigint as cell, first(source_quota) as n from numbered group by number, shard),
    holders as (select number as g, shard as p, cell::double as s, n from cells),
    {seats("shares", "holders")},
    laid as (
        select x.*, cell, least(coalesce(quota, 0) * {BLOCK}, cell * {REPEATS}) as wanted, coalesce(sum(size) over (
            partition by x.number, x.shard order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0)
            as start
        from numbered x join cells c on x.number = c.number and x.shard = c.shard
        left join shares s on s.g = x.number and s.p = x.shard)
    select doc_id, size, source_size, target, (case when cell = 0 then 0 else wanted // cell * size
        + greatest(0, least(start + size, wanted % cell) - start) end)::bigint as taken from laid"""
