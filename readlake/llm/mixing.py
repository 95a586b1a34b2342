"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, cut, fresh, spread_join

#: Blocks that a shard has at most, but for one with longer documents; a document looks through its shard's drawn blocks.
SHARD_BLOCKS = 256
#: Shards of a group: quotas go to the groups of a source first, then to the shards of each group.
GROUP_SHARDS = 4096


def seeded(seed: str, *cols: Column) -> Column:
    """A non-negative 60-bit number from MD5 over the seed and the columns."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def sainte_lague(df: DataFrame, group: list[str], key: list[str], votes: str, seats: str, cap: str) -> DataFrame:
    """`df` with `won`: how many of its group's `seats` each row wins by highest quotients votes / (2 k + 1).

    Each row starts from a sure number of seats just below its proportional share. Only the quotients around the share
    compete, a few for each row, ties going to the lower key, and no row wins more than `cap`.
    """
    g = Window.partitionBy(*group)
    df = df.withColumn("_v", F.sum(votes).over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
    share = F.when(F.col("_v") > 0, F.floor(F.col(votes) * F.col(seats) / F.col("_v"))).otherwise(0)
    slack = F.when(F.col("_v") > 0, F.ceil(F.col("_n") * F.col(votes) / (2 * F.col("_v")))).otherwise(0) + 2
    df = df.withColumn("_base", F.least(F.greatest(F.lit(0), share - slack), cap).cast("long"))
    df = df.withColumn("_top", F.least(share + slack + 1, F.col(cap)).cast("long"))
    df = df.withColumn("_left", (F.col(seats) - F.sum("_base").over(g)).cast("long"))
    rivals = df.where(F.col("_top") > F.col("_base")).select(
        *group, *key, "_left", votes, F.explode(F.sequence("_base", F.col("_top") - 1)).alias("_k")
    )
    quotient = F.col(votes) / (2 * F.col("_k") + 1)
    order = g.orderBy(quotient.desc(), *key)
    rivals = rivals.where(quotient > 0).withColumn("_rank", F.row_number().over(order)).where("_rank <= _left")
    wins = rivals.groupBy(*group, *key).agg(F.count(F.lit(1)).alias("_wins"))
    out = df.join(wins, [*group, *key], "left")
    return out.withColumn("won", F.col("_base") + F.coalesce("_wins", F.lit(0))).drop("_v", "_n", "_base", "_top", "_left", "_wins")


def _numbered(rows: DataFrame) -> DataFrame:
    """`rows` with `nth`, from 0 among rows that agree in id, source and size, so that they can be dealt apart.

    Such rows are numbered inside the partitions in which they lie, after those of the partitions before; no task holds
    more of them than a partition does.
    """
    same = ["id", "skey", "size"]
    rows = rows.withColumn("part", F.spark_partition_id())
    if rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long")).drop("part")
    own = rows.groupBy(*same, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).where("base > 0").drop("n")
    own = own.withColumnsRenamed({c: f"of_{c}" for c in (*same, "part")})
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*same, "part").orderBy(F.lit(0))) - 1)
    alike = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*same, "part")]
    j = rows.join(own, alike[0] & alike[1] & alike[2] & alike[3], "left")
    # written, as which of several equal rows has which number is not settled otherwise
    return cut(j.withColumn("nth", F.col("nth") + F.coalesce("base", F.lit(0))).select(*[c for c in rows.columns if c != "part"]))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    block_words: int = 1024,
    shard_words: int = 1 << 18,
    seed: str = "mix-1",
) -> DataFrame:
    """How many words of each document the mix takes: `id_col`, size, source_size, target, taken, source, copies, ranges.

    `weights` repeat over the sources in code point order, null last. The sources share `share` times all words; no
    target exceeds `most` times its source, and the excess is shared again by weight. The budget is cut into blocks of
    equal size (`block_words`, less where sources are small), apportioned by highest quotients to the sources, within a
    source to its groups of shards, and within a group to its shards. A source is dealt to as many shards as its words
    and rows ask for, so a hot source is spread and no task apportions more than GROUP_SHARDS shards; a shard lays its
    documents end to end in seeded order. A source's quota gives whole passes (`copies`) over it and a
    seeded choice of the blocks of one more, whose words are `ranges` (from, to) of a document.

    Null texts have size 0, and so have empty ones: they take nothing. Sources without words have target 0. Rows that
    repeat an id stay apart; a document's shard and place come from its id, its size and its number among rows that agree
    in id, source and size, so rows without an id are dealt out like others. A very long document makes its shard longer. An empty table gives an
    empty result. Extra columns do not matter. One row for each source, and one for each group of a source's shards,
    are put in order by one task.
    """
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("skey"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    rows = _numbered(rows).select("id", "source", "skey", "size", seeded(seed, F.col("id"), F.col("size"), F.col("nth")).alias("h"))
    every = Window.partitionBy(F.lit(1))
    w = F.array(*[F.lit(float(x)) for x in weights])
    src = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    src = src.withColumn("at", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    src = src.withColumn("weight", F.get(w, ((F.col("at") - 1) % len(weights)).cast("int")))
    src = src.withColumn("top", (most * F.col("source_size")).cast("double"))
    src = src.withColumn("budget", share * F.sum("source_size").over(every))
    before = every.orderBy(F.col("top") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    src = src.withColumn("used", F.coalesce(F.sum("top").over(before), F.lit(0.0)))
    src = src.withColumn("rest", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    src = src.withColumn("full", (F.col("budget") - F.col("used")) * F.col("weight") > F.col("top") * F.col("rest"))
    src = src.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("top"))).over(every), F.lit(0.0)))
    src = src.withColumn("rest", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
    src = src.withColumn(
        "target",
        F.when(F.col("full"), F.col("top")).otherwise(F.col("weight") * (F.col("budget") - F.col("used")) / F.col("rest")),
    )
    fine = F.floor(F.col("budget") / (F.count(F.lit(1)).over(every) * 1024))
    src = src.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), fine)).cast("long"))
    src = src.withColumn("seats", F.floor(F.col("budget") / F.col("block") + 0.5).cast("long"))
    src = src.withColumn("cap", (most * F.ceil(F.col("source_size") / F.col("block"))).cast("long")).withColumn("all", F.lit(1))
    src = sainte_lague(src, ["all"], ["at"], "target", "seats", "cap")
    # rows without words take room as well
    room = F.col("source_size") + 16 * F.col("source_rows")
    src = src.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(room / F.least(F.lit(shard_words), SHARD_BLOCKS * F.col("block")))).cast("long"))
    src = cut(src.select("skey", "source_size", "source_rows", "target", "block", F.col("won").alias("quota"), "n_shards"))

    line = spread_join(rows, src, "skey", "source_rows", rows.count()).withColumn("shard", F.col("h") % F.col("n_shards"))
    shards = line.groupBy("skey", "shard", "block", "quota").agg(F.sum("size").alias("shard_size"))
    shards = shards.withColumn("blocks", F.ceil(F.col("shard_size") / F.col("block")).cast("long"))
    shards = cut(shards.withColumn("cluster", F.floor(F.col("shard") / GROUP_SHARDS)))
    groups = shards.groupBy("skey", "cluster", "quota").agg(F.sum("shard_size").alias("group_size"), F.sum("blocks").alias("group_blocks"))
    groups = groups.withColumn("all_blocks", F.sum("group_blocks").over(Window.partitionBy("skey")))
    passes = F.when(F.col("all_blocks") > 0, F.least(F.floor(F.col("quota") / F.col("all_blocks")), F.lit(most))).otherwise(most)
    groups = groups.withColumn("copies", passes.cast("long"))
    over = F.when(F.col("copies") >= most, 0).otherwise(F.col("quota") - F.col("copies") * F.col("all_blocks"))
    groups = sainte_lague(groups.withColumn("over", over.cast("long")), ["skey"], ["cluster"], "group_size", "over", "group_blocks")
    shards = shards.join(groups.select("skey", "cluster", "copies", F.col("won").alias("over")), ["skey", "cluster"])
    shards = cut(sainte_lague(shards, ["skey", "cluster"], ["shard"], "shard_size", "over", "blocks"))

    chance = seeded(seed, F.col("skey"), F.col("shard"), F.col("b"))
    lots = Window.partitionBy("skey", "shard").orderBy(chance, "b")
    drawn = shards.where("won > 0").select("skey", "shard", "won", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    drawn = drawn.withColumn("rank", F.row_number().over(lots)).where("rank <= won")
    drawn = drawn.groupBy("skey", "shard").agg(F.sort_array(F.collect_list("b")).alias("drawn"))
    chosen = shards.select("skey", "shard", "copies").join(drawn, ["skey", "shard"], "left")

    laid = Window.partitionBy("skey", "shard").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = line.withColumn("start", F.coalesce(F.sum("size").over(laid), F.lit(0))).join(chosen, ["skey", "shard"])
    end = F.col("start") + F.col("size")

    def part(b: Column) -> Column:
        lo, hi = F.greatest(b * F.col("block"), F.col("start")), F.least((b + 1) * F.col("block"), end)
        return F.struct((lo - F.col("start")).alias("from"), (hi - F.col("start")).alias("to"))

    touched = F.filter("drawn", lambda b: ((b + 1) * F.col("block") > F.col("start")) & (b * F.col("block") < end))
    ranges = F.transform(F.coalesce(touched, F.array().cast("array<bigint>")), part)
    # a document without words lies inside a block without taking any of it
    ranges = F.filter(ranges, lambda r: r["to"] > r["from"])
    placed = placed.withColumn("ranges", ranges)
    more = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"])
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size") + more).alias("taken"),
        F.col("source").alias("mix_source"),
        "copies",
        "ranges",
    )


def apply_mix(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` as the mix takes them: whole copies and then the taken words of one more, each on lines of its own.

    Documents of which nothing is taken go. `decisions` come from mix() by the same `id_col`, which has to tell the rows
    apart (see with_unique()).
    """
    key, times, some_of = (fresh(docs, x) for x in ("id_taken", "times_taken", "ranges_taken"))
    d = decisions.where("taken > 0").select(F.col(id_col).alias(key), F.col("copies").alias(times), F.col("ranges").alias(some_of))
    j = docs.join(d, F.col(id_col) == F.col(key))
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    some = F.transform(
        F.array(words),
        lambda ws: F.transform(some_of, lambda r: F.array_join(F.slice(ws, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")), " ")),
    )
    some = F.when(F.size(some_of) > 0, some[0]).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(F.array_repeat(F.col(text_col), F.col(times).cast("int")), some), "\n")
    return j.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


#: The same mix for DuckDB, for the parameters of the registered query and sources of one group of shards (up to 10^9 words).
MIX_SQL = r"""
WITH raw AS (
  SELECT doc_id AS id, source, coalesce('s' || source, 'n') AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
r AS (
  SELECT *, ('0x' || substr(md5('mix-1:' || coalesce(id::VARCHAR, 'null') || ':' || size || ':' || nth), 1, 15))::BIGINT AS h
  FROM (SELECT *, row_number() OVER (PARTITION BY id, source, size) - 1 AS nth FROM raw)),
s1 AS (SELECT skey, source, sum(size)::BIGINT AS source_size, count(*) AS source_rows FROM r GROUP BY ALL),
s2 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS pos, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS budget FROM s1),
s3 AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((pos - 1) % 3 + 1)::INT] AS weight, (2 * source_size)::DOUBLE AS top FROM s2),
s4 AS (SELECT *, coalesce(sum(top) OVER b, 0)::DOUBLE AS used0,
              sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS rest0
       FROM s3 WINDOW b AS (ORDER BY top / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, (budget - used0) * weight > top * rest0 AS is_full FROM s4),
s6 AS (SELECT *, coalesce(sum(top) FILTER (is_full) OVER (), 0)::DOUBLE AS used,
              sum(weight) FILTER (NOT is_full) OVER () AS rest, count(*) OVER () AS n FROM s5),
s7 AS (SELECT *, CASE WHEN is_full THEN top ELSE weight * (budget - used) / rest END AS target,
              greatest(1, least(1024, floor(budget / (n * 1024))))::BIGINT AS block FROM s6),
s8 AS (SELECT *, floor(budget / block + 0.5)::BIGINT AS seats, (2 * ceil(source_size / block))::BIGINT AS cap,
              sum(target) OVER () AS v FROM s7),
s9 AS (SELECT *, CASE WHEN v > 0 THEN floor(target * seats / v) ELSE 0 END AS share,
              CASE WHEN v > 0 THEN ceil(n * target / (2 * v)) ELSE 0 END + 2 AS slack FROM s8),
s10 AS (SELECT *, least(greatest(0, share - slack), cap)::BIGINT AS base, least(share + slack + 1, cap)::BIGINT AS hi FROM s9),
s11 AS (SELECT *, seats - sum(base) OVER () AS open FROM s10),
s12 AS (SELECT pos, open, target / (2 * k + 1) AS quotient
        FROM (SELECT pos, open, target, unnest(range(base, hi)) AS k FROM s11) WHERE target / (2 * k + 1) > 0),
s13 AS (SELECT pos, count(*) AS wins
        FROM (SELECT pos, open, row_number() OVER (ORDER BY quotient DESC, pos) AS rk FROM s12) WHERE rk <= open GROUP BY pos),
src AS (SELECT s11.skey, source_size, target, block, base + coalesce(wins, 0) AS quota,
               greatest(1, ceil((source_size + 16 * source_rows) / least(262144, 256 * block)))::BIGINT AS n_shards FROM s11 LEFT JOIN s13 USING (pos)),
line AS (SELECT r.*, source_size, target, block, quota, h % n_shards AS shard FROM r JOIN src USING (skey)),
h1 AS (SELECT skey, shard, block, quota, sum(size)::BIGINT AS shard_size, ceil(sum(size) / block)::BIGINT AS blocks
       FROM line GROUP BY skey, shard, block, quota),
h2 AS (SELECT *, sum(blocks) OVER o AS all_blocks, sum(shard_size) OVER o AS v, count(*) OVER o AS n
       FROM h1 WINDOW o AS (PARTITION BY skey)),
h3 AS (SELECT *, CASE WHEN all_blocks > 0 THEN least(quota // all_blocks, 2) ELSE 2 END AS copies FROM h2),
h4 AS (SELECT *, CASE WHEN copies >= 2 THEN 0 ELSE quota - copies * all_blocks END AS over_ FROM h3),
h5 AS (SELECT *, CASE WHEN v > 0 THEN floor(shard_size * over_ / v) ELSE 0 END AS share,
              CASE WHEN v > 0 THEN ceil(n * shard_size / (2 * v)) ELSE 0 END + 2 AS slack FROM h4),
h6 AS (SELECT *, least(greatest(0, share - slack), blocks)::BIGINT AS base, least(share + slack + 1, blocks)::BIGINT AS hi FROM h5),
h7 AS (SELECT *, over_ - sum(base) OVER (PARTITION BY skey) AS open FROM h6),
h8 AS (SELECT skey, shard, open, shard_size / (2 * k + 1) AS quotient
       FROM (SELECT skey, shard, open, shard_size, unnest(range(base, hi)) AS k FROM h7) WHERE shard_size > 0),
h9 AS (SELECT skey, shard, count(*) AS wins
       FROM (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY quotient DESC, shard) AS rk FROM h8) WHERE rk <= open GROUP BY ALL),
shards AS (SELECT h7.skey, h7.shard, copies, blocks, base + coalesce(wins, 0) AS won
           FROM h7 LEFT JOIN h9 ON h7.skey = h9.skey AND h7.shard = h9.shard),
lots AS (SELECT skey, shard, won, unnest(range(0, blocks)) AS b FROM shards WHERE won > 0),
drawn AS (SELECT skey, shard, b
          FROM (SELECT *, row_number() OVER (PARTITION BY skey, shard ORDER BY
                  ('0x' || substr(md5('mix-1:' || skey || ':' || shard::VARCHAR || ':' || b::VARCHAR), 1, 15))::BIGINT, b) AS rk FROM lots)
          WHERE rk <= won),
placed AS (SELECT *, row_number() OVER () AS row_id, coalesce(sum(size) OVER l, 0)::BIGINT AS start FROM line
           WINDOW l AS (PARTITION BY skey, shard ORDER BY h, id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
part AS (SELECT p.row_id, sum(greatest(0, least((b + 1) * block, start + size) - greatest(b * block, start)))::BIGINT AS more
         FROM placed p JOIN drawn d ON p.skey = d.skey AND p.shard = d.shard
              AND (b + 1) * block > start AND b * block < start + size GROUP BY p.row_id)
SELECT p.id AS doc_id, size, source_size, target, (copies * size + coalesce(more, 0))::BIGINT AS taken
FROM placed p JOIN shards s ON p.skey = s.skey AND p.shard = s.shard LEFT JOIN part USING (row_id)
"""
