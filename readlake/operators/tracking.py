"""Run and file tracking: status logs, identifiers, upserts and the dashboard's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_status(log: DataFrame) -> DataFrame:
    """The last status of each run: (rid, status, stamp); of equal stamps the greatest event."""
    last = F.struct("stamp", "event_id")
    return log.groupBy("rid").agg(F.max_by("status", last).alias("status"), F.max("stamp").alias("stamp"))


def previous_status(log: DataFrame) -> DataFrame:
    """The status before the last of each run: (rid, status)."""
    w = Window.partitionBy("rid").orderBy(F.col("stamp").desc(), F.col("event_id").desc())
    return log.withColumn("_r", F.row_number().over(w)).where("_r = 2").select("rid", "status")


def runs_to_process(log: DataFrame, retry: tuple[str, ...], failed: str = "_FAILED") -> DataFrame:
    """Runs whose last status asks for work: (rid, status, failed_step), the step being the entry before a failure."""
    return latest_status(log).where(F.col("status").isin(*retry) | F.col("status").endswith(failed)).join(
        previous_status(log).withColumnRenamed("status", "failed_step"), "rid", "left"
    ).select("rid", "status", F.when(F.col("status").endswith(failed), F.col("failed_step")).alias("failed_step"))


def run_log(log: DataFrame, files: DataFrame) -> DataFrame:
    """Statuses and files of each run in order: (rid, nth, kind, what, at)."""
    a = log.select("rid", F.lit("status").alias("kind"), F.col("status").alias("what"), F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("event_id").alias("_o"))
    b = files.select("rid", F.lit("file").alias("kind"), F.col("fid").cast("string").alias("what"), F.lit(None).cast("string").alias("at"), F.col("fid").alias("_o"))
    w = Window.partitionBy("rid").orderBy(F.col("at").asc_nulls_last(), "kind", "_o")
    return a.unionByName(b).withColumn("nth", F.row_number().over(w)).drop("_o")


def stamp_to_timestamp(stamp: Column) -> Column:
    """Timestamps kept as hundred-thousandths of a second."""
    return F.timestamp_micros(stamp * 10)


def upsert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """`table` in which `rows` replace what has the same keys, nulls among them. Keys are unique in each of the two."""
    new = rows.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = [table[k].eqNullSafe(new[f"_new_{k}"]) for k in keys]
    return table.join(new, same, "left_anti").unionByName(rows.select(*table.columns))


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the last in order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def get_or_create_id(table: DataFrame, names: DataFrame) -> DataFrame:
    """`table` (id, name) with new ids after the greatest for names that it lacks, in their order.

    New names are ranked by range: each partition counts its own, and the few counts say where it starts.
    """
    new = names.select("name").where("name is not null").distinct().join(table, "name", "left_anti")
    from .ranking import global_rank

    top = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    # one row, the greatest id
    made = global_rank(new, ["name"]).crossJoin(top).select((F.col("_top") + F.col("rank")).cast("long").alias("id"), "name")
    return table.select(F.col("id").cast("long").alias("id"), "name").unionByName(made)


def partial_update(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """`table` in which values of `changes` that are neither null nor zero replace the old ones."""
    cols = [c for c in changes.columns if c != key]
    new = changes.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in cols])
    j = table.join(new, key, "left")
    return j.select(*[F.coalesce(F.when(F.col(f"_{c}") != 0, F.col(f"_{c}")), F.col(c)).alias(c) if c in cols else F.col(c) for c in table.columns])


def files_of(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Files of each run as a sorted list, runs without any dropped: (rid, name, files)."""
    return runs.join(files, "rid").groupBy("rid", "name").agg(F.sort_array(F.collect_list("fid")).alias("files"))


def files_by_sample(runs: DataFrame, files: DataFrame, samples: DataFrame) -> DataFrame:
    """File names of each sample of each run as a sorted list: (rid, sample, files). `samples` has (sid, sample)."""
    j = files.join(runs.select("rid"), "rid").join(samples.select("sid", "sample"), "sid")
    return j.groupBy("rid", "sample").agg(F.sort_array(F.collect_list("name")).alias("files"))


def files_with_runs(files: DataFrame, runs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Files with all columns of their run, and with `samples` (sid, project) their project: rows to look samples and projects up in."""
    j = files.join(runs, "rid")
    return j if samples is None else j.join(samples.select("sid", "project"), "sid")


def lane_sheet(stats: DataFrame, files: DataFrame) -> DataFrame:
    """The file of each lane and barcode.read of a run: (rid, lane, tag, name). `stats` has (fid, lane, read_nr, bcode); an
    empty or missing barcode is called default; of several files the one with the greatest fid stays."""
    code = F.coalesce(F.nullif("bcode", F.lit("")), F.lit("default"))
    tag = F.concat(code, F.lit("."), F.col("read_nr").cast("string"))
    return stats.join(files.select("fid", "rid", "name"), "fid").groupBy("rid", "lane", tag.alias("tag")).agg(F.max_by("name", "fid").alias("name"))


def samples_per_run(files: DataFrame) -> DataFrame:
    return files.groupBy("rid").agg(F.countDistinct("sid").alias("samples"))


def database_totals(files: DataFrame) -> DataFrame:
    """Runs, samples, files, reads and bases in all, as one row."""
    return files.agg(
        F.countDistinct("rid").alias("runs"), F.countDistinct("sid").alias("samples"), F.count(F.lit(1)).alias("files"),
        F.sum("total_reads").alias("reads"), F.sum(F.col("total_reads") * F.col("read_length")).alias("bases"),
    )


def lane_split(files: DataFrame) -> DataFrame:
    """Each sample's share of its lane's reads: (lane, sid, reads, pct)."""
    s = files.groupBy("lane", "sid").agg(F.sum("total_reads").alias("reads"))
    return s.withColumn("pct", F.try_divide(F.col("reads") * 100, F.sum("reads").over(Window.partitionBy("lane"))))


def short_count(x: Column) -> Column:
    """A whole number as the run pages show it: 1.23K or 12.3K, 123K, 1.2M, 12M; up to 100 and at powers of ten unchanged.

    Halves are rounded up; from 100K and 10M on the rest is cut off.
    """

    def fixed(step: int, digits: int, unit: str) -> Column:
        n, one = F.floor((x + step // 2) / step), 10**digits
        return F.concat(F.floor(n / one).cast("string"), F.lit("."), F.lpad((n % one).cast("string"), digits, "0"), F.lit(unit))

    return (
        F.when((x > 10**7), F.concat(F.floor(x / 10**6).cast("string"), F.lit("M")))
        .when((x > 10**6) & (x < 10**7), fixed(10**5, 1, "M"))
        .when((x > 10**5) & (x < 10**6), F.concat(F.floor(x / 1000).cast("string"), F.lit("K")))
        .when((x > 1000) & (x < 10**5) & (x != 10**4), fixed(100, 1, "K"))
        .when((x > 100) & (x < 1000), fixed(10, 2, "K"))
        .otherwise(x.cast("string"))
    )


def percent(part: Column, whole: Column, none: str) -> Column:
    """`part` of `whole` (whole numbers) as 12.34%, halves rounded up; `none` where either is null or zero."""
    cents = F.floor((part * 20000 + whole) / F.nullif(2 * whole, F.lit(0)))
    text = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"), F.lit("%"))
    return F.when((part != 0) & (whole != 0), text).otherwise(none)


def run_summary(stats: DataFrame, counts: tuple[str, ...] = (), measures: tuple[str, ...] = ()) -> DataFrame:
    """One row of text for each row of `stats` (rid, read_nr, lane, reads, pf, bases, q30, phasing, prephasing, ...).

    Reads that pass are 0% and bases of quality NA where there are none. Each of `counts` and `measures`, a mean with its
    deviation beside it as <name>_sd, is mean±sd, counts in short form; phasing is phasing/prephasing. NA where either of
    the two is null or zero.
    """
    both = lambda a, b: F.coalesce((F.col(a) != 0) & (F.col(b) != 0), F.lit(False))
    pair = lambda a, b, mark, show: F.when(both(a, b), F.concat(show(F.col(a)), F.lit(mark), show(F.col(b)))).otherwise("NA")
    text = lambda c: c.cast("string")
    return stats.select(
        "rid", "read_nr", "lane", short_count(F.col("reads")).alias("reads"), short_count(F.col("pf")).alias("pf"),
        percent(F.col("pf"), F.col("reads"), "0%").alias("pct_pf"), percent(F.col("q30"), F.col("bases"), "NA").alias("pct_q30"),
        pair("phasing", "prephasing", "/", text).alias("phasing"),
        *[pair(c, f"{c}_sd", "±", short_count).alias(c) for c in counts], *[pair(c, f"{c}_sd", "±", text).alias(c) for c in measures],
    )


def dominant_reference(mapping: DataFrame) -> DataFrame:
    """The reference with most unique hits of each file, the first by name on ties: (fid, reference, hits)."""
    m = mapping.groupBy("fid", "reference").agg(F.sum("hits").alias("hits"))
    w = Window.partitionBy("fid").orderBy(F.col("hits").desc(), "reference")
    return m.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def merge_lane_summary(stats: DataFrame, summary: DataFrame) -> DataFrame:
    """`stats` (rid, read_nr, lane, reads) with the columns of `summary` (rid, read_nr, lane, density); a row that only the
    summary has takes the reads of read 1 of its lane."""
    one = stats.where("read_nr = 1").select("rid", "lane", F.col("reads").alias("_reads"))
    j = stats.join(summary, ["rid", "read_nr", "lane"], "full_outer").join(one, ["rid", "lane"], "left")
    return j.select("rid", "read_nr", "lane", F.coalesce("reads", "_reads").alias("reads"), "density")


def qc_facts(facts: DataFrame, fid: str = "fid", x: str = "x") -> DataFrame:
    """A fact table (fid, x, ...) as ordered series, one for each file: (fid, series)."""
    rest = [c for c in facts.columns if c != fid]
    return facts.groupBy(fid).agg(F.sort_array(F.collect_list(F.struct(x, *[c for c in rest if c != x]))).alias("series"))


def dense_histogram(rows: DataFrame, keys: list[str], x: str, n: str, lo: int, hi: int, step: int) -> DataFrame:
    """`rows` with every bin from `lo` to `hi`, missing ones as 0."""
    grid = rows.select(*keys).distinct().withColumn(x, F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"), F.lit(step).cast("long"))))
    return grid.join(rows, [*keys, x], "left").select(*keys, x, F.coalesce(n, F.lit(0)).alias(n))


def newest_file_batch(files: DataFrame, date: str = "date") -> DataFrame:
    """All files that share the newest date; a grouped maximum, then a join, not a sort of everything."""
    top = files.agg(F.max(date).alias(date))
    # one row
    return files.join(F.broadcast(top), date, "left_semi")
