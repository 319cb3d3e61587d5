"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

Documents come in batches. A batch counts its lines, one row (line hash, documents) for each. The store holds sorted runs that
share no line: a new batch merge-anti-joins every run, what is left are lines met for the first time, and they become its own run at level 0.
Lines that a run has already are tallied beside the runs. When a level holds ``fanout`` runs they are merged into one run of
the next level; as runs share no line, that is a merge without sums. Runs are bucketed and sorted by the hash, so neither
the anti-joins nor the merges shuffle them: only the batch's own lines move, once.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronosift.llm.common import SPACES, free_names, fresh_path, remove, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "k1 long, k2 long, n_docs long"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case (other letters as they are)."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def key_hash(key: Column) -> tuple[Column, Column]:
    """128 bits of hash, so that two lines meet by chance in no corpus."""
    return F.xxhash64(key), F.xxhash64(F.lit(0x9E3779B9), key)


class LineRuns:
    """Levelled sorted runs of (k1, k2, n_docs) in the shared folder, each a table bucketed by the hash.

    ``add`` takes one batch's counts, a row for each line; ``frequent`` gives the hashes found in ``min_docs`` documents over all batches.
    Counts of a line are summed over batches, so each document must come in one batch only. An empty run store
    has no frequent lines. ``drop`` forgets the runs and their files.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3, buckets: int | None = None) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.tallies: list[str] = []
        self.tables: dict[str, str] = {}

    def _read(self, names: list[str], met: bool = False) -> DataFrame:
        """Rows of the tables: a run's own lines, or those that were met in other runs."""
        parts = [self.spark.table(n).where(F.col("met") == met).drop("met") for n in names]
        return functools.reduce(DataFrame.union, parts)

    def _write(self, counts: DataFrame) -> str:
        path = fresh_path(self.spark, "run")
        name = "lines_" + path[-32:]
        out = counts.sortWithinPartitions("met", "k1", "k2").write.partitionBy("met").bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2")
        out.option("path", path).option("compression", "uncompressed").saveAsTable(name)  # hashes don't compress
        self.tables[name] = path
        return name

    def runs(self) -> list[str]:
        return [name for level in reversed(self.levels) for name in level]

    def add(self, counts: DataFrame) -> None:
        runs = self.runs()
        # dealt as the runs lie, so that only the batch moves; the sum over single rows keeps the joins above the deal
        counts = counts.repartition(self.buckets, "k1", "k2").groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"))
        if runs:
            # run by run, each read as it lies; as runs share no line, a line that was met was met in one
            stored = [self._read([run]).select("k1", "k2").hint("merge") for run in runs]
            new = functools.reduce(lambda left, run: left.join(run, ["k1", "k2"], "left_anti"), stored, counts)
            met = [counts.join(run, ["k1", "k2"], "left_semi").withColumn("met", F.lit(True)) for run in stored]
            counts = functools.reduce(DataFrame.union, met, new.withColumn("met", F.lit(False)))
        else:
            counts = counts.withColumn("met", F.lit(False))
        name = self._write(counts)
        if runs:
            self.tallies.append(name)
        self.levels[0].append(name)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        if level + 1 == len(self.levels):
            self.levels.append([])
        merged = self._read(self.levels[level]).repartition(self.buckets, "k1", "k2").withColumn("met", F.lit(False))
        self.levels[level + 1].append(self._write(merged))
        self.levels[level] = []

    def frequent(self) -> DataFrame:
        if not self.runs():
            return self.spark.createDataFrame([], "k1 long, k2 long")
        first, total = self._read(self.runs()), F.col("n_docs")
        if self.tallies:
            more = self._read(self.tallies, met=True).groupBy("k1", "k2").agg(F.sum("n_docs").alias("more"))
            first = first.join(more.hint("merge"), ["k1", "k2"], "left")
            total = F.col("n_docs") + F.coalesce("more", F.lit(0))
        return first.where(total >= self.min_docs).select("k1", "k2")

    def drop(self) -> None:
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, path)
        self.levels, self.tallies, self.tables = [[]], [], {}


def number_of_batches(n_lines: int, batch_lines: int = 20_000_000, least: int = 6, most: int = 24) -> int:
    """Batches of ``batch_lines`` lines, at least ``least``. Beyond ``most`` batches they grow instead, as each reads all runs before it."""
    return max(least, min(most, -(-n_lines // batch_lines)))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, n_batches: int | None = None, fanout: int = 3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with ``kept_text``, ``n_lines``, ``n_dropped`` (columns of those names are replaced).

    Lines end at \\n; a null or empty text is one empty line. A line whose key is not empty and stands in
    ``min_docs`` rows or more is dropped everywhere; the others stay, joined by \\n. A repeated row counts as a
    document of its own, a line repeated within one row counts once. An empty table gives an empty table.
    A text of any length is handled in time in proportion to its lines.

    The lines (hashes and places, never texts) are written once, by batch; the texts are shuffled once, beside the
    places to drop. A hot line is summed before it is shuffled, and the joins on it are such that
    Spark can split a hot partition. ``n_batches`` follows the number of documents unless it is given.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rk, rk2, dropped, parts = free_names(docs, "_rk", "_rk2", "_drop", "_parts")
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    row_key = [F.xxhash64(F.col(id_col), text).alias(rk), F.xxhash64(text, F.col(id_col)).alias(rk2)]
    n_lines = 10 * docs.count()  # about
    n_batches = n_batches or number_of_batches(n_lines)
    buckets = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_lines // 100_000))
    k1, k2 = key_hash(F.col("key"))
    lines = (
        docs.select(*row_key, F.monotonically_increasing_id().alias("uid"), F.split(text, "\n", -1).alias("parts"))
        .select(F.col(rk).alias("rk"), F.col(rk2).alias("rk2"), "uid", F.posexplode("parts").alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.col("key") != "")
        .select("rk", "rk2", "uid", "pos", k1.alias("k1"), k2.alias("k2"), F.pmod("rk", F.lit(n_batches)).cast("int").alias("batch"))
    )
    path = fresh_path(spark, "lines")
    lines.write.partitionBy("batch").option("compression", "snappy").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, min_docs, fanout, buckets)
    for b in range(n_batches):
        once = lines.where(F.col("batch") == b).select("k1", "k2", "uid").distinct()
        runs.add(once.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs")))
    frequent = written(runs.frequent(), "frequent")
    runs.drop()
    places = lines.select("rk", "rk2", "pos", "k1", "k2").join(frequent, ["k1", "k2"], "left_semi").groupBy("rk", "rk2").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    places = written(places, "places")
    remove(spark, path)
    places = places.toDF(rk, rk2, dropped)
    keyed = docs.select("*", *row_key).join(places.hint("shuffle_hash"), [rk, rk2], "left").withColumn(parts, F.split(text, "\n", -1))
    n = F.size(parts)
    # the stretches of lines between dropped ones, each copied once
    ends = F.concat(F.col(dropped), F.array(n))
    starts = F.concat(F.array(F.lit(0)), F.transform(F.col(dropped), lambda at: at + 1))
    stretches = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    left = F.flatten(F.transform(F.filter(stretches, lambda x: x["n"] > 0), lambda x: F.slice(F.col(parts), x["a"] + 1, x["n"])))
    kept = F.when(F.col(dropped).isNull(), text).otherwise(F.array_join(left, "\n"))
    n_dropped = F.when(F.col(dropped).isNull(), 0).otherwise(F.size(dropped)).cast("long")
    return keyed.withColumns({"kept_text": kept, "n_lines": n.cast("long"), "n_dropped": n_dropped}).drop(rk, rk2, dropped, parts)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_frequent_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT rid, doc_id, line, pos,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos
        FROM (SELECT row_number() OVER () AS rid, doc_id,
                     string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM frequent)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (SELECT key FROM frequent)), '')) AS kept_sha256
FROM lines GROUP BY rid, doc_id
"""
