"""Line dedup over levelled, sorted runs of line hashes.

All lines are hashed once, into a table of (doc_id, hash). Documents are taken in batches from the largest doc_id down, so that the
first batch that has a line holds its keeper. The state is a few runs: tables bucketed and sorted by hash, so that a join with a run
reads it as it lies, without moving it. Each batch's lines are merge-anti-joined with the runs: what no run holds are the new run's
lines, with the batch's largest doc_id as keeper; of the others only the count is set down beside them, in a part of the run that later
batches don't read. A line stands in one run, so runs have no line in common; merging asserts it. Where a level has FAN_IN runs they
are merged into one of the next level, bucket by bucket, and counts meet the line they belong to. The last run knows each line's number
of documents and its keeper. A batch has at most about BATCH_LINES lines; their number grows with the input.

Defined results: a null or empty text is one empty line; rows that share a doc_id are one document; a line that occurs more than
once in a document counts once; rows with a null doc_id don't count and stay as they are; an empty table gives an empty table; other
columns pass through, but `n_lines` and `n_dropped` are replaced.
"""

from __future__ import annotations

import atexit
import uuid

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.llm.common import delete, map_texts, scratch_dir, stage

#: Fixed: what is stripped from both ends of a line before comparing.
BLANKS = " \t\n\x0b\x0c\r"
#: Batches that there are at least, and lines of documents that one has at most, by estimate.
BATCHES, BATCH_LINES = 4, 100_000_000
FAN_IN = 2
KEY = ["hi", "lo"]


def line_key(line: str, least_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key, or None if the key is too short to count."""
    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= least_chars else None


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """docs(doc_id, text) -> doc_id, hi, lo: each long line of a row once."""

    def make(batch: list[str]) -> tuple:
        at, hi, lo = [], [], []
        for i, text in enumerate(batch):
            for key in {line_key(x, least_chars) for x in text.split("\n")} - {None}:
                at.append(i)
                hi.append(int.from_bytes(key[:8], "big", signed=True))
                lo.append(int.from_bytes(key[8:], "big", signed=True))
        return at, [hi, lo]

    return map_texts(docs.select("doc_id", "text"), make, {"hi": "long", "lo": "long"})


def _drop_at_exit(spark: SparkSession, name: str, path: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


class Run:
    """A table in the scratch space, bucketed and sorted by hash: hi, lo, keeper, docs. Rows without a keeper are counts of lines that an
    older run holds, and lie in a part of their own."""

    def __init__(self, rows: DataFrame, level: int):
        self.spark, self.level = rows.sparkSession, level
        self.name = f"line_run_{uuid.uuid4().hex}"
        self.path = f"{scratch_dir(self.spark)}/{self.name}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))  # as joins deal rows out, so that each task writes whole buckets
        parts = rows.withColumn("held", F.col("keeper").isNull()).write.partitionBy("held").bucketBy(buckets, *KEY).sortBy(*KEY)
        parts.option("path", self.path).option("compression", "zstd").saveAsTable(self.name)
        atexit.register(_drop_at_exit, self.spark, self.name, self.path)

    def rows(self) -> DataFrame:
        """Lines and counts."""
        return self.spark.table(self.name).drop("held")

    def lines(self) -> DataFrame:
        """hi, lo of the lines that this run holds."""
        return self.spark.table(self.name).where("not held").select(*KEY)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        delete(self.spark, self.path)


def add_batch(lines: DataFrame, runs: list[Run]) -> Run:
    """lines(hi, lo, keeper, docs) of a batch -> its run: lines that none of the runs holds, and the counts of all others."""
    for i, run in enumerate(runs):
        lines = lines.join(run.lines().withColumn(f"_held_{i}", F.lit(True)).hint("merge"), KEY, "left")
    known = F.coalesce(*(F.col(f"_held_{i}") for i in range(len(runs))), F.lit(False))
    return Run(lines.select(*KEY, F.when(~known, F.col("keeper")).alias("keeper"), "docs"), 0)


def _merge(runs: list[Run]) -> Run:
    """One run of the next level: runs are joined bucket by bucket, and counts are added to the line if one of the runs holds it."""
    rows = runs[0].rows()
    twice = F.raise_error(F.lit("two runs hold the same line")).cast("long")
    for run in runs[1:]:
        more = run.rows().withColumnsRenamed({"keeper": "_keeper", "docs": "_docs"})
        both = F.col("keeper").isNotNull() & F.col("_keeper").isNotNull()
        docs = F.coalesce("docs", F.lit(0)) + F.coalesce("_docs", F.lit(0))
        rows = rows.join(more.hint("merge"), KEY, "full").select(*KEY, F.coalesce("keeper", "_keeper").alias("keeper"), F.when(both, twice).otherwise(docs).alias("docs"))
    made = Run(rows, runs[0].level + 1)
    for run in runs:
        run.drop()
    return made


def build_runs(lines: DataFrame, batches: int | None = None) -> DataFrame:
    """lines(doc_id, hi, lo) -> the compacted run of all documents: hi, lo, keeper (largest doc_id), docs (how many hold the line)."""
    if batches is None:
        batches = max(BATCHES, -(-lines.count() // BATCH_LINES))
    at = ", ".join(str(i / batches) for i in range(1, batches))
    bounds = lines.agg(F.expr(f"percentile_approx(doc_id, array({at}))")).first()[0] or [] if batches > 1 else []
    edges = [None, *sorted(set(bounds)), None]
    runs: list[Run] = []
    for low, high in zip(edges[-2::-1], edges[:0:-1]):
        batch = lines if low is None else lines.where(F.col("doc_id") > low)
        batch = batch if high is None else batch.where(F.col("doc_id") <= high)
        # a document in one batch only; its rows may share lines, and a line that many documents hold is counted in parts first
        runs.append(add_batch(batch.distinct().groupBy(*KEY).agg(F.max("doc_id").alias("keeper"), F.count(F.lit(1)).alias("docs")), runs))
        while len(same := [r for r in runs if r.level == runs[-1].level]) >= FAN_IN:
            runs = [r for r in runs if r.level != same[0].level] + [_merge(same)]
    return (_merge(runs) if len(runs) > 1 else runs[0]).rows()


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int | None = None) -> DataFrame:
    """docs with `text` stripped of lines that at least least_docs documents hold (the largest doc_id keeps its
    lines), n_lines (before) and n_dropped."""
    lines, _ = stage(line_hashes(docs.where(F.col("doc_id").isNotNull()), least_chars), "line-hashes")
    common, _ = stage(build_runs(lines, batches).where(F.col("docs") >= least_docs).select(*KEY, "keeper"), "common-lines")
    key = F.concat(*(F.lpad(F.hex(c), 16, "0") for c in KEY))
    drops = (
        lines.join(common, KEY)
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_set(key).alias("_drop"))
    )

    def make(batch: list[str], dropped: list) -> list:
        kept_texts, n_lines, n_dropped = [], [], []
        for text, drop in zip(batch, dropped):
            lines = kept = text.split("\n")
            if drop:
                keys = {bytes.fromhex(x) for x in drop}
                kept = [x for x in lines if line_key(x, least_chars) not in keys]
            kept_texts.append("\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        return [kept_texts, n_lines, n_dropped]

    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.select(*names).join(drops, "doc_id", "left").withColumn("_text", F.col("text"))
    done = map_texts(joined.drop("text"), make, {"text": "string", "n_lines": "long", "n_dropped": "long"}, "_text", ("_drop",))
    return done.select(*names, "n_lines", "n_dropped")
