"""Landing only what is new: a ledger of the raw files that bronze already holds.

Bronze keeps the rows of each raw file in a folder of their own. The ledger says, for each landed file, its size and
modification time, how many rows it gave, and a hash of them. A run compares the files that are there with the ledger
(anti-joins of two listings), parses those that are new or changed, replaces their folders alone, and deletes the folders of
files that are gone. The ledger is written last: a run that fails before it is simply repeated, since landing a file
twice replaces its folder with the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.measures import rows_where
from souk.operators.staging import scope, stage
from souk.sources import lake, raw_csv
from souk.sources.contracts import CONTRACTS
from souk.sources.raw_csv import FILE_KEY, INGESTED_AT, REJECTED, SOURCE_FILE

FACTS = ("size", "modified")
ENTRY = ("path", FILE_KEY, *FACTS, "row_count", "rejected_rows", "content_hash")


@dataclass(frozen=True)
class Landing:
    """What a run did: files parsed, files whose rows went, and files left alone."""

    parsed: int
    removed: int
    untouched: int


def ledger_path(name: str, bronze_root: str) -> str:
    return raw_csv.table_paths(f"{bronze_root.rstrip('/')}/ledger")[name]


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, size, modified) of each file below ``path``; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        "path", raw_csv.file_key().alias(FILE_KEY), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def changed_keys(spark: SparkSession, name: str, path: str, bronze_root: str) -> list[str]:
    """Keys of the files that the next run would parse or remove."""
    before = lake.read_optional(spark, ledger_path(name, bronze_root))
    now = listing(spark, path)
    if before is None:
        return [r[FILE_KEY] for r in now.select(FILE_KEY).collect()]
    same = ["path", *FACTS]
    fresh = now.join(before.select(*same), same, "left_anti").select(FILE_KEY)
    gone = before.join(now, FILE_KEY, "left_anti").select(FILE_KEY)
    return sorted(r[FILE_KEY] for r in fresh.unionByName(gone).collect())


def _write(df: DataFrame, path: str, whole: bool) -> None:
    """Replace the folders of the files in ``df``, or, if nothing has been landed before, the whole table."""
    mode = "static" if whole else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(FILE_KEY).parquet(path)


def _entries(found: DataFrame, parsed: DataFrame) -> DataFrame:
    """Ledger entries of parsed files. The hash of a file's rows does not depend on their order."""
    content = F.xxhash64(*sorted(c for c in parsed.columns if c not in (SOURCE_FILE, FILE_KEY)))
    facts = parsed.groupBy(FILE_KEY).agg(
        rows_where(F.col(REJECTED).isNull()).alias("row_count"),
        rows_where(F.col(REJECTED).isNotNull()).alias("rejected_rows"),
        F.sum(content.cast("decimal(38,0)")).alias("content_hash"),
    )
    entries = found.join(facts, FILE_KEY, "left")
    zero = F.lit(0).cast("long")
    return entries.withColumns(
        {c: F.coalesce(c, zero) for c in ("row_count", "rejected_rows")} | {"content_hash": F.col("content_hash").cast("string")}
    ).select(*ENTRY)


def land_changed(spark: SparkSession, name: str, path: str, bronze_root: str) -> Landing:
    """Bring one raw table in bronze up to date with the files below ``path``.

    Rows that do not fit their file's header go to the table of rejects, as with ``raw_csv.land``. The result equals
    that of landing all files anew, but for the time of ingestion of files that are left alone.
    """
    target, rejects = raw_csv.table_paths(bronze_root)[name], raw_csv.rejects_path(name, bronze_root)
    book = ledger_path(name, bronze_root)
    before = lake.read_optional(spark, book)
    with scope(spark):
        now = stage(listing(spark, path))
        fresh = now if before is None else now.join(before.select("path", *FACTS), ["path", *FACTS], "left_anti")
        gone = [] if before is None else before.join(now, FILE_KEY, "left_anti").select(FILE_KEY).collect()
        places = [r["path"] for r in fresh.select("path").collect()]
        kept = None if before is None else before.join(fresh.select(FILE_KEY), FILE_KEY, "left_anti").join(
            now.select(FILE_KEY), FILE_KEY, "left_semi"
        )
        if places or before is None:
            parsed = stage(raw_csv.parse(spark, path, CONTRACTS[name].free_text, only=set(places), keyed=True))
            good = parsed.filter(F.col(REJECTED).isNull()).drop(REJECTED)
            _write(good.withColumn(INGESTED_AT, F.current_timestamp()), target, before is None)
            bad = parsed.filter(F.col(REJECTED).isNotNull()).select(SOURCE_FILE, F.col(REJECTED).alias("record"), FILE_KEY)
            _write(bad, rejects, before is None)
            added = stage(_entries(fresh, parsed))
            # A changed file that has no more rows of one sort must not keep its old ones.
            for table, column in ((target, "row_count"), (rejects, "rejected_rows")):
                none = added.filter(F.col(column) == 0).select(FILE_KEY).collect()
                lake.delete(spark, (f"{table}/{FILE_KEY}={r[FILE_KEY]}" for r in none))
            kept = added if kept is None else kept.select(*ENTRY).unionByName(added)
        lake.delete(spark, (f"{table}/{FILE_KEY}={r[FILE_KEY]}" for table in (target, rejects) for r in gone))
        entries = stage(kept.select(*ENTRY))  # the ledger is read by what replaces it
        if places or gone or before is None:
            entries.write.mode("overwrite").parquet(book)
        return Landing(len(places), len(gone), entries.count() - len(places))
