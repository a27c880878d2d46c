"""Exact dedup as a stateful stream, with DataFrame functions only.

The documents are read as a file stream. Keyed state in RocksDB, without expiry, holds for each digest of a normalised text the least
(doc_id, content locator) seen and the number of rows. The locator is the file and the row in it. When the stream has taken all there
is, the state is read back, and every hit (a row of a digest that another row holds) is checked: its whole text is compared with the
text of the row that its digest keeps. Rows that differ in spite of equal digests are grouped again by their whole text.

The state is a checkpoint in the shared folder: a lost executor loads it again, and with ``state`` given a later call goes on where
the last one stopped, reading only new files. Hot groups are split: the kept text is copied once for each thousand hits.

Defined cases: a null text is empty; null doc_ids come last; of rows that repeat a doc_id and text one is kept; empty input gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize, new_folder

HITS_PER_COPY = 1000
LAST = 9223372036854775807


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; only runs that are not already one space are touched."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _seen(docs: DataFrame, digest) -> DataFrame:
    body = normalised(F.col("text"))
    sha = F.sha2(body.cast("binary"), 256)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")).alias("locator"),
        body.alias("body"), sha.alias("sha"), digest(sha).alias("digest"),
    )


def _place(sha: str = "sha") -> Column:
    return F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("ord"), F.col("locator"), F.col(sha).alias("sha"))


def _state(spark: SparkSession, path: str, schema, digest, state: str, options: dict) -> DataFrame:
    """Run the stream until it has read all files, and return its state: digest, keeper (ord, locator, sha), n."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each store takes megabytes of disk ahead of need
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a store's memory is given back as soon as its task is done
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # as a pattern the path may name a folder or one file; a plain path to a file is refused by the stream
        stream = spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")
        query = (
            _seen(stream, digest).select("digest", _place().alias("at"))
            .groupBy("digest").agg(F.min("at").alias("keeper"), F.count("*").alias("n"))
            .writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return materialize(
            spark.read.format("statestore").load(state).select("key.digest", F.col("value.min").alias("keeper"), F.col("value.count").alias("n")), "state"
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_files(spark: SparkSession, path: str, digest=lambda sha: sha, state: str | None = None, **options) -> DataFrame:
    """One row per row of the Parquet files at ``path``: doc_id, keep_id, group_size, kept, text_sha256, locator.

    ``digest`` makes the key from the text's SHA-256; a weaker key costs comparisons but changes no result.
    """
    path = path.rstrip("/")
    docs = spark.read.parquet(path)
    held = _state(spark, path, docs.schema, digest, state or new_folder(spark, "dedup-state"), options)
    shared = held.where("n > 1").select("digest", F.col("keeper.locator").alias("keeper"), F.ceil(F.col("n") / HITS_PER_COPY).cast("int").alias("parts"))
    members = materialize(_seen(docs, digest).join(shared, "digest"), "members")
    first = members.where("locator = keeper").select("keeper", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("body").alias("kept_body"))
    hits = members.where("locator <> keeper").withColumn("part", F.pmod(F.xxhash64("locator"), F.col("parts")).cast("int"))
    checked = materialize(
        hits.join(first, ["keeper", "part"]).select("doc_id", "locator", "digest", "sha", F.when(F.col("body") != F.col("kept_body"), F.col("body")).alias("other")),
        "hits",
    )
    other = checked.where("other is not null")
    regrouped = other.groupBy("digest", "other").agg(F.min(_place()).alias("keeper"), F.count("*").alias("n"))
    apart = other.join(regrouped, ["digest", "other"])
    sizes = held.join(other.groupBy("digest").agg(F.count("*").alias("wrong")), "digest", "left").withColumn("n", F.col("n") - F.coalesce("wrong", F.lit(0)))
    same = checked.where("other is null").join(sizes, "digest")
    stay = sizes.select(F.when(F.col("keeper.ord") < LAST, F.col("keeper.ord")).alias("doc_id"), F.col("keeper.locator").alias("locator"), "keeper", "n", F.col("keeper.sha").alias("sha"))
    columns = ["doc_id", "locator", "keeper", "n", "sha"]
    return stay.union(same.select(columns)).union(apart.select(columns)).select(
        "doc_id", F.when(F.col("keeper.ord") < LAST, F.col("keeper.ord")).alias("keep_id"), F.col("n").cast("long").alias("group_size"),
        (F.col("locator") == F.col("keeper.locator")).alias("kept"), F.col("sha").alias("text_sha256"), "locator",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (any columns) that are the first of their text; written once, so that rows have locators."""
    path = new_folder(docs.sparkSession, "dedup-input")
    docs.write.parquet(path)
    spark = docs.sparkSession
    kept = dedup_files(spark, path).where("kept").select(F.col("locator").alias("_locator"))
    there = spark.read.parquet(path)
    located = there.withColumn("_at", F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")))
    return located.join(kept, F.col("_at") == F.col("_locator"), "left_semi").select(*docs.columns)
