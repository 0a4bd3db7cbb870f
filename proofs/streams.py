"""Incremental jobs: each file once, and upserts per batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.functions.periods import period_of_date
from coverlens.session import scratch_path
from coverlens.streaming.landing import each_batch, ingest_new_files, landed_stream
from coverlens.sources.storage import write_files
from coverlens.streaming.register import read_register, register_deliveries
from coverlens.streaming.upserts import BatchUpsert
from proofs import sql
from proofs.registry import proof
from proofs.roles import table


@proof("file_stream_once", "SELECT event_id, user_id, event_type, value, props FROM events")
def file_stream_once(spark, sf_dir):
    """The events are ingested, then the job runs again: nothing comes twice."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern, so that one file and a directory of files are taken alike.
    landed = f"{sf_dir.rstrip('/')}/events.parque[t]"
    sink, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        ingest_new_files(landed_stream(spark, landed, schema), sink, checkpoint)
    return spark.read.schema(schema).parquet(sink).select("event_id", "user_id", "event_type", "value", "props")


@proof(
    "stream_upsert",
    f"""SELECT {sql.PERIOD} AS period_key, o_orderpriority AS age_band, CAST(count(*) AS BIGINT) AS active
FROM orders GROUP BY ALL""",
)
def stream_upsert(spark, sf_dir):
    """Orders land in three deliveries; each run merges only the new files into the touched periods."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    orders = table(spark, sf_dir, "orders").select(
        period_of_date("o_orderdate").alias("period_key"),
        F.col("o_orderpriority").alias("age_band"),
        F.lit(1).cast("bigint").alias("active"),
        "o_orderstatus",
    )
    target = BatchUpsert(
        spark, scratch_path(spark, "upserted"), ["period_key", "age_band"], ["active"], accumulate=True, stream="orders"
    )
    delivered = orders.drop("o_orderstatus")
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus").write.mode("append").parquet(landing)
        each_batch(landed_stream(spark, landing, delivered.schema), target, checkpoint)
    return target.result().select("period_key", "age_band", "active")


@proof(
    "delivery_register",
    """WITH d AS (SELECT doc_id, doc_id || ':' || text AS body FROM documents)
SELECT 'a/' || doc_id || '.txt' AS path, sha256(body) AS sha256, 'new' AS status, 'a/' || doc_id || '.txt' AS first_path FROM d WHERE doc_id % 3 = 0
UNION ALL SELECT 'b/' || doc_id || '.txt', sha256(body), 'repeated', 'a/' || doc_id || '.txt' FROM d WHERE doc_id % 6 = 0
UNION ALL SELECT 'a/' || doc_id || '.txt', sha256(body || ' changed'), 'new', 'a/' || doc_id || '.txt' FROM d WHERE doc_id % 9 = 0
UNION ALL SELECT 'b/' || doc_id || '.txt', sha256(body), 'new', 'b/' || doc_id || '.txt' FROM d WHERE doc_id % 3 = 1
UNION ALL SELECT 'c/' || doc_id || '.txt', sha256(body), 'repeated', 'b/' || doc_id || '.txt' FROM d WHERE doc_id % 6 = 1""",
)
def delivery_register(spark, sf_dir):
    """Documents land as files: new ones, copies under other names and changed ones; then a stream with a new checkpoint goes on."""
    landed, register = scratch_path(spark, "landing"), scratch_path(spark, "register")
    docs = table(spark, sf_dir, "documents")
    body = F.concat(F.col("doc_id").cast("string"), F.lit(":"), "text")

    def deliver(folder, kept, content=body):
        name = F.concat(F.lit(f"{folder}/"), F.col("doc_id").cast("string"), F.lit(".txt"))
        write_files(docs.where(kept).select(name.alias("path"), content.alias("content")), landed)

    first, second = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")
    deliver("a", "doc_id % 3 = 0")
    register_deliveries(spark, landed, register, first, "first")
    deliver("b", "doc_id % 6 = 0 or doc_id % 3 = 1")
    deliver("a", "doc_id % 9 = 0", F.concat(body, F.lit(" changed")))
    register_deliveries(spark, landed, register, first, "first")
    deliver("c", "doc_id % 6 = 1")
    register_deliveries(spark, landed, register, second, "second")
    return read_register(spark, register).select("path", "sha256", "status", "first_path")
