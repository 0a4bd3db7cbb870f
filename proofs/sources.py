"""Sources and sinks on data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.operators import quality as q
from coverlens.operators.lookups import without_match
from coverlens.plans import marts
from coverlens.session import materialise, scratch_path
from coverlens.sources import archives, datasets, delimited, manifest, storage
from coverlens.sources.storage import BLOCK, locate
from proofs import roles, sql
from proofs.mart_queries import DATE, STATES
from proofs.quality import RULE_ROWS, UNTIDY, rules, untidy_enrolment
from proofs.registry import proof
from proofs.roles import PERIOD, star, table

LANDED_AT = "2024-03-01 10:20:30"


def documents_as_files(spark, sf_dir):
    """Every document as a landed file with its whole text as content."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("/", F.lit("landing"), "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        F.lit(LANDED_AT).cast("timestamp").alias("modificationTime"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
        "source",
        "lang",
    )


MANIFEST_SQL = f"""SELECT 'landing/' || source || '/' || doc_id || '.txt' AS path, source,
  'manual:' || doc_id || '.txt' AS origin, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes,
  '{LANDED_AT}' AS landed_at, lang AS period FROM documents"""


@proof("manifest", MANIFEST_SQL)
def file_manifest(spark, sf_dir):
    return manifest.file_manifest(documents_as_files(spark, sf_dir), F.col("source"), F.col("lang"))


@proof("new_files", f"{MANIFEST_SQL} WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def new_files(spark, sf_dir):
    """Labelled documents are registered already; the rest is new."""
    files = documents_as_files(spark, sf_dir)
    known = files.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    listed, registered = (manifest.file_manifest(f, F.col("source"), F.col("lang")) for f in (files, known))
    return manifest.not_registered(listed, registered)


@proof(
    "zip_csv",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, sha256(text) AS text_hash, NULL::VARCHAR AS absent "
    "FROM documents",
)
def zip_csv(spark, sf_dir):
    """Whole texts, with their quotes and line breaks, into archives and back; an absent column is null."""
    packed = archives.pack_rows(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    # Unpacked once: rows and failures are both read from the written copy.
    unpacked = archives.unpack_archives(packed, ["doc_id", "text", "lang", "source", "absent"])
    rows = archives.readable_rows(materialise(unpacked, "unpacked"))
    return rows.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_hash"), "absent")


def spoilt():
    """How the content of an archive is spoilt: cut off, emptied, overwritten in the middle."""
    overwritten = F.concat(F.substring("content", 1, 44), F.unhex(F.repeat(F.lit("FF"), 16)), F.substring("content", 61, 1 << 30))
    half = F.substring("content", F.lit(1), (F.octet_length("content") / 2).cast("int"))
    return {"cut": half, "empty": F.lit("").cast("binary"), "overwritten": overwritten}


def write_spoilt(spark, whole, base):
    """The damaged copies that ``spoilt`` makes of rows, of an archive on disk: block by block, so its size does not matter."""

    def copy(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, place = locate(whole)
                size = system.get_file_info(place).size
                left = {"cut": size // 2, "empty": 0, "overwritten": size}[name]
                with system.open_input_stream(place, compression=None) as source, \
                        system.open_output_stream(locate(f"{base}/{name}.zip")[1], compression=None) as out:
                    while block := source.read(min(BLOCK, left)):
                        first = name == "overwritten" and left == size
                        out.write(block[:44] + b"\xff" * 16 + block[60:] if first else block)
                        left -= len(block)
            yield batch

    names = spark.createDataFrame([(n,) for n in spoilt()], "name string")
    names.mapInArrow(copy, "name string").count()


@proof("archive_check", "SELECT doc_id, doc_id % 5 IN (1, 2, 3) AS bad FROM documents")
def archive_check(spark, sf_dir):
    """Every document as an archive on disk: sound, cut off, empty or with overwritten bytes; each is opened and tested in its task."""
    texts = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("text"))

    def pack(batches):
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            packed = []
            for text in batch.column(1):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("rows.csv", text.as_py() or b"")
                packed.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "content"])

    content = F.col("content")
    for remainder, damaged in enumerate(spoilt().values(), 1):
        content = F.when(F.col("doc_id") % 5 == remainder, damaged).otherwise(content)
    name = F.concat(F.lit("d"), F.pmod("doc_id", F.lit(16)).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".zip"))
    base = scratch_path(spark, "archives")
    storage.write_files(texts.mapInArrow(pack, "doc_id long, content binary").select(name.alias("path"), content.alias("content")), base)
    checked = archives.check_landed_archives(spark, base)
    return checked.select(
        F.regexp_extract("path", "([0-9]+)[.]zip$", 1).cast("bigint").alias("doc_id"), F.col("problem").isNotNull().alias("bad")
    )


@proof(
    "archive_source",
    """SELECT 'docs-' || doc_id % 7 || '.zip' AS file, row_number() OVER (PARTITION BY doc_id % 7 ORDER BY doc_id) - 1 AS position,
  CAST(doc_id AS VARCHAR) AS doc_id, lang, sha256(text) AS text_hash, NULL::VARCHAR AS absent, false AS failed FROM documents
UNION ALL SELECT f, NULL, NULL, NULL, NULL, NULL, true FROM (VALUES ('cut.zip'), ('empty.zip'), ('overwritten.zip')) v(f)""",
)
def archive_source(spark, sf_dir):
    """Documents written as seven archives, three damaged copies beside them, and read back with file and position."""
    base = scratch_path(spark, "archives")
    name = F.concat(F.lit("docs-"), (F.col("doc_id") % 7).cast("string"), F.lit(".zip"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", name.alias(archives.FILE))
    archives.write_archives(docs, base, order=["doc_id"])
    write_spoilt(spark, f"{base}/docs-0.zip", base)
    rows = archives.read_archives(spark, base, ["doc_id", "lang", "text", "absent"])
    return rows.select(
        F.element_at(F.split(archives.FILE, "/"), -1).alias("file"),
        F.col(archives.POSITION).alias("position"),
        "doc_id", "lang", F.sha2("text", 256).alias("text_hash"), "absent", F.col(archives.FAILURE).isNotNull().alias("failed"),
    )


@proof("manifest_of_files", MANIFEST_SQL.replace("'landing/' || ", "").replace(f"'{LANDED_AT}' AS landed_at, ", "").replace("lang AS", "'2024-03' AS"))
def manifest_of_files(spark, sf_dir):
    """Every document as a file on disk, listed by tasks and hashed block by block."""
    base = scratch_path(spark, "landing")
    storage.write_files(documents_as_files(spark, sf_dir).select(F.expr("substring(path, 9)").alias("path"), "content"), base)
    listed = manifest.list_landed(spark, base)
    found = manifest.file_manifest(listed, F.element_at(F.split("path", "/"), -2), F.lit("2024-03")).drop("landed_at")
    return found.withColumn("path", F.array_join(F.slice(F.split("path", "/"), -2, 2), "/"))


@proof(
    "dialects",
    """SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_type AS kind, NULL AS text_hash FROM part
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name || ', "' || s_nationkey || ';2|3|4' || chr(34), NULL, NULL FROM supplier
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, lang, sha256(text) FROM documents""",
)
def dialects(spark, sf_dir):
    """Files of three dialects, found by their first blocks: quoted fields hold the other separators, quotes and line breaks."""
    base = scratch_path(spark, "dialects")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    parts = part.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    tricky = F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit(';2|3|4"'))
    suppliers = supplier.select(tricky.alias("name"), F.col("s_suppkey").alias("code"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("code"), "text", F.col("lang").alias("kind"))
    for name, frame, separator in (("parts", parts, ";"), ("suppliers", suppliers, ","), ("documents", documents, "|")):
        delimited.write_delimited(frame, f"{base}/{name}", separator)
    found = delimited.read_detected(spark, base)
    return found.select("code", "name", "kind", F.sha2("text", 256).alias("text_hash"))


@proof(
    "detected_separators",
    """SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_type AS type FROM part
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier""",
)
def detected_separators(spark, sf_dir):
    """Files with another separator and fewer columns, matched by name."""
    base = scratch_path(spark, "delimited")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("code"), F.col("p_name").alias("name"), F.col("p_type").alias("type")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("code"))
    delimited.write_delimited(parts, f"{base}/parts", ";")
    delimited.write_delimited(suppliers, f"{base}/suppliers", ",")
    return delimited.read_detected(spark, f"{base}/*").select("code", "name", "type")


@proof("delimited_text", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS text_hash FROM documents")
def delimited_text(spark, sf_dir):
    """Whole texts through a delimited file: quotes, separators and line breaks survive."""
    path = scratch_path(spark, "texts")
    delimited.write_delimited(table(spark, sf_dir, "documents").select("doc_id", "text"), path, ";")
    back = delimited.read_delimited(spark, path, ";", columns=["doc_id", "text"])
    return back.select("doc_id", F.sha2("text", 256).alias("text_hash"))


@proof(
    "latest_snapshot",
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date FROM orders
WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
)
def latest_snapshot(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("snapshot_date")
    )
    return delimited.latest_snapshot(dated)


@proof(
    "period_overwrite",
    f"""WITH {sql.ENROL} SELECT period_key, sex,
  CAST(sum(CASE WHEN period_key = {PERIOD} THEN 2 * active ELSE active END) AS BIGINT) AS active
FROM enrol GROUP BY ALL""",
)
def period_overwrite(spark, sf_dir):
    """All periods written, then one written again; the others stay."""
    path = scratch_path(spark, "periods")
    sums = roles.enrolment(spark, sf_dir).groupBy("period_key", "sex").agg(F.sum("active").alias("active"))
    datasets.write_period(sums, path)
    datasets.write_period(
        sums.where(F.col("period_key") == PERIOD).withColumn("active", F.col("active") * 2), path
    )
    return datasets.read_dataset(spark, path)


@proof(
    "published_parts",
    f"""WITH {sql.ENROL} SELECT period_key, sex, CAST(sum(active) AS BIGINT) AS active FROM enrol
WHERE period_key <> {PERIOD} GROUP BY ALL
UNION ALL SELECT period_key, 'all', CAST(sum(active) AS BIGINT) FROM enrol WHERE period_key = {PERIOD} GROUP BY 1""",
)
def published_parts(spark, sf_dir):
    """A second load replaces one period; readers see whole loads."""
    store = datasets.PublishedTable(spark, scratch_path(spark, "published"), "period_key")
    sums = roles.enrolment(spark, sf_dir).groupBy("period_key", "sex").agg(F.sum("active").alias("active"))
    periods = [r[0] for r in table(spark, sf_dir, "orders").select(
        roles.period_of_date("o_orderdate")).distinct().collect()]
    store.write(sums, periods)
    again = store.read([PERIOD]).groupBy("period_key").agg(F.lit("all").alias("sex"), F.sum("active").alias("active"))
    store.write(again, [PERIOD])
    return store.read().select("period_key", "sex", "active")


REASONS = " ".join(f"WHEN '{n}' THEN '{d}'" for n, d, _ in RULE_ROWS)


@proof(
    "reject_lines",
    f"""WITH {UNTIDY} SELECT 7::BIGINT AS run_id, 'enrolment' AS dataset, 199801 AS period_key, first_error AS rule,
  CASE first_error {REASONS} END AS reason, l_orderkey, l_partkey, locality_code, active FROM decided
WHERE first_error IS NOT NULL""",
)
def reject_lines(spark, sf_dir):
    """Rejected records to JSON lines and back."""
    rejected = q.rejected_rows(q.evaluate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir)))
    path = scratch_path(spark, "rejects")
    records = datasets.reject_records(rejected, 7, "enrolment", 199801)
    datasets.write_reject_lines(records, path)
    back = spark.read.schema(records.schema).json(path)
    fields = ["l_orderkey", "l_partkey", "locality_code", "active"]
    return back.select("run_id", "dataset", "period_key", "rule", "reason", *[f"record.{f}" for f in fields])


@proof(
    "reject_payload",
    f"""WITH {UNTIDY} SELECT first_error AS rule, l_orderkey, l_partkey, to_json({{'carrier_code': carrier_code,
  'locality_code': locality_code, 'state': state, 'active': active, 'period_key': period_key}}) AS record_json
FROM decided WHERE first_error IS NOT NULL""",
)
def reject_payload(spark, sf_dir):
    """The record as JSON text, nulls written out."""
    rejected = q.rejected_rows(q.evaluate(untidy_enrolment(spark, sf_dir), rules(spark, sf_dir)))
    fields = ["carrier_code", "locality_code", "state", "active", "period_key"]
    thin = rejected.select(
        "rule", "reason", F.struct(*[F.col(f"record.{f}").alias(f) for f in fields]).alias("record"),
        F.col("record.l_orderkey").alias("l_orderkey"), F.col("record.l_partkey").alias("l_partkey"),
    )
    keyed = thin.select("rule", "l_orderkey", "l_partkey",
                        F.to_json("record", {"ignoreNullFields": "false"}).alias("record_json"))
    return keyed


@proof(
    "bound_query",
    f"""WITH {STATES} SELECT state, active_members, {DATE} AS period_date FROM states
WHERE period_key = {PERIOD} AND region = 'ASIA' ORDER BY active_members DESC, state LIMIT 3""",
)
def bound_query(spark, sf_dir):
    """SQL over a mart view with bound parameters and a row cap inside the plan."""
    marts.register_views(star(spark, sf_dir, "enrolment", "locality"), ("by_state",))
    rows, _cut = datasets.query_mart(
        spark,
        "SELECT state, active_members, period_date FROM by_state WHERE period_key = :period AND region = :region "
        "ORDER BY active_members DESC, state",
        {"period": PERIOD, "region": "ASIA"},
        cap=3,
    )
    return rows


@proof(
    "unregistered_files",
    "SELECT doc_id, lang FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)",
)
def unregistered_files(spark, sf_dir):
    listing = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return without_match(listing, table(spark, sf_dir, "labels"), ["doc_id"])
