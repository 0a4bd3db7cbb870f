"""Cleaning operators: text, numbers, dates, renames, duplicates, grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions import labels, numbers, periods, text
from coverlens.operators import dedupe, shape
from coverlens.operators.grain import blank_counts, sum_to_grain
from coverlens.plans import loading
from proofs import roles, sql
from proofs.registry import proof
from proofs.roles import table

GRAIN = ", ".join(layouts.ENROLMENT_FACT_GRAIN)
SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in layouts.MEASURES)


@proof("grain_sum", f"WITH {sql.ENROL} SELECT {GRAIN}, {SUMS} FROM enrol GROUP BY {GRAIN}")
def grain_sum(spark, sf_dir):
    return sum_to_grain(roles.enrolment(spark, sf_dir), layouts.ENROLMENT_FACT_GRAIN, layouts.MEASURES)


@proof(
    "regrain_after_sentinel",
    f"""WITH {sql.ENROL}, keyed AS (
  SELECT enrol.* REPLACE (CASE WHEN s_acctbal >= 0 THEN carrier_sk ELSE -1 END AS carrier_sk,
                          CASE WHEN r_name <> 'ASIA' THEN locality_sk ELSE -1 END AS locality_sk)
  FROM enrol JOIN supplier ON carrier_sk = s_suppkey JOIN nation ON locality_sk // 5 = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
SELECT {GRAIN}, {SUMS} FROM keyed GROUP BY {GRAIN}""",
)
def regrain_after_sentinel(spark, sf_dir):
    """Carriers in debt are not registered and Asian localities unknown: both fall on -1."""
    batch = roles.enrolment(spark, sf_dir).withColumns(
        {
            "carrier_code": F.col("carrier_sk").cast("string"),
            "locality_code": F.col("locality_sk").cast("string"),
            "state": F.col("locality_sk").cast("string"),
        }
    )
    natural = ["period_key", "carrier_code", "locality_code", "state", "sex", "age_band", "tie_type", "segment"]
    batch = sum_to_grain(batch, natural, layouts.MEASURES)
    registered = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("carrier_sk"),
        F.col("s_suppkey").cast("string").alias("carrier_code"),
        F.lit(True).alias("is_current"),
    )
    known = roles.places(spark, sf_dir).where("region <> 'ASIA'").withColumn("state", F.col("locality_code"))
    return loading.resolve_enrolment(batch, registered, known)


@proof(
    "exact_dedupe",
    "SELECT lang, source, n_chars, sha256(text) AS text_hash FROM "
    "(SELECT DISTINCT text, lang, source, n_chars FROM documents)",
)
def exact_dedupe(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    return dedupe.drop_exact_duplicates(rows).select(
        "lang", "source", "n_chars", text.content_hash("text").alias("text_hash")
    )


@proof(
    "exact_duplicate_counts",
    "SELECT count(*) AS rows_read, count(DISTINCT text) AS distinct_rows, "
    "count(*) - count(DISTINCT text) AS exact_duplicates FROM documents",
)
def exact_duplicate_counts(spark, sf_dir):
    return dedupe.exact_duplicate_counts(table(spark, sf_dir, "documents").select("text"))


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@proof(
    "keyed_dedupe_first",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem "
    f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) = 1",
)
def keyed_dedupe_first(spark, sf_dir):
    first = dedupe.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@proof(
    "keyed_dedupe_counted",
    "SELECT p_name, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand, "
    "count(*) AS copies FROM part GROUP BY p_name",
)
def keyed_dedupe_counted(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand")
    return dedupe.keep_first_counted(rows, ["p_name"], ["p_partkey"], "copies")


@proof(
    "repeats_removed",
    "SELECT count(*) AS rows_read, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_kept, "
    "count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS repeats_removed FROM lineitem",
)
def repeats_removed(spark, sf_dir):
    return dedupe.repeats_removed(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@proof("strip_text", f"SELECT doc_id, sha256({sql.stripped('text')}) AS text_hash FROM documents")
def strip_text(spark, sf_dir):
    rows = shape.strip_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])
    return rows.select("doc_id", text.content_hash("text").alias("text_hash"))


@proof(
    "trim_upper_domain",
    """SELECT c_custkey, c_mktsegment AS segment,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'XX' END AS domain_code,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS domain_or_null,
  CASE WHEN c_acctbal >= 0 THEN c_name END AS name_or_null FROM customer""",
)
def trim_upper_domain(spark, sf_dir):
    """The columns are made untidy first: padding, lower case, blanks in place of names."""
    untidy = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("\xa0\t"), F.lower("c_mktsegment"), F.lit(" 　\n")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), "c_name")).otherwise(F.lit(" \t ")).alias("name"),
    )
    allowed = ("BUILDING", "MACHINERY")
    return untidy.select(
        "c_custkey",
        text.strip_upper("segment").alias("segment"),
        text.to_domain(text.strip_upper("segment"), allowed, layouts.UNKNOWN_STATE).alias("domain_code"),
        text.to_domain(text.strip_upper("segment"), allowed, None).alias("domain_or_null"),
        text.blank_to_null(text.strip("name")).alias("name_or_null"),
    )


@proof(
    "safe_number_date",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS number,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem""",
)
def safe_number_date(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") == "N", "unknown").otherwise(F.col("l_extendedprice").cast("string")).alias("n"),
        F.when(F.col("l_returnflag") == "A", "not a date")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("d"),
    )
    return texts.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.safe_long("n").alias("number"),
        numbers.safe_date("d").alias("day"),
    )


@proof(
    "period_attributes",
    f"""SELECT period_key, {sql.period_date()} AS period_date, CAST(period_key // 100 AS INTEGER) AS year,
  CAST(period_key % 100 AS INTEGER) AS month, {sql.month_name()} AS month_name,
  CAST((period_key % 100 + 2) // 3 AS INTEGER) AS quarter,
  CAST(CASE WHEN period_key % 100 <= 6 THEN 1 ELSE 2 END AS INTEGER) AS half, {sql.period_label()} AS period_label,
  CAST(period_key // 100 AS VARCHAR) || '-' || lpad(CAST(period_key % 100 AS VARCHAR), 2, '0') AS period_text
FROM (SELECT DISTINCT {sql.PERIOD} AS period_key FROM orders)""",
)
def period_attributes(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(
        periods.period_of_text(F.date_format("o_orderdate", "yyyy-MM")).alias("period_key")
    )
    return loading.time_members(keys).withColumn("period_text", periods.period_text("period_key"))


@proof(
    "pad_code",
    """WITH c AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS code, CAST(abs(CAST(trunc(c_acctbal) AS BIGINT)) AS VARCHAR) AS digits,
         CAST(trunc(c_acctbal) AS BIGINT) < 0 AS negative FROM customer)
SELECT c_custkey, lpad(code, CAST(greatest(6, length(code)) AS INTEGER), '0') AS padded,
  CASE WHEN negative THEN '-' ELSE '' END ||
  lpad(digits, CAST(greatest(CASE WHEN negative THEN 2 ELSE 3 END, length(digits)) AS INTEGER), '0') AS signed_code
FROM c""",
)
def pad_code(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return rows.select(
        "c_custkey",
        text.pad_code(F.concat(F.lit(" "), F.col("c_custkey").cast("string")), 6).alias("padded"),
        text.pad_code(F.col("c_acctbal").cast("bigint").cast("string"), 3).alias("signed_code"),
    )


CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
THOUSANDS = "replace(format('{{:,}}', {0}), ',', '.')"


@proof(
    "localised_labels",
    f"""SELECT o_orderkey, {THOUSANDS.format("CAST(trunc(o_totalprice) AS BIGINT)")} AS whole,
  {THOUSANDS.format(f"{CENTS} // 100")} || ',' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0') AS amount,
  CASE WHEN o_orderstatus = 'F' THEN '-'
       ELSE {THOUSANDS.format(f"{CENTS} // 100")} || ',' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0') || '%'
  END AS share,
  {sql.month_name(f"({sql.PERIOD})", lower=True)} || '/' || year(o_orderdate) AS month,
  CASE WHEN o_orderstatus = 'F' THEN '-' ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M') END AS moment FROM orders""",
)
def localised_labels(spark, sf_dir):
    finished = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        labels.integer_label("o_totalprice").alias("whole"),
        labels.decimal_label("o_totalprice", 2).alias("amount"),
        labels.percent_label(F.when(~finished, F.col("o_totalprice")), 2).alias("share"),
        labels.month_label(periods.period_of_date("o_orderdate")).alias("month"),
        labels.moment_label(F.when(~finished, F.col("o_orderdate"))).alias("moment"),
    )


@proof(
    "keep_renamed",
    "SELECT s_suppkey AS carrier_sk, s_name AS legal_name FROM supplier",
)
def keep_renamed(spark, sf_dir):
    kept = shape.keep_renamed(
        table(spark, sf_dir, "supplier"), {"s_suppkey": "carrier_sk", "s_name": "legal_name"}
    )
    return shape.assert_absent(kept, ["s_nationkey", "s_acctbal"])


@proof(
    "tolerant_layout",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS state,
  'Tipo ' || o_custkey AS type_label, 'Não informado' AS locality_name FROM orders""",
)
def tolerant_layout(spark, sf_dir):
    """Two source columns feed one target, unknown columns are ignored, absent ones get defaults."""
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("STATE_A"),
        F.col("o_orderpriority").alias("STATE_B"),
    )
    named = shape.rename_known(raw, {"STATE_A": "state", "STATE_B": "state", "ABSENT": "other"}, ["state"])
    full = shape.with_defaults(
        named,
        {
            "type_label": F.concat(F.lit("Tipo "), F.col("o_custkey").cast("string")),
            "locality_name": F.lit(layouts.NOT_INFORMED),
            "state": F.lit(layouts.UNKNOWN_STATE),
        },
    )
    return full.select("o_orderkey", "state", "type_label", "locality_name")


@proof("snake_columns", "SELECT r_regionkey AS region_key, r_name AS nome_da_regiao FROM region")
def snake_columns(spark, sf_dir):
    return shape.snake_columns(table(spark, sf_dir, "region").toDF("RegionKey", " Nome Da_Regiao "))


@proof(
    "stack_by_name",
    """SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::BIGINT AS supplier FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier""",
)
def stack_by_name(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    b = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return shape.stack_by_name([a, b])


@proof(
    "null_tokens",
    """SELECT l_returnflag AS flag, count(*) AS all_rows, count(*) FILTER (l_linestatus <> 'O') AS with_text
FROM lineitem GROUP BY 1""",
)
def null_tokens(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linestatus") == "O", F.when(F.col("l_returnflag") == "N", "N/A").otherwise("NULL"))
        .otherwise("text")
        .alias("value"),
    )
    cleaned = shape.tokens_to_null(texts, ["value"])
    return cleaned.groupBy("flag").agg(F.count(F.lit(1)).alias("all_rows"), F.count("value").alias("with_text"))


@proof(
    "row_json",
    """SELECT c_custkey, to_json({'c_name': c_name, 'c_nationkey': c_nationkey,
  'segment': nullif(c_mktsegment, 'BUILDING')}) AS payload FROM customer""",
)
def row_json(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return rows.select("c_custkey", text.row_json("c_name", "c_nationkey", "segment").alias("payload"))


@proof(
    "folded_groups",
    "SELECT lower(c_mktsegment) AS segment, count(*) AS customers FROM customer GROUP BY 1",
)
def folded_groups(spark, sf_dir):
    """Spellings that differ in case and accents are one group."""
    accented = F.translate("c_mktsegment", "AEIOU", "ÁÊÍÕÚ")
    spelled = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lower(accented))
        .when(F.col("c_acctbal") < 5000, accented)
        .otherwise(F.col("c_mktsegment"))
        .alias("spelling"),
        F.lower("c_mktsegment").alias("segment"),
    )
    groups = spelled.groupBy(text.folded("spelling").alias("key")).agg(
        F.max("segment").alias("segment"), F.count(F.lit(1)).alias("customers")
    )
    return groups.select("segment", "customers")


@proof(
    "expected_files",
    f"""WITH {sql.ENROL} SELECT DISTINCT period_key, 'pda-024-icb-' || n_name || '-' || (period_key // 100) || '_' ||
  lpad(CAST(period_key % 100 AS VARCHAR), 2, '0') || '.zip' AS file
FROM enrol JOIN nation ON locality_sk // 5 = n_nationkey""",
)
def expected_files(spark, sf_dir):
    """Archives that should have landed: one per state and period with members."""
    pairs = roles.enrolment(spark, sf_dir).select("period_key", "locality_sk").distinct()
    named = pairs.join(roles.places(spark, sf_dir), "locality_sk").select("period_key", "state").distinct()
    return named.select("period_key", periods.landing_file_name("state", "period_key").alias("file"))


@proof(
    "blank_counts",
    """SELECT count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS segment_blank,
  count(*) FILTER (c_acctbal < 0) AS name_blank FROM customer""",
)
def blanks(spark, sf_dir):
    segment = F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(
        F.when(segment == "BUILDING", "").when(segment != "MACHINERY", segment).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
    )
    return blank_counts(rows, ["segment", "name"])
