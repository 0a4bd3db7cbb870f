"""The transform jobs on landed files made of the given tables, all exported marts, filter choices, distinct sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions.periods import format_period, parse_period
from coverlens.operators import sketches
from coverlens.plans import marts, reports
from coverlens.plans.jobs import Pipeline
from coverlens.session import materialise, scratch_path
from coverlens.sources import archives, datasets, delimited, storage
from proofs import roles, sql
from proofs.mart_queries import CLASS, RANKED, RATIO, RATIOS, RUN_ROWS, STATES, TREND
from proofs.registry import proof
from proofs.roles import PERIOD, star, table

#: The codes of the nations 0 to 23; the last nation has a code that no state has.
CODES = [*layouts.STATE_CODES[:24], "ZZ"]


def _state(nation):
    return F.element_at(F.array(*[F.lit(c) for c in CODES]), F.col(nation) + 1)


def _transformed(spark, root, source):
    """The stage's rows with its counters beside each."""
    job = Pipeline(spark, root, format_period(PERIOD), "2025-01-05", sources=(source,))
    if not job.run("transform"):
        raise RuntimeError(job.reports[-1].error)
    kept = ("rows_read", "exact_duplicates", "rows_merged", "repeats_removed", "legal_name_missing", "rows_written", "files_ignored")
    counters = {k: F.lit(v).cast("bigint") for k, v in job.reports[-1].counters.items() if k in kept}
    return spark.read.parquet(job.trusted(source)).withColumns(counters)


RAW = f"""raw AS (
  SELECT l_suppkey, c_nationkey, {sql.LOCALITY} AS locality, l_returnflag, o_orderpriority, l_linestatus, c_mktsegment, l_partkey,
    {sql.PERIOD} AS month, CAST(l_quantity AS BIGINT) AS active, CAST(round(l_discount * 100) AS BIGINT) AS joined,
    CAST(l_linenumber AS BIGINT) AS cancelled, unnest(CASE WHEN l_linenumber = 7 THEN [1, 1] ELSE [1] END) AS copy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
kept AS (SELECT DISTINCT * FROM raw)"""
STATE = f"CASE WHEN c_nationkey < 24 THEN {CODES}[c_nationkey + 1] ELSE 'XX' END"


@proof(
    "transform_enrolment",
    f"""WITH {RAW}, summed AS (
  SELECT {PERIOD} AS period_key, CAST(l_suppkey AS VARCHAR) AS carrier_code, CAST(locality AS VARCHAR) AS locality_code,
    'place ' || locality AS locality_name, {STATE} AS state, l_returnflag AS sex, o_orderpriority AS age_band,
    l_linestatus AS tie_type, c_mktsegment AS segment, CAST(sum(active) AS BIGINT) AS active, CAST(sum(joined) AS BIGINT) AS joined,
    CAST(sum(cancelled) AS BIGINT) AS cancelled FROM kept GROUP BY ALL)
SELECT *, (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS exact_duplicates,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM summed) AS rows_merged, (SELECT count(*) FROM summed) AS rows_written,
  1::BIGINT AS files_ignored FROM summed""",
)
def transform_enrolment(spark, sf_dir):
    """All order lines as landed archives, one per state, and a damaged one: duplicates go, the rest is added up at the grain."""
    lines, orders, customers = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    district = F.array_position(F.array(*map(F.lit, sql.SEGMENTS)), F.col("c_mktsegment")) - 1
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    twice = F.when(F.col("l_linenumber") == 7, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = joined.withColumn("place", roles.locality_key("c_nationkey", district)).withColumn("copy", F.explode(twice))
    values = {
        "ID_CMPT_MOVEL": F.date_format("o_orderdate", "yyyy-MM"),
        "CD_OPERADORA": F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(" ")),
        "SG_UF": F.lower(_state("c_nationkey")),
        "CD_MUNICIPIO": F.col("place").cast("string"),
        "NM_MUNICIPIO": F.concat(F.lit("place "), F.col("place").cast("string")),
        "TP_SEXO": F.lower("l_returnflag"),
        "DE_FAIXA_ETARIA": F.col("o_orderpriority"),
        "CD_PLANO": F.col("l_partkey").cast("string"),
        "DE_SEGMENTACAO_PLANO": F.concat(F.col("c_mktsegment"), F.lit("  ")),
        "TIPO_VINCULO": F.col("l_linestatus"),
        "QT_BENEFICIARIO_ATIVO": F.col("l_quantity").cast("bigint").cast("string"),
        "QT_BENEFICIARIO_ADERIDO": F.round(F.col("l_discount") * 100).cast("bigint").cast("string"),
        "QT_BENEFICIARIO_CANCELADO": F.col("l_linenumber").cast("string"),
    }
    file = F.concat(F.lit("pda-024-icb-"), _state("c_nationkey"), F.lit(".zip")).alias(archives.FILE)
    raw = rows.select(*[values.get(c, F.lit("x")).alias(c) for c in layouts.ENROLMENT_COLUMNS], file)
    root = scratch_path(spark, "enrolment-job")
    landing = f"{root}/raw/enrolment/{parse_period(format_period(PERIOD))}"
    archives.write_archives(raw, landing)
    damaged = spark.createDataFrame([("damaged.zip", bytearray(b"PK no archive"))], "path string, content binary")
    storage.write_files(damaged, landing)
    return _transformed(spark, root, "enrolment")


@proof(
    "transform_carriers",
    f"""SELECT CAST(s_suppkey AS VARCHAR) AS carrier_code, 'R' || s_suppkey AS registration_no,
  CASE WHEN s_acctbal >= 500 THEN s_name END AS legal_name, NULL::VARCHAR AS trade_name, CAST(s_nationkey AS VARCHAR) AS kind,
  'city ' || s_nationkey AS seat_locality, CASE WHEN s_nationkey < 24 THEN {CODES}[s_nationkey + 1] END AS seat_state,
  CASE WHEN s_nationkey % 2 = 0 THEN '2020-01-15' END AS registered_on,
  (SELECT count(*) + count(*) FILTER (s_acctbal < 0) FROM supplier) AS rows_read,
  (SELECT count(*) FILTER (s_acctbal < 0) FROM supplier) AS repeats_removed,
  (SELECT count(*) FILTER (s_acctbal < 500) FROM supplier) AS legal_name_missing, (SELECT count(*) FROM supplier) AS rows_written,
  0::BIGINT AS files_ignored FROM supplier""",
)
def transform_carriers(spark, sf_dir):
    """Two dated snapshots of the register as delimited text: the newest counts, repeats go, personal fields never get through."""
    twice = F.when(F.col("s_acctbal") < 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = table(spark, sf_dir, "supplier").withColumn("copy", F.explode(twice))
    nation = F.col("s_nationkey").cast("string")
    register = rows.select(
        F.concat(F.lit("  "), F.col("s_suppkey").cast("string")).alias("REGISTRO_OPERADORA"),
        F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("CNPJ"),
        F.when(F.col("s_acctbal") >= 500, F.concat(F.lit(" "), "s_name", F.lit(" "))).alias("Razao_Social"),
        F.lit("NA").alias("Nome_Fantasia"),
        nation.alias("Modalidade"),
        F.concat(F.lit("street "), F.col("copy").cast("string")).alias("Logradouro"),
        F.concat(F.lit("city "), nation).alias("Cidade"),
        F.lower(_state("s_nationkey")).alias("UF"),
        F.concat(F.lit("phone; "), F.col("copy").cast("string")).alias("Telefone"),
        F.lit("someone").alias("Representante"),
        F.when(F.col("s_nationkey") % 2 == 0, "2020-01-15").otherwise("not a date").alias("Data_Registro_ANS"),
    )
    root = scratch_path(spark, "carriers-job")
    old = register.withColumn("Razao_Social", F.lit("old name"))
    for day, frame in (("2024-12-01", old), ("2025-01-01", register)):
        delimited.write_delimited(frame, f"{root}/raw/carriers/snapshot_date={day}", ";")
    return _transformed(spark, root, "carriers")


@proof(
    "transform_facilities",
    f"""WITH f AS (
  SELECT CAST(p_partkey AS VARCHAR) AS facility_code, p_name AS facility_name, p_brand AS type_code, p_type AS type_label,
    CAST(p_size AS VARCHAR) AS locality_code, 'place ' || p_size AS locality_name, 'SP' AS state FROM part WHERE p_size <= 40
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'copy ' || p_partkey, NULL, NULL, CAST(p_size AS VARCHAR), NULL, 'XX' FROM part WHERE p_size > 40)
SELECT *, {PERIOD} AS period_key, (SELECT count(*) FILTER (p_size <= 40) + count(*) FILTER (p_size > 30) FROM part) AS rows_read,
  (SELECT count(*) FILTER (p_size > 30 AND p_size <= 40) FROM part) AS repeats_removed, (SELECT count(*) FROM part) AS rows_written,
  0::BIGINT AS files_ignored FROM f""",
)
def transform_facilities(spark, sf_dir):
    """Two registers of unlike dialects and columns; a code in both keeps the first file's row."""
    parts = table(spark, sf_dir, "part")
    code = F.col("p_partkey").cast("string").alias("CO_CNES")
    size = F.col("p_size").cast("string")
    whole = parts.where("p_size <= 40").select(
        code, F.col("p_name").alias("NO_FANTASIA"), F.col("p_brand").alias("TP_UNIDADE"), F.col("p_type").alias("DS_TP_UNIDADE"),
        size.alias("CO_MUNICIPIO"), F.concat(F.lit("place "), size).alias("NO_MUNICIPIO"), F.lit("sp").alias("CO_UF"),
    )
    short = parts.where("p_size > 30").select(
        code, F.concat(F.lit("copy "), F.col("p_partkey").cast("string")).alias("NO_FANTASIA"), size.alias("CO_MUNICIPIO"), F.lit("?;?").alias("CO_UF")
    )
    root = scratch_path(spark, "facilities-job")
    landing = f"{root}/raw/facilities/{parse_period(format_period(PERIOD))}"
    delimited.write_delimited(whole, f"{landing}/a", ";")
    delimited.write_delimited(short, f"{landing}/b", ",")
    return _transformed(spark, root, "facilities")


def _exported(name: str, ctes: str, key: str, value: str, source: str, period: str = "CAST(period_key AS VARCHAR)") -> str:
    return (
        f"SELECT * FROM (WITH {ctes} SELECT '{name}' AS mart, {period} AS period, CAST({key} AS VARCHAR) AS key, "
        f"CAST({value} AS VARCHAR) AS value FROM {source})"
    )


#: Per exported mart: what tells its rows of a period apart, and the figure or text that is compared.
SHOWN = {
    "monthly_trend": ("period_label", "active_members"),
    "by_state": ("state", "active_members"),
    "by_locality": ("locality_code", "active_members"),
    "facilities_by_type": ("type_code", "facilities"),
    "members_per_facility": ("locality_code", "facilities"),
    "carrier_ranking": ("carrier_code", "carrier_rank"),
    "coverage_class": ("locality_code", "coverage"),
    "run_history": ("run_id", "status"),
}


@proof(
    "export_marts",
    " UNION ALL ".join(
        (
            _exported("monthly_trend", TREND, sql.period_label(), "active_members", "trend"),
            _exported("by_state", STATES, "state", "active_members", "states"),
            _exported("by_locality", f"{sql.ENROL}, {sql.PLACES}, {sql.MEMBERS}", "locality_code", "active_members", "members"),
            _exported("facilities_by_type", sql.NETWORK, "p_type", "count(*)", "network GROUP BY period_key, p_type"),
            _exported("members_per_facility", RATIOS, "locality_code", "facilities", "ratios"),
            _exported("carrier_ranking", RANKED, "carrier_code", "carrier_rank", "ranking"),
            _exported("coverage_class", RATIOS, "locality_code", CLASS, "ratios"),
            _exported("run_history", RUN_ROWS, "run_id", "status", "history", "period"),
        )
    ),
)
def export_marts(spark, sf_dir):
    """All eight exported marts as files of a period, each read back on its own."""
    whole = star(spark, sf_dir, "enrolment", "network", "locality", "carrier", "facility_type", "runs")
    build = {name: marts.MARTS[name] for name in marts.EXPORTED}
    build["coverage_class"] = lambda parts: marts.coverage_class(parts, roles.ATTENTION, roles.CRITICAL)
    stars = marts.exported_stars(whole)
    written = datasets.export_marts({name: make(stars[name]) for name, make in build.items()}, scratch_path(spark, "exports"), PERIOD)
    stacked = None
    for path in written:
        name = path.rsplit("=", 1)[1]
        rows = spark.read.parquet(path)
        period = "period" if name == "run_history" else "period_key"
        key, value = SHOWN[name]
        shown = rows.select(
            F.lit(name).alias("mart"), F.col(period).cast("string").alias("period"), F.col(key).cast("string").alias("key"),
            F.col(value).cast("string").alias("value"),
        )
        stacked = shown if stacked is None else stacked.unionByName(shown)
    return stacked


@proof(
    "filter_choices",
    f"""WITH {sql.ENROL}, {sql.PLACES}, {sql.MEMBERS}
SELECT DISTINCT 'state' AS "column", state AS value FROM members UNION SELECT 'state_name', state_name FROM members
UNION SELECT 'region', region FROM members""",
)
def filter_choices(spark, sf_dir):
    """What the exploration page offers to choose from: text columns with 2 to 60 values, so localities are left out."""
    return reports.filter_choice_rows(marts.by_locality(star(spark, sf_dir, "enrolment", "locality")), most=60)


@proof(
    "distinct_sketches",
    f"""WITH {sql.ENROL}, k AS (SELECT period_key // 100 AS year, l_partkey AS plan, o_custkey AS member
  FROM (SELECT {sql.PERIOD} AS period_key, * FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
SELECT CAST(year AS VARCHAR) AS span, count(DISTINCT plan) AS plans, count(DISTINCT member) AS members, true AS plans_close, true AS members_close
FROM k GROUP BY 1 UNION ALL SELECT 'all', count(DISTINCT plan), count(DISTINCT member), true, true FROM k""",
)
def distinct_sketches(spark, sf_dir):
    """Sketches are kept per month and merged for years and for all; they are within 2 % of the exact counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("members"), roles.period_of_date("o_orderdate").alias("period_key"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("plans"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("period_key", "plans", "members")
    columns = ["plans", "members"]
    months = materialise(sketches.distinct_sketches(rows, ["period_key"], columns), "sketches")
    year = F.floor(F.col("period_key") / 100).cast("string").alias("span")
    yearly = sketches.merged_distincts(months.select(year, *columns), ["span"], columns)
    merged = yearly.unionByName(sketches.merged_distincts(months, [], columns).withColumn("span", F.lit("all")))
    spans = rows.select(F.explode(F.array(year, F.lit("all"))).alias("span"), *columns)
    exact = spans.groupBy("span").agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in columns])
    found = merged.join(exact, "span")
    return found.select(
        "span",
        *[F.col(f"exact_{c}").alias(c) for c in columns],
        *[(F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.02 * F.col(f"exact_{c}")).alias(f"{c}_close") for c in columns],
    )
