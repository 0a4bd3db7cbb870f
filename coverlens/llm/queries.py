"""The operators of this package as queries over the whole given tables, and SQL where it can say the same.

``QUERIES`` maps a name to a function of (spark, folder of tables), ``ORACLE`` to SQL.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.conversation_trie import prefix_trie, turn_rows, with_shared_openings
from coverlens.llm.decontamination import leaks
from coverlens.llm.hnsw import nearest
from coverlens.llm.html_text import extract
from coverlens.llm.language_id import identify
from coverlens.llm.lexical_search import search
from coverlens.llm.line_dedup import dedup_lines
from coverlens.llm.ngram_join import jaccard_components
from coverlens.llm.packing import pack
from coverlens.llm.quality_cotrain import quality_scores
from coverlens.llm.ship import ship
from coverlens.llm.token_files import token_digest
from coverlens.llm.toxicity import toxicity_scores
from coverlens.llm.url_templates import DEPTH, judge, labelled_pages

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)  # fmt: skip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int):
    """The remainder that deals documents into folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, docs.where(fold(4) != 2))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op3_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality_scores(docs, docs.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", F.size("dropped_lines").alias("n_dropped"), "dropped_lines"
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity_scores(docs, docs.where(fold(5) != 0), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(labelled_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")), URL_RULES)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_rows(table(spark, sf_dir, "conversations"))
    return prefix_trie(with_shared_openings(turns), turns.select("conv_id").distinct())


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_language_id, op3_quality_cotraining, op4_line_dedup, op5_html_extraction,
    op6_nearest_neighbours, op7_decontamination, op8_packing, op9_token_files, op10_toxicity,
    op11_url_filters, op12_conversation_trie, op13_lexical_search,
)}  # fmt: skip

def _url_sql() -> str:
    """The template tree in SQL, level by level."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for _, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    verdicts = " ".join(f"WHEN '{h}{p}' THEN '{verdict}'" for verdict, h, p in URL_RULES)
    shape = r"""CASE WHEN regexp_matches(s, '^[0-9a-fA-F-]{8,}\z') AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[a-fA-F]')
        THEN '{hex}' WHEN regexp_matches(s, '^[^-_]+([-_][^-_]+){3,}\z') THEN '{slug}'
        WHEN length(s) >= 24 AND regexp_matches(s, '[0-9]') THEN '{id}' ELSE regexp_replace(s, '[0-9]+', '{n}', 'g') END"""
    levels = []
    for k in range(DEPTH):
        one, two = "(g.bad + 0.5) / (g.labelled + 1.0)", "(b.bad + 0.5) / (b.labelled + 1.0)"
        alike = f"""abs({one} - {two}) <= 2.0 * sqrt(
                {one} * (1.0 - {one}) / (g.labelled + 1.0) + {two} * (1.0 - {two}) / (b.labelled + 1.0))"""
        levels.append(f"""
        branches{k} AS MATERIALIZED (
            SELECT host, template, segments[{k + 1}] AS segment, sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS labelled, sum(bad)::BIGINT AS bad
            FROM tree{k} WHERE len(segments) > {k} GROUP BY ALL),
        shares{k} AS MATERIALIZED (
            SELECT host, template, CASE WHEN n >= 8 AND n * 20 >= node_n THEN segment END AS segment, sum(labelled)::BIGINT AS labelled,
                sum(bad)::BIGINT AS bad
            FROM (SELECT *, sum(n) OVER (PARTITION BY host, template) AS node_n FROM branches{k}) GROUP BY ALL),
        sorted{k} AS MATERIALIZED (
            SELECT *, row_number() OVER (
                PARTITION BY host, template ORDER BY (bad + 0.5) / (labelled + 1.0), segment NULLS FIRST) AS place
            FROM shares{k}),
        walk{k} AS (
            SELECT host, template, segment, place, place AS grp, labelled, bad FROM sorted{k} WHERE place = 1
            UNION ALL
            SELECT b.host, b.template, b.segment, b.place, CASE WHEN {alike} THEN g.grp ELSE b.place END,
                CASE WHEN {alike} THEN g.labelled ELSE 0 END + b.labelled, CASE WHEN {alike} THEN g.bad ELSE 0 END + b.bad
            FROM walk{k} g JOIN sorted{k} b ON b.host = g.host AND b.template = g.template AND b.place = g.place + 1),
        groups{k} AS MATERIALIZED (
            SELECT host, template, grp, CASE WHEN count(*) = 1 THEN any_value(segment)
                ELSE '(' || string_agg(segment, '|' ORDER BY segment) || ')' END AS name
            FROM walk{k} GROUP BY ALL HAVING count(*) = count(segment)),
        kept{k} AS MATERIALIZED (SELECT host, template, segment, name FROM walk{k} JOIN groups{k} USING (host, template, grp)),
        tree{k + 1} AS MATERIALIZED (
            SELECT t.host, t.shape, t.segments, t.n, t.labelled, t.bad, t.template
                || CASE WHEN len(t.segments) <= {k} THEN '' WHEN k.host IS NULL THEN '/*' ELSE '/' || k.name END AS template
            FROM tree{k} t LEFT JOIN kept{k} k
            ON t.host = k.host AND t.template = k.template AND t.segments[{k + 1}] = k.segment)""")
    return f"""
        WITH RECURSIVE marks AS (
            SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
        raw AS (
            SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        cut AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS kept FROM raw),
        parsed AS MATERIALIZED (
            SELECT page_id, host, path, bad, list_transform(kept[1:{DEPTH - 1}], lambda s: {shape}) || CASE
                WHEN len(kept) = {DEPTH} THEN list_transform(kept[{DEPTH}:{DEPTH}], lambda s: {shape})
                WHEN len(kept) > {DEPTH} THEN ['**'] ELSE [] END AS segments
            FROM cut LEFT JOIN marks ON doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') AS BIGINT)),
        tree0 AS MATERIALIZED (
            SELECT host, array_to_string(segments, '/') AS shape, segments, count(*) AS n, count(bad) AS labelled,
                coalesce(sum(bad), 0) AS bad, '' AS template
            FROM parsed GROUP BY host, segments),{",".join(levels)},
        totals AS (SELECT (sum(bad) + 1.0::DOUBLE) / (sum(labelled) + 2.0::DOUBLE) AS rate FROM tree0),
        hosts AS (
            SELECT host, (sum(bad) + 4.0::DOUBLE * any_value(rate)) / (sum(labelled) + 4.0::DOUBLE) AS host_rate
            FROM tree0 JOIN totals ON true GROUP BY host),
        templates AS (
            SELECT host, template, 1.0::DOUBLE - (sum(bad) + 4.0::DOUBLE * any_value(host_rate)) / (sum(labelled) + 4.0::DOUBLE) AS purity
            FROM tree{DEPTH} JOIN hosts USING (host) GROUP BY host, template),
        judged AS (
            SELECT page_id, host, path, CASE {fits} END AS rule, template, purity
            FROM parsed JOIN (SELECT host, segments, template FROM tree{DEPTH}) USING (host, segments) JOIN templates USING (host, template))
        SELECT page_id, host, path, rule,
            coalesce(CASE rule {verdicts} END, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template, purity
        FROM judged"""


#: No SQL: 2, 3 and 10 fit models, 5 reads markup, 6 is approximate, 7 aligns, 8 and 9 tokenise; 1 and 4 compare
#: all texts with all others in SQL, which is too slow on whole tables.  Each is tested against brute force instead.
ORACLE: dict[str, str] = {
    "op11_url_filters": _url_sql(),
    "op12_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS nth
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS MATERIALIZED (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY nth) AS turns, xor(list_reduce(list_prepend(4294967295::BIGINT,
                    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 4 AS h
            FROM turns GROUP BY conv_id),
        rebuilt AS MATERIALIZED (
            SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS turns
            FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
        members AS MATERIALIZED (
            SELECT conv_id, d AS depth, turns[1:d] AS path, len(turns) = d AS ends
            FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
        nodes AS MATERIALIZED (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                FILTER (WHERE ends), '')) AS ends_sha256,
                CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^ 	-]+')) END AS saved
            FROM members GROUP BY path, depth),
        kids AS MATERIALIZED (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        above AS (SELECT path[1:d] AS path, path AS below FROM (SELECT path, unnest(range(0, depth + 1)) AS d FROM nodes)),
        sums AS (
            SELECT a.path, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum(b.saved) AS saved_tokens
            FROM above a JOIN nodes b ON b.path = a.below LEFT JOIN kids k ON k.path = a.below GROUP BY a.path)
        SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children,
            s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
        FROM nodes x JOIN sums s ON s.path = x.path LEFT JOIN kids k ON k.path = x.path
        LEFT JOIN nodes p ON x.depth > 0 AND p.path = x.path[1:x.depth - 1]
    """,
    "op13_lexical_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        items AS (
            SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        totals AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM docs WHERE len(terms) > 0),
        wanted AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
        tf AS (
            SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
            WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        part AS (
            SELECT r, doc_id, term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
                * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS part
            FROM tf JOIN df USING (term) JOIN totals ON true),
        scored AS (SELECT i, item_id, r, doc_id, sum(part * times) AS score FROM part JOIN wanted USING (term) GROUP BY ALL),
        ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score
            FROM scored WHERE score > 0)
        SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
    """,
}
