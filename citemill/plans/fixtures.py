"""Legal relations derived from the driver's tables, as SQL that Spark and DuckDB both run.

Every relation is made of all rows of its tables. What must be missing somewhere (a book without a title, a cite that nothing has)
is moved out of reach in the select list, not filtered.

Names in braces are relations, of this module or of the driver. `relation()` builds one in Spark; `with_sql()` puts the ones that
a query needs in front of it, for DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_N = "CASE r WHEN 0 THEN 'Mass' WHEN 1 THEN 'Pick' WHEN 2 THEN 'Wend' WHEN 3 THEN 'Johns' WHEN 4 THEN 'Kelly' WHEN 5 THEN 'Barb' WHEN 6 THEN 'Sandf' ELSE 'Vern' END"

SQL = {
    "base": """SELECT l_orderkey AS ok, l_linenumber AS ln, CAST(l_quantity AS INT) AS q, l_partkey AS pk, l_suppkey AS sk,
        CAST(l_suppkey % 8 AS INT) AS r, CAST(l_partkey % 40 + 1 AS INT) AS pg FROM {lineitem}""",
    "named": f"SELECT *, {_N} AS n FROM {{base}}",
    "pieces": """SELECT ok AS id, ln, CASE ln % 6
        WHEN 0 THEN concat('In 18', lpad(CAST(sk % 100 AS STRING), 2, '0'), ' see ', CAST(q AS STRING), ' ', n, '. ', CAST(pk AS STRING))
        WHEN 1 THEN concat('(', CAST(q AS STRING), '  ', upper(left(n, 1)), '. ', upper(left(n, 1)), '. ', CAST(sk AS STRING), ')')
        WHEN 2 THEN concat(CAST(q AS STRING), ' Ex parte ', n, ', ', CAST(sk AS STRING))
        WHEN 3 THEN concat('é—', CAST(q AS STRING), ' ', left(n, 1), 'é', lower(substr(n, 2, 3)), 'éé., ', CAST(sk AS STRING))
        WHEN 4 THEN concat(CAST(q AS STRING), ' ', left(n, 1), '1', lower(substr(n, 2, 2)), '. ', CAST(sk AS STRING))
        ELSE concat(CAST(q AS STRING), ' . . . ', CAST(sk AS STRING)) END AS p FROM {named}""",
    "reporters": """SELECT * FROM (VALUES
        ('Mass.', 'Massachusetts Reports', 'us:ma', false, CAST(NULL AS STRING)), ('Pick.', 'Pickering', 'us:ma', false, 'Mass.'),
        ('Wend.', 'Wendell', 'us:ny', CAST(NULL AS BOOLEAN), NULL), ('Johns.', 'Johnson', CAST(NULL AS STRING), false, ''),
        ('Kelly', 'Kelly', 'us:ga', true, 'Ga.'), ('Barb.', 'Barbour', 'us:ny', false, NULL),
        ('Sandf.', 'Sandford', 'ukx', false, NULL), ('Vern.', 'Vernon', 'uk:en', false, NULL))
        AS v(reporter_standard, reporter_title, jurisdiction, single_vol, reporter_cap)""",
    "reporters_abbreviations": """SELECT * FROM (VALUES ('Mass.', 'Mass'), ('Mass.', 'M. R.'), ('Wend.', 'Wen'), ('Kelly', 'Geo.'), ('Barb.', 'Barb. S.'), ('Vern.', 'Ver'))
        AS v(reporter_standard, alt_abbr)""",
    "whitelist": """SELECT * FROM (VALUES ('Mass.', 'Mass.', false), ('Mass', 'Mass.', false), ('Pick.', 'Pick.', false), ('Wend.', 'Wend.', false), ('Wen', 'Wend.', false),
        ('Johns.', 'Johns.', false), ('Kelly', 'Kelly', false), ('Barb.', 'Barb.', false), ('Sandf.', 'Sandf.', false), ('Vern.', 'Vern.', false), ('Ver', 'Vern.', false),
        ('. . .', CAST(NULL AS STRING), true), ('W. W.', NULL, true)) AS v(reporter_found, reporter_standard, junk)""",
    "reporters_diffvols": """SELECT DISTINCT 'Pickering' AS reporter_title, CASE WHEN q <= 24 THEN q ELSE q + 100 END AS vol, q + 17 AS cap_vol, 'Mass.' AS cap_reporter, 'Pick.' AS reporter_standard FROM {base}""",
    "citations_unlinked": """SELECT md5(concat_ws('|', moml_treatise, moml_page, CAST(coalesce(volume, -1) AS STRING), reporter_abbr, CAST(page AS STRING))) AS id, moml_treatise, moml_page,
        concat(CASE WHEN volume IS NULL THEN '' ELSE concat(CAST(volume AS STRING), ' ') END, reporter_abbr, ' ', CAST(page AS STRING)) AS raw, volume, reporter_abbr, page
        FROM (SELECT DISTINCT concat('T', CAST(ok % 14999 AS STRING)) AS moml_treatise, lpad(CAST((ok % 50) * 10 AS STRING), 5, '0') AS moml_page,
            CASE WHEN r = 4 AND ln % 2 = 0 THEN NULL WHEN r = 4 THEN q % 3 ELSE q END AS volume,
            CASE WHEN sk % 11 = 0 THEN '. . .' WHEN sk % 13 = 0 THEN 'see' WHEN r = 4 THEN n WHEN r = 2 AND ln % 3 = 0 THEN 'Wen' WHEN r = 0 AND ln % 3 = 0 THEN 'Mass' ELSE concat(n, '.') END AS reporter_abbr,
            pg AS page FROM {named}) AS x""",
    "cap_cases": """SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name, concat('Case ', CAST(p_partkey AS STRING)) AS name_abbreviation, CAST(1800 + p_size * 3 AS INT) AS decision_year,
        CAST(p_partkey % 5 AS BIGINT) AS reporter, CAST(p_partkey % 7 AS BIGINT) AS court, CAST(p_partkey % 6 AS BIGINT) AS jurisdiction,
        CAST(p_partkey % 9 AS STRING) AS volume, concat('https://cases.test/', CAST(p_partkey AS STRING)) AS frontend_url FROM {part}""",
    "parts": "SELECT CAST(max(p_partkey) AS BIGINT) AS np FROM {part}",
    "cap_citations": """SELECT DISTINCT concat(CAST(q AS STRING), ' ', CASE r WHEN 0 THEN 'Mass.' WHEN 1 THEN 'Mass' WHEN 2 THEN 'Wen' WHEN 3 THEN '' WHEN 4 THEN 'Ga.' ELSE 'Barb.' END, ' ', CAST(CASE WHEN ok % 3 = 0 THEN pg + 1000 ELSE pg END AS STRING)) AS cite,
        CASE WHEN ln = 1 THEN 'official' ELSE 'parallel' END AS type, (CAST(q AS BIGINT) * 400 + pg * 10 + r) % np + 1 + CASE WHEN ok % 40 = 1 THEN 1 ELSE 0 END AS case_id FROM {base}, {parts}
        UNION SELECT concat(CAST(q % 3 AS STRING), ' Ga. ', CAST(CASE WHEN ok % 2 = 0 THEN pg ELSE pg + 1000 END AS STRING)), 'official', CAST(pg AS BIGINT) FROM {base}
        UNION SELECT concat('18', CAST(q + 10 AS STRING), '-Ohio-', CAST(pg - 1 AS STRING)), 'vendor', CAST(pg AS BIGINT) FROM {base}
        UNION SELECT concat('1 U.S. 1; ', CAST(q AS STRING), ' Mass. 2'), 'other', CAST(q AS BIGINT) FROM {base}""",
    "freelaw_citations": """SELECT DISTINCT volume, reporter, page, concat(volume, ' ', reporter, ' ', page) AS cite, type, cluster_id FROM (
        SELECT CAST(q AS STRING) AS volume, CASE r % 4 WHEN 0 THEN 'Mass.' WHEN 1 THEN 'Wend.' WHEN 2 THEN 'Barb. S.' ELSE 'Pick.' END AS reporter, CAST(CASE WHEN r < 4 AND ok % 4 = 1 THEN pg ELSE pg + 2000 END AS STRING) AS page,
        CASE WHEN ln = 7 THEN 'lexis' WHEN ln = 6 THEN 'west' ELSE 'state' END AS type, (CAST(q AS BIGINT) * 11 + pg * 53) % np + 1 AS cluster_id FROM {base}, {parts}) AS x""",
    "clusters_to_cap": "SELECT CAST(p_partkey AS BIGINT) AS cluster_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey * 7 % np + 1 AS BIGINT) END AS cap_case_id FROM {part}, {parts}",
    "code_reporter": """SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, concat(CAST(s_suppkey % 50 + 1 AS STRING), ' Wend. ', CAST(s_suppkey % 40 + 1 AS STRING)) AS official_citation,
        CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE concat(CAST(s_suppkey % 45 + 1 AS STRING), ' Barb. ', CAST(s_suppkey % 38 + 1 AS STRING), ' (1850); ', CAST(s_suppkey % 30 + 1 AS STRING), ' M. R. ', CAST(s_suppkey % 40 + 1 AS STRING), ' ; ') END AS parallel_citation,
        CAST(1840 + s_suppkey % 20 AS INT) AS decision_year, concat('Court ', CAST(s_nationkey AS STRING)) AS court_name FROM {supplier}""",
    "english_reports": """SELECT DISTINCT concat('er', CAST(q AS STRING), '-', p) AS id, concat('ER case ', CAST(q AS STRING)) AS er_name, CAST(1700 + q AS INT) AS er_year,
        concat(CAST(q AS STRING), ' Vern. ', p) AS er_cite, CASE WHEN q % 2 = 0 THEN concat(CAST(q AS STRING), ' Sandf. ', p) END AS er_parallel_cite, 'King''s Bench' AS court
        FROM (SELECT q, CAST(CASE WHEN r = 7 AND ok % 3 = 0 THEN pg ELSE pg + 3000 END AS STRING) AS p FROM {base}) AS x""",
    "book_info": """SELECT concat('T', CAST(c_custkey AS STRING)) AS psmid, concat('B', CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING)) AS bibliographicid, CAST(1800 + c_custkey % 97 AS INT) AS year,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('https://books.test/HOST/doc?u=USER&id=', CAST(c_custkey AS STRING)) END AS productlink FROM {customer}""",
    "book_citation": """SELECT concat(CASE WHEN c_custkey % 30 = 29 THEN 'X' ELSE 'T' END, CAST(c_custkey AS STRING)) AS psmid, CASE WHEN c_custkey % 60 = 9 THEN NULL WHEN c_custkey % 60 = 8 THEN 'An oration on law' ELSE concat('A treatise ', c_mktsegment) END AS displaytitle,
        CAST(c_custkey % 3 AS STRING) AS currentvolume, c_name AS author_composed FROM {customer}""",
    "book_subject": """SELECT concat('T', CAST(c_custkey AS STRING)) AS psmid, CASE WHEN c_custkey % 60 = 7 THEN NULL WHEN c_custkey % 60 < 6 THEN 'UK' WHEN c_custkey % 60 = 6 THEN 'Trials' ELSE c_mktsegment END AS subject FROM {customer}
        UNION ALL SELECT concat(CASE WHEN c_custkey % 4 = 0 THEN 'T' ELSE 'X' END, CAST(c_custkey AS STRING)), 'US' FROM {customer}""",
    "page": "SELECT DISTINCT moml_treatise AS psmid, CASE WHEN moml_page = '00490' THEN '00491' ELSE moml_page END AS pageid, CASE WHEN length(moml_treatise) = 2 THEN '' ELSE concat('p', moml_page) END AS sourcepage FROM {citations_unlinked}",
    "page_ocrtext": "SELECT psmid, pageid, CASE WHEN pageid = '00480' THEN NULL ELSE concat('Text of ', psmid, ' & <', pageid, '>') END AS ocrtext FROM {page}",
    "textbooks_works": """SELECT concat('W', CAST(n_nationkey AS STRING)) AS workid, n_name AS work_title,
        CASE WHEN n_nationkey = 3 THEN NULL ELSE split(concat('T', CAST(n_nationkey AS STRING), ',T', CAST(n_nationkey + 25 AS STRING), ',X', CAST(n_nationkey AS STRING)), ',') END AS moml_webids FROM {nation}""",
    "textbooks_vols": """SELECT concat('T', CAST(c_custkey AS STRING)) AS webid, concat('T', CAST(c_custkey AS STRING)) AS psmid, concat('School ', CAST(c_custkey % 37 AS STRING)) AS school, c_mktsegment AS topic,
        concat('W', CAST(c_custkey % 25 AS STRING)) AS workid FROM {customer}""",
    "proposed": "SELECT DISTINCT concat(left(n, 1), CAST(ln % 10 AS STRING), substr(n, 3), '.') AS reporter_abbr, concat(left(n, 1), substr(n, 3), '.') AS stripped, CASE WHEN ok % 2 = 0 THEN concat(n, '.') ELSE 'Mas.' END AS reporter_standard FROM {named}",
    "spelling_counts": "SELECT reporter_abbr, count(*) AS n FROM {citations_unlinked} GROUP BY reporter_abbr",
    "edges": "SELECT o_custkey AS cites_from, l_partkey AS cites_to FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey",
    "metadata": """SELECT c_custkey AS id, concat('Case no. ', CAST(c_custkey AS STRING)) AS cites, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE concat('J', CAST(c_nationkey AS STRING)) END AS jurisdiction_name,
        CAST(c_nationkey AS INT) AS jurisdiction_id, CAST(1800 + c_custkey % 150 AS INT) AS decision_year, concat('Ct. ', CAST(c_custkey % 11 AS STRING)) AS court_name_abbreviation, CAST(c_custkey % 11 AS INT) AS court_id FROM {customer}""",
}
DRIVER = {"lineitem", "orders", "customer", "supplier", "part", "nation", "region"}


def needs(query: str) -> set[str]:
    """The names in braces."""
    return set(re.findall(r"{([a-z_][a-z0-9_]*)}", query))


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in DRIVER:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(SQL[name], **{n: relation(spark, sf_dir, n) for n in needs(SQL[name])})


def with_sql(query: str, more: dict[str, str] | None = None) -> str:
    """A query over {names} for DuckDB; more: further named queries."""
    known, order = SQL | (more or {}), []

    def visit(text: str) -> None:
        for n in re.findall(r"{([a-z_][a-z0-9_]*)}", text):
            if n not in DRIVER and n not in order:
                visit(known[n])
                order.append(n)

    visit(query)
    plain = lambda text: re.sub(r"{([a-z_][a-z0-9_]*)}", lambda m: m[1] if m[1] in DRIVER else f"f_{m[1]}", text)
    return ("WITH " + ",\n".join(f"f_{n} AS MATERIALIZED ({plain(known[n])})" for n in order) + "\n" if order else "") + plain(query)
