"""Queries that show sources, sinks, cleanups and exports, and their SQL. Their inputs are made from the driver's tables as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import correct_ocr
from ..operators import detect as D
from ..operators import views as V
from ..sources import cleanups, corpora, exports, sinks
from . import registry, scratch
from .fixtures import SQL
from .registry import query

MORE = {
    "adjacency": """SELECT CASE o_custkey % 3 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN concat(CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING))
        ELSE concat(CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING), ',', CAST(o_custkey + 1 AS STRING)) END AS value FROM {orders}""",
    "raw_fields": """SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN '1850' WHEN 1 THEN '1850-1-2' WHEN 2 THEN '' WHEN 3 THEN '1850-02-30' WHEN 4 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS d,
        CASE o_custkey % 6 WHEN 0 THEN ' 12 ' WHEN 1 THEN '+7' WHEN 2 THEN '12x' WHEN 3 THEN '99999999999' WHEN 4 THEN '' ELSE CAST(o_custkey AS STRING) END AS i FROM {orders}""",
    "staged": """SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey % 90 AS STRING) AS volume, CASE WHEN o_custkey % 5 = 0 THEN 'A, "B" R.' WHEN o_custkey % 5 = 1 THEN '' ELSE 'F.2d' END AS reporter, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS page,
        CAST(o_orderkey % 12 AS STRING) AS type, CAST(o_custkey AS STRING) AS cluster_id FROM {orders}""",
    "broken_lines": """SELECT CAST(floor(o_orderkey / 500) AS BIGINT) AS part, CAST(o_orderkey AS BIGINT) AS line_no, CASE o_custkey % 4 WHEN 0 THEN concat('"', CAST(o_orderkey AS STRING), '","2020-01-01 00:00:00",x')
        WHEN 1 THEN concat(CAST(o_orderkey AS STRING), ',2020-01-01 00:00:00 law.free.cap.us.', CAST(o_custkey AS STRING), '.json') WHEN 2 THEN concat('y law.free.cap.us-1.', CAST(o_custkey AS STRING), '.json,z') ELSE 'plain' END AS value FROM {orders}""",
    "records": r"""SELECT rec, arg_min(cluster_id, line_no) AS cluster_id, min(line_no) AS line_no, arg_min(cap, line_no) FILTER (cap IS NOT NULL) AS cap_case_id FROM (SELECT *, sum(CASE WHEN cluster_id IS NULL THEN 0 ELSE 1 END) OVER (ORDER BY part, line_no) AS rec
        FROM (SELECT part, line_no, TRY_CAST(nullif(regexp_extract(value, '^"?(\d+)"?,"?\d{4}-\d{2}-\d{2} \d{2}:\d{2}:', 1), '') AS BIGINT) AS cluster_id, TRY_CAST(nullif(regexp_extract(value, 'law\.free\.cap\.[^",\s]*\.(\d+)\.json', 1), '') AS BIGINT) AS cap FROM {broken_lines}) AS x) AS y WHERE rec > 0 GROUP BY rec HAVING cap_case_id IS NOT NULL""",
    "text_files": "SELECT concat('in/T', CAST(c_custkey AS STRING), '/', CAST(c_custkey * 3 AS STRING), CASE WHEN c_custkey % 9 = 0 THEN '.csv' ELSE '.txt' END) AS path, c_name AS text FROM {customer}",
    "book_rows": """SELECT CASE c_custkey % 4 WHEN 0 THEN 'NULL' WHEN 1 THEN '' ELSE CAST(c_custkey AS STRING) END AS bibliographicid, concat(' ', CAST(1800 + c_custkey % 90 AS STRING)) AS year, concat(c_name, ' ') AS title, '1' AS currentvolume, ' link' AS productlink,
        CAST(c_custkey AS STRING) AS webid, concat(' P', CAST(c_custkey AS STRING)) AS psmid, c_mktsegment AS author FROM {customer}""",
    "rules": "SELECT * FROM (VALUES ('Ma1', 'Mas', 1), ('Mass', 'MASS', 2), (' see ', ' vide ', 3), (CAST(NULL AS STRING), 'x', 4)) AS v(mistake, correction, ord)",
    "requests": "SELECT psmid, pageid FROM (SELECT psmid, CASE WHEN length(psmid) = 3 THEN pageid ELSE 'none' END AS pageid FROM {page}) AS x",
    "saved": "SELECT id, moml_treatise, CASE WHEN page > 20 THEN '99999' ELSE moml_page END AS moml_page, raw, volume, reporter_abbr, page FROM {citations_unlinked}",
    "twice": "SELECT id, moml_treatise, moml_page, raw, volume, reporter_abbr, page FROM {citations_unlinked} UNION ALL SELECT concat('z', id), moml_treatise, moml_page, raw, volume, reporter_abbr, page FROM {citations_unlinked}",
    "old_links": "SELECT citation_id, CASE WHEN status = 'skipped_junk' THEN 'skipped_not_whitelisted' ELSE status END AS status, match_tier, cite_linked FROM {citation_links}",
    "new_alternates": "SELECT DISTINCT concat(n, '.') AS reporter_standard, CASE WHEN ok % 3 = 0 THEN concat(n, '.') WHEN ok % 3 = 1 THEN left(n, 3) ELSE 'M. R.' END AS alt_abbr FROM {named} UNION SELECT 'Nobody', 'N.'",
    "zeroes": "SELECT id, CASE WHEN reporter_abbr = 'Kelly' AND page % 2 = 0 THEN 0 ELSE volume END AS volume, reporter_abbr FROM {citations_unlinked}",
    "one_volume": "SELECT alt_abbr FROM {reporters} JOIN {reporters_abbreviations} USING (reporter_standard) WHERE single_vol UNION SELECT reporter_standard FROM {reporters} WHERE single_vol",
    "bare_diffvols": "SELECT reporter_title, vol, cap_vol, CASE WHEN vol % 2 = 0 THEN 'old' END AS reporter_standard FROM {reporters_diffvols} UNION ALL SELECT 'Unknown', 1, 2, 'kept'",
    "raw_metadata": "SELECT id, cites, CASE id % 4 WHEN 0 THEN '1850' WHEN 1 THEN '1850-01-32' WHEN 2 THEN 'x' ELSE concat(CAST(decision_year AS STRING), '-02-03') END AS decision_date_original, court_name_abbreviation AS court__name_abbreviation FROM {metadata}",
    "raw_reports": """SELECT id AS er_id, CASE WHEN er_year % 3 = 0 THEN '' ELSE er_name END AS er_name, er_year, CASE er_year % 5 WHEN 0 THEN concat('1/2/', CAST(er_year AS STRING)) WHEN 1 THEN concat('3 March ', CAST(er_year AS STRING)) WHEN 2 THEN 'about 1750' WHEN 3 THEN NULL ELSE concat('04-05-', CAST(er_year AS STRING)) END AS er_date,
        er_cite, er_cite AS er_cite_disambiguated, er_parallel_cite, 'm' AS murrell_uid, er_year AS murrell_year, 't' AS murrell_title, 'u' AS er_title, court FROM {english_reports}""",
    "raw_whitelist": """SELECT ok * 100000 + ln * 10000 + pk AS line, concat(' ', n, CASE WHEN ok % 2 = 0 THEN '.' ELSE ' ' END) AS reporter_found, concat(n, '.') AS reporter_standard, CASE WHEN ok % 3 = 0 THEN NULL ELSE ok % 3 = 1 END AS statute, CASE WHEN r > 5 THEN true END AS uk, CAST(NULL AS BOOLEAN) AS junk FROM {named}""",
    "tall": "SELECT reporter_found, concat(reporter_standard, CASE WHEN junk THEN '' ELSE ', \"x\"' END) AS reporter_standard, junk, junk = false AS statute, reporter_found = 'Vern.' AS uk FROM {whitelist}",
}
SQL.update({k: v for k, v in MORE.items() if k not in ("records",)})
registry.DUCK["records"] = MORE["records"]


def _staged_again(df: DataFrame) -> DataFrame:
    """Through a compressed CSV file in the shared folder."""
    path = f"{scratch.ensure_checkpoints(df.sparkSession)}/csv-{id(df)}"
    df.write.mode("overwrite").option("header", True).option("emptyValue", '""').option("escape", '"').option("compression", "bzip2").csv(path)
    return corpora.staging_csv(df.sparkSession, path)


_INT = r"CASE WHEN regexp_full_match(i, '[+-]?[0-9]+') THEN TRY_CAST(i AS INT) END"
_TYPES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in corpora.CITATION_TYPES.items())
_QUOTED = lambda c: f"""CASE WHEN regexp_matches({c}, '[,"\n]') THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END"""

query("S2_edge_list", "adjacency", corpora.edge_list, "SELECT p[1] AS cites_from, unnest(p[2:]) AS cites_to FROM (SELECT string_split(value, ',') AS p FROM {adjacency}) AS x")
query("S4_case_fields", "raw_fields", lambda r: r.select("id", corpora.strict_date(F.col("d")).alias("day"), corpora.strict_int(F.substring("d", 1, 4)).alias("year"), corpora.strict_int(F.col("i")).alias("number")), f"SELECT id, CASE WHEN regexp_full_match(d, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(d AS DATE) END AS day, CASE WHEN regexp_full_match(left(d, 4), '[+-]?[0-9]+') THEN TRY_CAST(left(d, 4) AS INT) END AS year, {_INT} AS number FROM {{raw_fields}}")
query("S5_staging_csv", "staged", _staged_again, "SELECT * FROM {staged}")
query("S6_freelaw_citations", "staged", corpora.freelaw_citations, f"SELECT id::BIGINT AS id, volume, reporter, page, concat_ws(' ', volume, reporter, page) AS cite, CASE type {_TYPES} END AS type, cluster_id::BIGINT AS cluster_id FROM {{staged}} WHERE type BETWEEN '1' AND '9' AND length(type) = 1")
query("S7_cluster_records", "broken_lines", lambda b: corpora.cluster_records(b).select("cluster_id", "cap_case_id"), "SELECT cluster_id, cap_case_id FROM {records}")
query("S8_clusters_to_cap", "broken_lines cap_cases", lambda b, c: corpora.clusters_to_cap(corpora.cluster_records(b), c), "SELECT r.cluster_id, c.id AS cap_case_id FROM {records} r LEFT JOIN {cap_cases} c ON c.id = r.cap_case_id")
query("S9_side_corpus_pages", "text_files", corpora.side_corpus_pages, "SELECT split_part(path, '/', 2) AS psmid, lpad(n::VARCHAR, greatest(5, length(n::VARCHAR))::INT, '0') AS pageid, text AS ocrtext FROM (SELECT *, replace(split_part(path, '/', 3), '.txt', '')::BIGINT * 10 AS n FROM {text_files} WHERE path LIKE '%.txt') AS x")
query("S9_side_corpus_books", "book_rows", lambda b: reduce(lambda x, y: x.join(y, "psmid"), corpora.books(b)), "SELECT trim(psmid) AS psmid, nullif(nullif(bibliographicid, ''), 'NULL') AS bibliographicid, webid, trim(year)::INT AS year, trim(productlink) AS productlink, author AS author_by_line, trim(title) AS title, currentvolume AS current_volume FROM {book_rows}")
query("S11_ocr_rules", "pieces rules", lambda p, r: p.select("id", "ln", correct_ocr(F.col("p"), corpora.ordered_rules(r)).alias("text")), "SELECT id, ln, replace(replace(replace(p, 'Ma1', 'Mas'), 'Mass', 'MASS'), ' see ', ' vide ') AS text FROM {pieces}")
query("S12_page_scan", "page_ocrtext", lambda o: (lambda good, bad: good.select("psmid", "pageid", F.lit(True).alias("read")).unionByName(bad.withColumn("read", F.lit(False))))(*corpora.scanned_pages(o)), "SELECT psmid, pageid, ocrtext IS NOT NULL AS read FROM {page_ocrtext}")
query("S13_unprocessed_pages", "page_ocrtext book_info book_subject requests", lambda o, b, s, r: corpora.unprocessed_pages(o, b, s, r, V.EXCLUDED_SUBJECTS, 500), """SELECT o.* FROM {page_ocrtext} o WHERE EXISTS (SELECT 1 FROM {book_info} b WHERE b.psmid = o.psmid) AND NOT EXISTS (SELECT 1 FROM {book_subject} s WHERE s.psmid = o.psmid AND subject IN ('UK', 'Biography', 'Collected Essays', 'Trials'))
    AND NOT EXISTS (SELECT 1 FROM {requests} r WHERE r.psmid = o.psmid AND r.pageid = o.pageid) ORDER BY psmid, pageid LIMIT 500""")
query("S14_unlinked", "citations_unlinked links_so_far", lambda u, k: u.join(k.select(F.col("citation_id").alias("id")), "id", "left_anti"), "SELECT id, moml_treatise, moml_page, raw, volume, reporter_abbr, page FROM {citations_unlinked} u WHERE NOT EXISTS (SELECT 1 FROM {links_so_far} k WHERE k.citation_id = u.id)")
query("S15_new_citations", "saved twice", sinks.new_citations, "SELECT id, moml_treatise, moml_page, raw, volume, reporter_abbr, page FROM {citations_unlinked} u WHERE NOT EXISTS (SELECT 1 FROM {saved} s WHERE s.moml_treatise = u.moml_treatise AND s.moml_page = u.moml_page AND s.volume IS NOT DISTINCT FROM u.volume AND s.reporter_abbr = u.reporter_abbr AND s.page = u.page)")
query("S16_new_links", "links_so_far citation_links", lambda old, new: sinks.new_links(old, new.withColumn("match_tier", F.coalesce("match_tier", F.lit("")))), "SELECT * FROM {citation_links} WHERE left(citation_id, 1) = '0'")
query("S17_reset", "citation_links", lambda k: sinks.kept_by_reset(k).select("citation_id", "status"), "SELECT citation_id, status FROM {citation_links} WHERE status NOT IN ('no_match', 'skipped_not_whitelisted', 'skipped_junk')")
query("S18_ambiguous_cap_links", "citation_links cap_citations", lambda k, c: cleanups.without_ambiguous_cap_links(k, c).select("citation_id", "status"), "SELECT citation_id, status FROM {citation_links} WHERE NOT (status = 'linked_cap' AND coalesce(cite_linked IN (SELECT cite FROM {cap_citations} GROUP BY cite HAVING count(DISTINCT case_id) > 1), false))")
query("S18_stale_code_links", "citation_links code_reporter", lambda k, c: cleanups.without_stale_code_links(k, c).select("citation_id", "status"), "SELECT citation_id, status FROM {citation_links} k WHERE status <> 'linked_code_reporter' OR EXISTS (SELECT 1 FROM {code_cites} c WHERE c.cite = k.cite_linked)")
query("S18_stale_junk", "old_links citations_unlinked whitelist", cleanups.without_stale_junk, "SELECT k.* FROM {old_links} k JOIN {citations_unlinked} u ON u.id = k.citation_id WHERE NOT (status = 'skipped_not_whitelisted' AND reporter_abbr IN (SELECT reporter_found FROM {whitelist} WHERE junk))")
query("S19_seed", "reporters_abbreviations new_alternates reporters", sinks.seed, "SELECT DISTINCT reporter_standard, alt_abbr FROM {new_alternates} n WHERE reporter_standard <> alt_abbr AND reporter_standard IN (SELECT reporter_standard FROM {reporters}) AND NOT EXISTS (SELECT 1 FROM {reporters_abbreviations} a WHERE a.reporter_standard = n.reporter_standard AND a.alt_abbr = n.alt_abbr)")
query("S20_letterless_junk", "citations_unlinked raw_whitelist", lambda u, w: sinks.letterless_junk(u, w.select("reporter_found")), "SELECT DISTINCT reporter_abbr AS reporter_found, NULL::VARCHAR AS reporter_standard, true AS junk FROM {citations_unlinked} WHERE NOT regexp_matches(reporter_abbr, '[A-Za-z]')")
query("S21_volume_backfill", "zeroes one_volume", cleanups.volumes_backfilled, "SELECT id, CASE WHEN volume = 0 AND reporter_abbr IN (SELECT alt_abbr FROM {one_volume}) THEN NULL ELSE volume END AS volume, reporter_abbr FROM {zeroes}")
query("S22_standards_by_title", "bare_diffvols reporters", cleanups.standards_by_title, "SELECT reporter_title, vol, cap_vol, coalesce(r.reporter_standard, d.reporter_standard) AS reporter_standard FROM {bare_diffvols} d LEFT JOIN (SELECT reporter_title, reporter_standard FROM {reporters}) r USING (reporter_title)")
query("S23_to_jurisdictions", "nation", lambda n: cleanups.to_jurisdictions(n.select(F.col("n_nationkey").alias("id"), F.expr("transform(sequence(0, n_regionkey), x -> named_struct('id', cast(x as int)))").alias("jurisdictions")), "reporter_id"), "SELECT n_nationkey AS reporter_id, unnest(range(n_regionkey + 1))::INT AS jurisdiction_id FROM nation")
query("S23_blanks", "nation", lambda n: cleanups.blanks_as_null(n.select("n_nationkey", F.when(F.col("n_regionkey") == 1, "").otherwise(F.col("n_name")).alias("name"), F.col("n_regionkey").cast("int").alias("start")), "name", "start"), "SELECT n_nationkey, CASE WHEN n_regionkey <> 1 THEN n_name END AS name, nullif(n_regionkey, 0)::INT AS start FROM nation")
query("S24_case_metadata", "raw_metadata", cleanups.case_metadata, "SELECT id, cites, decision_date_original, court__name_abbreviation AS court_name_abbreviation, TRY_CAST(CASE WHEN regexp_full_match(left(decision_date_original, 4), '[0-9]+') THEN left(decision_date_original, 4) END AS INT) AS decision_year, CASE WHEN length(decision_date_original) = 10 THEN TRY_CAST(decision_date_original AS DATE) END AS decision_date FROM {raw_metadata}")
query("S25_english_reports", "raw_reports", cleanups.english_reports, """SELECT er_id AS id, nullif(er_name, '') AS er_name, er_year, CASE er_year % 5 WHEN 0 THEN make_date(er_year, 2, 1) WHEN 1 THEN make_date(er_year, 3, 3) ELSE make_date(er_year, 5, 4) END AS er_date, er_cite, er_cite_disambiguated, er_parallel_cite, murrell_uid, murrell_year, murrell_title, court
    FROM {raw_reports} WHERE er_year % 5 NOT IN (2, 3)""")
query("S26_whitelist", "raw_whitelist", lambda w: cleanups.whitelist(w, "line"), "SELECT trim(reporter_found) AS reporter_found, arg_min(reporter_standard, line) AS reporter_standard, arg_min(coalesce(statute, false), line) AS statute, arg_min(coalesce(uk, false), line) AS uk, false AS junk FROM {raw_whitelist} GROUP BY 1")
query("S27_whitelist_csv", "tall", exports.whitelist_lines, f"SELECT {_QUOTED('reporter_found')} || ',' || {_QUOTED('coalesce(reporter_standard, chr(0))').replace('chr(0)', chr(39) * 2)} || ',' || junk AS line FROM {{tall}}")
query("S27_statutes_csv", "tall", exports.statute_lines, f"SELECT {_QUOTED('reporter_standard')} || ',,,' || CASE WHEN uk THEN 'uk:' ELSE '' END || ',,,,statute,' AS line FROM {{tall}} WHERE statute")
query("S28_dashboard_json", f"{registry._LU} whitelist reporters", lambda *a: exports.json_rows(V.dashboard_reporters(*a), "reporter_standard", "linked", "no_match"), "SELECT json_object('reporter_standard', reporter_standard, 'linked', linked, 'no_match', no_match)::VARCHAR AS json FROM {by_reporter}")
query("S28_page_text_json", "page_ocrtext", lambda o: exports.json_rows(o.select(F.coalesce("ocrtext", F.lit("")).alias("text"))), "SELECT json_object('text', coalesce(ocrtext, ''))::VARCHAR AS json FROM {page_ocrtext}")
query("S29_textbooks_csv", "textbooks_vols", lambda v: exports.csv_lines(v.groupBy("school", "topic").agg(V.n()), ["school", "topic", "n"]), "SELECT school || ',' || topic || ',' || count(*) AS line FROM {textbooks_vols} GROUP BY school, topic")
query("D12_detector_list", "reporters reporters_abbreviations", lambda r, a: D.single_volume_abbrs(r, a).orderBy("reporter_standard", "abbreviation"), "SELECT reporter_standard, reporter_standard AS abbreviation FROM {reporters} WHERE single_vol UNION SELECT reporter_standard, alt_abbr FROM {reporters_abbreviations} JOIN {reporters} USING (reporter_standard) WHERE single_vol")
