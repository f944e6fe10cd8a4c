import lzma
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from citemill.functions import text as T
from citemill.operators import browse, coupling, detect, graph, link, views
from citemill.plans import registry, scratch, source_queries  # noqa: F401  the latter adds to the former
from citemill.sources import corpora, sinks
from citemill.streaming.incremental import detect_stream

SF = "/root/testdata/sf0.001"


def raws(spark, text, pattern=detect.GENERIC):
    df = spark.createDataFrame([("t", "p", text)], "psmid string, pageid string, ocrtext string")
    rows = detect.with_fields(detect.windowed(detect.windows(df), pattern, 0)).orderBy("ord").collect()
    return [f"{r.volume} {r.reporter_abbr} {r.page}" for r in rows]


def test_generic(spark):
    # Spellings that the detectors have to find as they stand.
    parts = ["(2 Kans. 416).", "71 N. C. 297", "39 N. Y. 436", "6 Ex parte Wray, 30 Missis. 673;", "1 C. R. (N. S.) 413", "6 Rex v. Osborn, 30", "1 Leach, 4th ed. 484"]
    text = " and then some further words of the text ".join(parts)
    assert raws(spark, text) == ["2 Kans. 416", "71 N. C. 297", "39 N. Y. 436", "30 Missis. 673", "1 C. R. (N. S.) 413", "1 Leach, 4th ed. 484"]


def test_ocr_digit_only_adds(spark):
    assert raws(spark, "see 102 F1ed. 785 and 102 Fed. 780", detect.OCR_DIGIT) == ["102 F1ed. 785"]
    assert raws(spark, "see 102 Fed. 780 and 5 Leach, 4th ed. 484", detect.OCR_DIGIT) == []


@pytest.mark.parametrize(("abbr", "text", "want"), [("Toth", "in Toth., 234. Tothill, 876 McToth 5", ["Toth. 234", "Tothill 876"]), ("M & M", "M&M. 12 (M & M 123) M. & M. 234", ["M&M. 12", "M & M 123", "M. & M. 234"]), ("Hob.", "x Hob. 423", ["Hob. 423"])])
def test_single_volume(spark, abbr, text, want):
    df = spark.createDataFrame([("t", "p", text)], "psmid string, pageid string, ocrtext string")
    rows = detect.with_fields(detect.single_volume(df, [abbr])).orderBy("ord").collect()
    assert [f"{r.reporter_abbr} {r.page}" for r in rows] == want
    assert all(r.volume is None for r in rows)


def test_text_functions(spark):
    df = spark.createDataFrame([("Il1l. .. x",), ("N..  Y.",)], "s string")
    assert [r[0] for r in df.select(T.strip_interior_digits(F.col("s"))).collect()] == ["Ill. .. x", "N..  Y."]
    assert [r[0] for r in df.select(T.clean_reporter(F.col("s"))).collect()] == ["Il1l. . x", "N. Y."]
    cites = spark.createDataFrame([("5 U.S. 10",), ("U.S. 10",), ("nothing",), ("5 10",)], "c string")
    assert [tuple(r) for r in cites.select(T.cite_volume(F.col("c")), T.cite_reporter(F.col("c"))).collect()] == [("5", "U.S."), ("", "U.S."), (None, None), ("", "5")]


def cascade(spark, volume, abbr, known, alts=(), uk=False, single=False, diff=False):
    u = spark.createDataFrame([("1", volume, abbr, 10)], "id string, volume int, reporter_abbr string, page int")
    e = spark.createDataFrame([("U.S.", "U.S.", False, uk, single, diff, None)], "reporter_found string, reporter_standard string, junk boolean, uk boolean, single_vol boolean, cap_different boolean, reporter_cap string")
    d = spark.createDataFrame([("U.S.", 5, 7, "Cap.")] if diff else [], "reporter_standard string, vol int, cap_vol int, cap_reporter string")
    a = spark.createDataFrame([("U.S.", list(alts))] if alts else [], "reporter_standard string, alts array<string>")
    k = spark.createDataFrame(known, "source string, cite string, ref string")
    r = link.link(u, e, d, a, k).first()
    return r.status, r.match_tier, r.cap_case_id or r.code_reporter_id or r.er_case_id, r.cite_linked


def test_cascade(spark):
    cap, free = ("cap", "5 U.S. 10", "111"), ("freelaw", "5 U.S. 10", "222")
    assert cascade(spark, 5, "U.S.", [cap, free]) == ("linked_cap", "cap_direct", 111, "5 U.S. 10")
    assert cascade(spark, 5, "U.S.", [free, ("cap", "5 US 10", "3")], ["US"]) == ("linked_cap", "cap_freelaw", 222, "5 U.S. 10")
    assert cascade(spark, 5, "U.S.", [("code", "5 U.S. 10", "9")]) == ("linked_code_reporter", "code_direct", 9, "5 U.S. 10")
    assert cascade(spark, 5, "U.S.", [("er", "5 U.S. 10", "x"), cap], uk=True) == ("linked_english_reports", "er_direct", "x", "5 U.S. 10")
    assert cascade(spark, 5, "U.S.", [("cap", "7 Cap. 10", "4"), cap], diff=True) == ("linked_cap", "cap_direct", 4, "7 Cap. 10")
    assert cascade(spark, None, "U.S.", [("cap", "1 U.S. 10", "4")], single=True) == ("linked_cap", "cap_direct", 4, "1 U.S. 10")
    assert cascade(spark, 5, "U.S.", [("cap", "5 U.S. 11", "4")])[:2] == ("no_match", "us_page_absent")
    assert cascade(spark, 5, "U.S.", [("cap", "6 U.S. 10", "4")])[:2] == ("no_match", "us_volume_absent")
    assert cascade(spark, 5, "U.S.", [("cap", "6 X 10", "4")])[:2] == ("no_match", "us_reporter_absent")
    assert cascade(spark, 6, "U.S.", [("cap", "5 U.S. 10", "4")], diff=True)[:2] == ("no_match", "us_diffvols_missing")
    assert cascade(spark, 5, "other", [cap])[:2] == ("skipped_not_whitelisted", None)


def test_cascade_order(spark):
    """Sources are exhausted over all spellings before the next source; all of them on the detected volume before its variant."""
    one = ("5 U.S. 10", "5 Un. S. 10", "5 U. States 10")
    alts = ["U. States", "Un. S."]  # in order of their bytes
    assert cascade(spark, 5, "U.S.", [("freelaw", one[2], "7"), ("cap", one[1], "8")], alts) == ("linked_cap", "cap_alt_spelling", 8, one[1])
    assert cascade(spark, 5, "U.S.", [("cap", one[1], "8"), ("cap", one[2], "9")], alts) == ("linked_cap", "cap_alt_spelling", 9, one[2])
    assert cascade(spark, 5, "U.S.", [("cap", one[1], "8"), ("freelaw", one[0], "9")], alts) == ("linked_cap", "cap_freelaw", 9, one[0])
    assert cascade(spark, 5, "U.S.", [("freelaw", one[1], "8"), ("code", one[0], "9")], alts) == ("linked_cap", "cap_freelaw_alt_spelling", 8, one[1])
    assert cascade(spark, 5, "U.S.", [("code", one[1], "8"), ("code", one[0], "9")], alts) == ("linked_code_reporter", "code_direct", 9, one[0])
    assert cascade(spark, None, "U.S.", [("cap", "1 U.S. 10", "7"), ("code", "Un. S. 10", "9")], alts, single=True) == ("linked_code_reporter", "code_alt_spelling", 9, "Un. S. 10")
    assert cascade(spark, 1, "U.S.", [("cap", "U.S. 10", "7")], single=True) == ("linked_cap", "cap_direct", 7, "U.S. 10")
    assert cascade(spark, 2, "U.S.", [("cap", "U.S. 10", "7"), ("cap", "1 U.S. 10", "8")], single=True)[:2] == ("no_match", "us_volume_absent")
    assert cascade(spark, 5, "U.S.", [("code", "7 Cap. 10", "4")], diff=True)[:2] == ("no_match", "us_page_absent")
    assert cascade(spark, 5, "U.S.", [("cap", one[0], "4")], alts, uk=True)[:2] == ("no_match", "uk_reporter_absent")


def test_repeated_citations_share_their_link(spark):
    u = spark.createDataFrame([("1", 5, "U.S.", 10), ("2", 5, "U.S.", 10), ("3", None, "U.S.", 10), ("4", None, "U.S.", 10), ("5", 5, None, 10)], "id string, volume int, reporter_abbr string, page int")
    e = spark.createDataFrame([("U.S.", "U.S.", False, False, False, False, None)], "reporter_found string, reporter_standard string, junk boolean, uk boolean, single_vol boolean, cap_different boolean, reporter_cap string")
    d = spark.createDataFrame([], "reporter_standard string, vol int, cap_vol int, cap_reporter string")
    a = spark.createDataFrame([], "reporter_standard string, alts array<string>")
    k = spark.createDataFrame([("cap", "5 U.S. 10", "3")], "source string, cite string, ref string")
    got = {r.citation_id: (r.status, r.cap_case_id) for r in link.link(u, e, d, a, k).collect()}
    assert got == {"1": ("linked_cap", 3), "2": ("linked_cap", 3), "3": ("no_match", None), "4": ("no_match", None), "5": ("skipped_not_whitelisted", None)}


def test_one_pass_finds_what_each_detector_does(spark):
    pages = spark.createDataFrame([("t", "1", "see 2 Kans. 416; 102 F1ed. 785, Hob. 423 and 2 Kans. 416"), ("t", "2", None), ("t", "3", "")], "psmid string, pageid string, ocrtext string")
    found = detect.all_detectors(pages, ["Hob."], [detect.GENERIC, detect.OCR_DIGIT]).collect()
    each = [detect.windowed(detect.windows(pages), p, k).select("ord", "raw", "detector") for k, p in enumerate((detect.GENERIC, detect.OCR_DIGIT))]
    want = each[0].unionByName(each[1]).unionByName(detect.single_volume(pages, ["Hob."]).select("ord", "raw", "detector"))
    assert sorted((r.detector, r.ord, r.raw) for r in found) == sorted((r.detector, r.ord, r.raw) for r in want.collect()) and len(found) >= 4
    assert detect.detect(pages, ["Hob."]).count() == 5 and detect.detect(pages, [], general=[detect.GENERIC]).count() == 2


def test_parts_of_a_table(spark, tmp_path):
    table = sinks.Table(spark, str(tmp_path / "t"), "a int")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "a int")
    assert table.read().count() == 0
    table.append(rows(1))
    old = table.read()
    table.append(old.union(rows(2)))
    (tmp_path / "t" / "v=1" / "p=2").mkdir()
    (tmp_path / "t" / "v=1" / "p=2" / "part-0.parquet").write_bytes(b"left behind by a write that failed")
    assert sorted(r.a for r in table.read().collect()) == [1, 1, 2]
    table.append(rows(3))
    table.replace(table.read().where("a > 1"))
    assert sorted(r.a for r in table.read().collect()) == [2, 3] and sorted(r.a for r in old.collect()) == [1]


def test_components_of_a_chain(spark):
    """A long chain in the order of its names takes no round for each link."""
    names = [f"n{i:04}" for i in range(400)]
    edges = spark.createDataFrame([*zip(names, names[1:]), ("x", "y"), ("z", "z")], "a string, b string").where("a <> 'n0200'")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {n: "n0000" if n <= "n0200" else "n0201" for n in names} | {"x": "x", "y": "x", "z": "z"}
    assert graph.largest_component(edges).count() == 200


def test_spellings_beside_all_pairs(spark):
    """Blocked matching finds what comparing all pairs does."""
    abbrs = spark.createDataFrame([(x,) for x in ("", ". .", "Mass", "M", "Masz.", "xyz", "Wend", "w.")], "reporter_abbr string")
    standards = spark.createDataFrame([(x,) for x in ("Mass.", "Wend.", "Ga.", ".")], "reporter_standard string")
    both = abbrs.crossJoin(standards)
    norm = lambda c: T.normalize_reporter(F.col(c))
    want = {(r.reporter_abbr, r.reporter_standard, r.s) for r in both.withColumn("s", T.match_score(norm("reporter_abbr"), norm("reporter_standard"))).where("s >= 30").collect()}
    assert {(r.reporter_abbr, r.reporter_standard, r.score) for r in browse.fuzzy_matches(abbrs, standards).collect()} == want and len(want) > 8


def test_books_and_sizes(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes(b'\xef\xbb\xbfid,year,title,vol,link,web,psm,author\nNULL, 1801 ,"A ""B"", c",1,l,w, P1 ,x\n,1802,T,2,l,w,P2,y\n')
    info, more = corpora.side_corpus_books(spark, str(tmp_path / "b.csv"))
    assert sorted((r.psmid, r.bibliographicid, r.year) for r in info.collect()) == [("P1", None, 1801), ("P2", None, 1802)]
    assert {r.psmid: r.title for r in more.collect()} == {"P1": 'A "B", c', "P2": "T"}
    (tmp_path / "c.csv").write_text("id,year\n1,2\n")
    with pytest.raises(ValueError):
        corpora.side_corpus_books(spark, str(tmp_path / "c.csv"))
    sizes = {r.table_name: r.bytes for r in views.table_sizes({"b": str(tmp_path / "b.csv"), "c": str(tmp_path / "c.csv")}, spark).collect()}
    assert sizes == {"b": (tmp_path / "b.csv").stat().st_size, "c": 12, "total": (tmp_path / "b.csv").stat().st_size + 12}


def test_sources(spark, tmp_path):
    lines = spark.createDataFrame([("a,b,c",), ("d",)], "value string")
    assert sorted(map(tuple, corpora.edge_list(lines).collect())) == [("a", "b"), ("a", "c")]
    (tmp_path / "xz").mkdir()
    case = {"id": 1, "name": "A v. B", "decision_date": "1850", "first_page": " 12", "last_page": "13", "citations": [{"cite": "1 X 2", "type": "official"}], "court": {"id": 5, "name": "C"}, "jurisdiction": {"id": 6}, "casebody": {"data": {"opinions": [{"type": "m", "text": "t"}]}}}
    (tmp_path / "xz" / "c.jsonl.xz").write_bytes(lzma.compress((json.dumps(case) + "\n" + json.dumps(case) + "\n").encode()))
    got = corpora.split_cases(corpora.cases_xz(spark, str(tmp_path / "xz")))
    row = got["cases"].first()
    assert (got["cases"].count(), got["opinions"].count(), row.decision_year, row.decision_date, row.first_page, row.last_page) == (1, 2, 1850, None, None, 13)
    records = [(0, 0, '"7","2020-01-01 00:00:'), (0, 1, "x"), (1, 0, "law.free.cap.us.12.json law"), (1, 1, '8,"2020-01-01 00:00: law.free.cap.us.13.json'), (1, 2, "law.free.cap.us.14.json")]
    found = corpora.cluster_records(spark.createDataFrame(records, "part long, line_no long, value string"))
    assert sorted((r.cluster_id, r.cap_case_id) for r in found.collect()) == [(7, 12), (8, 13)]
    files = spark.createDataFrame([("x/B1/12345.txt", "t")], "path string, text string")
    assert corpora.side_corpus_pages(files).first().pageid == "123450"


def test_sinks_and_stream(spark, tmp_path):
    pages = str(tmp_path / "pages")
    spark.createDataFrame([("t", "1", "see 2 Kans. 416, the rule")], "psmid string, pageid string, ocrtext string").write.parquet(pages)
    table = sinks.Table(spark, str(tmp_path / "unlinked"), "id string, moml_treatise string, moml_page string, raw string, volume int, reporter_abbr string, page int")
    for _ in range(2):
        detect_stream(spark, pages, table, str(tmp_path / "state")).awaitTermination()
    sinks.save_citations(table, table.read())
    assert table.read().count() == 1
    links = sinks.Table(spark, str(tmp_path / "links"), "citation_id string, status string, match_tier string")
    sinks.save_links(links, spark.createDataFrame([("1", "no_match", ""), ("2", "linked_cap", "cap_direct")], "citation_id string, status string, match_tier string"))
    assert (sinks.reset(links), sinks.reset(links), links.read().count()) == (1, 0, 1)


def test_graph(spark):
    e = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("d", "e", 1)], "a string, b string, n int")
    assert {r.node: r.component for r in graph.components(e).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert {r.node: r.betweenness for r in graph.betweenness(e).collect()}["b"] == 1.0
    assert len({r.community for r in graph.communities(e).collect()}) >= 2
    assert views.refresh_levels({"a": [], "b": ["a"], "c": []}) == [["a", "c"], ["b"]]


@pytest.mark.parametrize("name", ["D11_detect", "D14_yield", "D16_ambiguous_spellings", "L15_link", "Q10_us_treatises", "Q18_tier_summary", "Q24_coupled_treatises", "B8_fuzzy_matches", "B20_top_cases", "N4_shares", "N10_top_subjects", "N12_components", "N17_projection", "S5_staging_csv", "S7_cluster_records", "S8_clusters_to_cap", "S18_stale_code_links", "S26_whitelist"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, SF).select(*want.columns).collect()
    norm = lambda rows: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert got and norm(got) == norm(want.fetchall())


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_dense_projection(spark, kind):
    """Counts by blocks are those of the self-join, however many neighbours, chunks and batches there are."""
    rows = [(f"{i * 7919 % 101}", j) for i in range(60) for j in range(3000) if (i * 31 + j * 17) % 11 < 4 or j == 5] + [(None, 1), ("1", None), ("900", 9000)]
    pairs = spark.createDataFrame(rows, "work string, case long").withColumn("work", F.col("work").cast(kind)).repartition(7)
    want = {(r.a, r.b): r.n for r in views.project(pairs, "work", "case").collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "333")
    try:
        got = coupling.project_dense(pairs, "work", "case", block=16)
        assert "MapInArrow" in got._jdf.queryExecution().toString()
        assert {(r.a, r.b): r.n for r in got.collect()} == want and len(want) > 1500
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_dense_projection_with_an_empty_block(spark):
    pairs = spark.range(90).selectExpr("id AS node", "explode(array(1, 2, 3)) AS case")
    assert spark.range(90).selectExpr("pmod(xxhash64(id), 30) AS b").distinct().count() < 30
    got = coupling.project_dense(pairs, "node", "case", block=3).collect()
    assert len(got) == 90 * 89 // 2 and all(r.a < r.b and r.n == 3 for r in got)


def test_dense_graph_is_made_once(spark, monkeypatch):
    """Components and the largest of them read a stored graph; neither plan links or couples again."""
    for name, rows in (("N12_components", 100), ("N12_largest", 4950)):
        made = []
        monkeypatch.setattr(views, "coupled_treatises", lambda *_a: (made.append(1), spark.range(100).selectExpr("cast(id AS string) AS work", "explode(sequence(0, 99)) AS o").selectExpr("work", "cast(o AS string) AS other", "3L AS n").where("work <> other"))[1])
        monkeypatch.setattr(registry, "_spark_relation", lambda *_a: None)
        got = registry.QUERIES[name](spark, "")
        assert got.count() == rows and made == [1]
        assert "Range" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("few", [200_000, 0])
def test_coupling_by_fates(spark, monkeypatch, few):
    """Works are coupled by the fates of citations as by links of each, sent to all tasks or not."""
    monkeypatch.setattr(link, "FEW_FATES", few)
    rows = [(f"{t}{i}", f"T{t}", v, abbr, p) for t in range(4) for i, (v, abbr, p) in enumerate([(5, "U.S.", 10), (5, "U.S.", 10), (None, "U.S.", 11), (5, None, 10), (5, "U.S.", 12 + t // 3), (None, None, None)])]
    u = spark.createDataFrame(rows, "id string, moml_treatise string, volume int, reporter_abbr string, page int")
    e = spark.createDataFrame([("U.S.", "U.S.", False, False, True, False, None)], "reporter_found string, reporter_standard string, junk boolean, uk boolean, single_vol boolean, cap_different boolean, reporter_cap string")
    d = spark.createDataFrame([], "reporter_standard string, vol int, cap_vol int, cap_reporter string")
    a = spark.createDataFrame([], "reporter_standard string, alts array<string>")
    k = spark.createDataFrame([("cap", "5 U.S. 10", "3"), ("cap", "1 U.S. 11", "4"), ("cap", "5 U.S. 12", "5"), ("code", "5 U.S. 13", "6")], "source string, cite string, ref string")
    b = spark.createDataFrame([("T0", "B0"), ("T1", "B1"), ("T2", "B1"), ("T3", "B3")], "psmid string, bibliographicid string")
    got = {kind: {(r.work, r.other): r.n for r in views.coupled_treatises(x, u, b).collect()} for kind, x in (("fates", link.fates(u, e, d, a, k)), ("links", link.link(u, e, d, a, k)))}
    assert got["fates"] == got["links"] == {("B0", "B1"): 3, ("B1", "B0"): 3, ("B0", "B3"): 2, ("B3", "B0"): 2, ("B1", "B3"): 2, ("B3", "B1"): 2}


def test_largest_component_stores_no_link_of_each_citation(spark, monkeypatch):
    """At 1 GB the links of all citations, and dealing citations out by their ids, took more disk than there is."""
    made, old = [], scratch.stored
    for module in (scratch, link):
        monkeypatch.setattr(module, "stored", lambda df: (made.append(df), old(df))[1])
    monkeypatch.setattr(registry, "_LINKS", {})
    assert registry.QUERIES["N12_largest"](spark, SF).schema.names == ["a", "b", "n"]
    assert made and not any("citation_id" in df.columns for df in made)
    assert not any("md5(" in df._jdf.queryExecution().optimizedPlan().toString() for df in made)


@pytest.fixture
def large_group(spark):
    """Links, citations, white list, titles, pages and books with more unmatched cites, and more pages citing case 20, than a browse page shows."""
    cites = spark.range(14_000).selectExpr("cast(id AS string) AS id", "concat('T', id % 3) AS moml_treatise", "lpad(id, 5, '0') AS moml_page", "concat('Kelly ', id) AS raw", "cast(NULL AS int) AS volume", "'Kelly' AS reporter_abbr", "19 AS page")
    links = cites.selectExpr("id AS citation_id", "if(cast(id AS int) < 11000, 'no_match', 'linked_cap') AS status", "if(cast(id AS int) < 11000, NULL, 20L) AS cap_case_id")
    white = spark.createDataFrame([("Kelly", "Kelly", False)], "reporter_found string, reporter_standard string, junk boolean")
    titles = spark.createDataFrame([("T0", "One"), ("T1", "Two"), ("T2", None)], "psmid string, displaytitle string")
    pages = spark.createDataFrame([("T1", "00001", "p1")], "psmid string, pageid string, sourcepage string")
    books = spark.createDataFrame([("T0", "B0"), ("T1", "B1")], "psmid string, bibliographicid string")
    return links, cites, white, titles, pages, books


def test_unmatched_cites_without_a_limit(spark, large_group, monkeypatch):
    links, cites, white, titles, pages, _ = large_group
    known = {"citation_links": links, "citations_unlinked": cites, "whitelist": white, "book_citation": titles, "page": pages}
    monkeypatch.setattr(registry, "_spark_relation", lambda _spark, _dir, name: known[name])
    rows = registry.QUERIES["B13_unmatched_cites"](spark, "").collect()
    assert (len({r.id for r in rows}), len(rows), {r.total for r in rows}) == (11_000, 11_000, {11_000})
    assert browse.unmatched_cites(links, cites, white, titles, pages, standard="Kelly", volume=None, page_no=19).count() == 10_000


def test_case_detail_without_a_limit(spark, large_group, monkeypatch):
    links, cites, _, titles, pages, books = large_group
    known = {"citation_links": links, "citations_unlinked": cites, "book_info": books, "book_citation": titles, "page": pages}
    monkeypatch.setattr(registry, "_spark_relation", lambda _spark, _dir, name: known[name])
    rows = {r.work: r for r in registry.QUERIES["B21_case_detail"](spark, "").collect()}
    assert set(rows) == {"B0", "B1", "T2"} and sum(r.page_count for r in rows.values()) == sum(r.total for r in rows.values()) == 3000
    assert all(r.pages.count(";") == r.page_count - 1 for r in rows.values())
    first = browse.case_detail(links, cites, books, titles, pages, status="linked_cap", column="cap_case_id", case_id="20").collect()
    assert sum(r.page_count for r in first) == 2000


def plain_betweenness(near):
    """Shares of the shortest paths of each pair that lead through a node, by their lengths and numbers."""
    far, paths = {}, {}
    for s in near:
        far[s], paths[s], front = {s: 0}, {s: 1}, [s]
        while front:
            new = {}
            for v in front:
                for w in near[v]:
                    if w not in far[s]:
                        new[w] = new.get(w, 0) + paths[s][v]
            far[s] |= dict.fromkeys(new, far[s][front[0]] + 1)
            paths[s] |= new
            front = list(new)
    through = lambda v, s, t: paths[s][v] * paths[v][t] / paths[s][t] if v not in (s, t) and v in far[s] and t in far[v] and far[s][v] + far[v][t] == far[s][t] else 0
    return {v: sum(through(v, s, t) for s in near for t in far[s] if s < t) for v in near}


@pytest.mark.parametrize(("nodes", "step"), [(40, 3), (300, 101)])  # kept as bits; as lists
def test_betweenness_of_all_nodes(spark, monkeypatch, nodes, step):
    monkeypatch.setattr(graph, "MAX_DRIVER_EDGES", 5, raising=False)  # what there was
    links = {(f"n{i}", f"n{j}") for i in range(nodes) for j in range(i + 1, nodes, step)} | {("x", "y"), ("z", "z")}
    near = {v: {b if a == v else a for a, b in links if v in (a, b)} - {v} for v in {x for e in links for x in e}}
    monkeypatch.setattr(graph, "SOURCES", 7)
    monkeypatch.setattr(graph, "TILE", 16)
    got = {r.node: r.betweenness for r in graph.betweenness(spark.createDataFrame([(a, b, 1) for a, b in links], "a string, b string, n int")).collect()}
    assert got == pytest.approx(plain_betweenness(near)) and max(got.values()) > 1
    assert graph.betweenness(spark.createDataFrame([], "a string, b string, n int")).collect() == []


@pytest.mark.parametrize("kept", [0, 10**6])
def test_communities_of_all_links(spark, monkeypatch, kept):
    """Three groups of nodes, with weak links between, are told apart, whether or not the driver keeps the links."""
    monkeypatch.setattr(graph, "MAX_DRIVER_EDGES", 5, raising=False)  # what there was
    monkeypatch.setattr(graph, "KEPT_ENDS", kept)
    monkeypatch.setattr(graph, "READ_ENDS", 100)
    links = [(f"{i % 3}n{i:02}", f"{j % 3}n{j:02}", 20.5 if i % 3 == j % 3 else 0.1) for i in range(30) for j in range(i + 1, 30)]
    got = {r.node: r.community for r in graph.communities(spark.createDataFrame(links, "a string, b string, n double")).collect()}
    assert got == {f"{i % 3}n{i:02}": f"{i % 3}n{i % 3:02}" for i in range(30)}
    assert graph.communities(spark.createDataFrame([], "a string, b string, n double")).collect() == []
