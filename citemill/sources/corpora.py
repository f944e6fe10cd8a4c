"""Readers of the source corpora. All paths are opened by Spark."""

from __future__ import annotations

import io
import lzma
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Codes of citation types.
CITATION_TYPES = {"1": "federal", "2": "state", "3": "state_regional", "4": "specialty", "5": "scotus_early", "6": "lexis", "7": "west", "8": "neutral", "9": "journal"}
#: How a record begins, the name of a case's file, and the fields of a case.
RECORD = r'^"?(\d+)"?,"?\d{4}-\d{2}-\d{2} \d{2}:\d{2}:'
CASE_FILE = r'law\.free\.cap\.[^",\s]*\.(\d+)\.json'
CASE_JSON = """id BIGINT, name STRING, name_abbreviation STRING, decision_date STRING, docket_number STRING, first_page STRING, last_page STRING, url STRING, frontend_url STRING,
    citations ARRAY<STRUCT<cite: STRING, type: STRING>>, volume STRUCT<barcode: STRING, volume_number: STRING>, reporter STRUCT<id: BIGINT, full_name: STRING>,
    court STRUCT<id: BIGINT, name: STRING, name_abbreviation: STRING, slug: STRING, url: STRING>, jurisdiction STRUCT<id: BIGINT, name: STRING, name_long: STRING, slug: STRING, whitelisted: BOOLEAN, url: STRING>,
    casebody STRUCT<data: STRUCT<opinions: ARRAY<STRUCT<type: STRING, author: STRING, text: STRING>>>>"""


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """One document per file: parent_id (''), id (file name), text."""
    return spark.read.text(path, wholetext=True).select(F.lit("").alias("parent_id"), F.col("_metadata.file_name").alias("id"), F.col("value").alias("text"))


def edge_list(lines: DataFrame) -> DataFrame:
    """Lines `a,b,c` (value) -> rows a, b and a, c. A line without a comma gives none."""
    parts = lines.select(F.split("value", ",").alias("p")).where(F.size("p") > 1)
    return parts.select(F.col("p")[0].alias("cites_from"), F.explode(F.expr("slice(p, 2, size(p) - 1)")).alias("cites_to"))


def strict_int(raw: Column) -> Column:
    """A number of digits with a sign; anything else, spaces included, is null."""
    return F.when(raw.rlike(r"^[+-]?[0-9]+\z"), raw.try_cast("int"))


def strict_date(raw: Column) -> Column:
    return F.when(raw.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.try_to_date(raw, "yyyy-MM-dd"))


def cases_xz(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of .xz files, decompressed as a stream in each task, as parsed cases."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                part: list[str] = []
                with lzma.open(io.BytesIO(content), "rt", encoding="utf-8") as f:
                    for line in f:
                        if line.strip():
                            part.append(line)
                        if len(part) == 1000:
                            yield pd.DataFrame({"value": part})
                            part = []
                yield pd.DataFrame({"value": part})

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "value string")
    return parse_cases(raw)


def parse_cases(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", CASE_JSON).alias("c")).select("c.*")


def split_cases(cases: DataFrame) -> dict[str, DataFrame]:
    """courts, jurisdictions, cases, citations and opinions. All but opinions are unique by key."""
    case = cases.select(
        "id",
        "name",
        "name_abbreviation",
        strict_int(F.substring("decision_date", 1, 4)).alias("decision_year"),
        strict_date(F.col("decision_date")).alias("decision_date"),
        strict_int(F.col("first_page")).alias("first_page"),
        strict_int(F.col("last_page")).alias("last_page"),
        F.col("volume.barcode").alias("volume"),
        F.col("reporter.id").alias("reporter"),
        F.col("court.id").alias("court"),
        F.col("jurisdiction.id").alias("jurisdiction"),
        "frontend_url",
        F.col("decision_date").alias("decision_date_raw"),
    )
    return {
        "courts": cases.select("court.*").dropDuplicates(["id"]),
        "jurisdictions": cases.select("jurisdiction.*").dropDuplicates(["id"]),
        "cases": case.dropDuplicates(["id"]),
        "citations": cases.select(F.explode("citations").alias("c"), F.col("id").alias("case_id")).select("c.cite", "c.type", "case_id").distinct(),
        "opinions": cases.select(F.col("id").alias("case_id"), F.explode("casebody.data.opinions").alias("o")).select("case_id", "o.*"),
    }


def staging_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, .bz2 included, with all columns as text: unquoted empty fields are null, quoted ones empty."""
    quoted = "\u0001"  # stands for a quoted empty field, which the reader would else make null as well
    raw = spark.read.option("header", True).option("nullValue", "").option("emptyValue", quoted).option("escape", '"').option("multiLine", False).csv(path)
    return raw.select(*[F.when(F.col(f"`{c}`") == quoted, "").otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def freelaw_citations(staged: DataFrame) -> DataFrame:
    """Citations with named types; other types are left out."""
    names = F.create_map(*[F.lit(x) for kv in CITATION_TYPES.items() for x in kv])
    cite = F.concat_ws(" ", "volume", "reporter", "page")
    return staged.withColumn("type", F.element_at(names, F.col("type"))).where("type IS NOT NULL").select(
        F.col("id").cast("long").alias("id"), "volume", "reporter", "page", cite.alias("cite"), "type", F.col("cluster_id").cast("long").alias("cluster_id"), *[F.nullif(c, F.lit("")).try_cast("timestamp").alias(c) for c in ("date_created", "date_modified") if c in staged.columns]
    )


def cluster_records(lines: DataFrame) -> DataFrame:
    """Lines (part, line_no, value) of a broken CSV -> cluster_id, cap_case_id: a record begins at a line with an id and a time;
    the first case file named in it counts. Lines are in order within a part; a record may begin in an earlier part.

    Each part is scanned alone; what its first lines name before a record begins is handed to the last record before it.
    """
    schema = "part long, line_no long, kind string, cluster_id long, cap_case_id long"
    marked = lines.select(
        "part", "line_no", F.nullif(F.regexp_extract("value", RECORD, 1), F.lit("")).try_cast("long").alias("cluster_id"), F.nullif(F.regexp_extract("value", CASE_FILE, 1), F.lit("")).try_cast("long").alias("cap_case_id")
    ).where("cluster_id IS NOT NULL OR cap_case_id IS NOT NULL")

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        out, head, current = [], None, None
        for r in pdf.sort_values("line_no").itertuples():
            if not pd.isna(r.cluster_id):
                current = [r.part, r.line_no, "record", int(r.cluster_id), None]
                out.append(current)
            if not pd.isna(r.cap_case_id):
                if current is None:
                    head = head or [r.part, r.line_no, "head", None, int(r.cap_case_id)]
                elif current[4] is None:
                    current[4] = int(r.cap_case_id)
        rows = ([head] if head else []) + out
        return pd.DataFrame(rows, columns=["part", "line_no", "kind", "cluster_id", "cap_case_id"]).astype({"cluster_id": "Int64", "cap_case_id": "Int64"})

    found = marked.groupBy("part").applyInPandas(scan, schema)
    records, heads = found.where("kind = 'record'"), found.where("kind = 'head'")
    # One row a part: its last record, and the first name before its own first record.
    last = records.groupBy("part").agg(F.max_by(F.struct("line_no", "cluster_id", "cap_case_id"), "line_no").alias("r"))
    open_ = heads.alias("h").join(last.alias("l"), F.col("l.part") < F.col("h.part")).groupBy(F.col("h.part").alias("p"), F.col("h.cap_case_id").alias("c")).agg(F.max("l.part").alias("part"))
    handed = open_.groupBy("part").agg(F.min_by("c", "p").alias("c"))
    filled = records.join(handed, "part", "left").join(last.select("part", F.col("r.line_no").alias("at")), "part").withColumn("cap_case_id", F.coalesce("cap_case_id", F.when(F.col("line_no") == F.col("at"), F.col("c"))))
    return filled.where("cap_case_id IS NOT NULL").select("part", "line_no", "cluster_id", "cap_case_id")


def clusters_to_cap(records: DataFrame, cap_cases: DataFrame) -> DataFrame:
    """The first record of each cluster; a case that isn't known is null."""
    first = records.groupBy("cluster_id").agg(F.min(F.struct("part", "line_no", "cap_case_id")).alias("f")).select("cluster_id", F.col("f.cap_case_id").alias("id"))
    known = cap_cases.select("id", F.col("id").alias("cap_case_id"))
    return first.join(known, "id", "left").select("cluster_id", "cap_case_id")


def side_corpus_pages(files: DataFrame) -> DataFrame:
    """Files (path, text) named <psmid>/<n>.txt -> psmid, pageid (n * 10, five digits at least), ocrtext."""
    name = F.regexp_extract("path", r"([^/]+)/([0-9]+)\.txt$", 2)
    return files.where(name != "").select(F.regexp_extract("path", r"([^/]+)/([0-9]+)\.txt$", 1).alias("psmid"), F.format_string("%05d", name.cast("long") * 10).alias("pageid"), F.col("text").alias("ocrtext"))


#: Columns of the side corpus's list of books, by position.
BOOKS = ["bibliographicid", "year", "title", "currentvolume", "productlink", "webid", "psmid", "author"]


def side_corpus_books(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A CSV file with a header (and perhaps a byte order mark) -> book_info and legal_treatises_metadata."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    if len(raw.columns) < len(BOOKS):
        raise ValueError(f"{len(raw.columns)} columns, {len(BOOKS)} expected")
    return books(raw.select(*[F.col(f"`{c}`") for c in raw.columns[: len(BOOKS)]]).toDF(*BOOKS))


def books(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of BOOKS, as text. `NULL` or an empty id is null; a year that isn't a number is an error; the first of a psmid stays."""
    trimmed = {c: F.trim(F.coalesce(c, F.lit(""))) for c in BOOKS if c != "bibliographicid"}
    one = raw.withColumns(trimmed | {"bibliographicid": F.nullif(F.nullif("bibliographicid", F.lit("")), F.lit("NULL"))})
    year = F.coalesce(strict_int(F.col("year")), F.raise_error(F.concat(F.lit("no year: "), "year")).cast("int"))
    one = one.withColumn("year", year).groupBy("psmid").agg(F.min(F.struct("webid", "year", "title", "currentvolume", "productlink", "bibliographicid", "author")).alias("b")).select("psmid", "b.*")
    info = one.select("psmid", "bibliographicid", "webid", "year", "productlink")
    return info, one.select("psmid", F.col("author").alias("author_by_line"), "title", F.col("currentvolume").alias("current_volume"))


def ocr_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Rules in the file's order; its first line is a header."""
    return ordered_rules(spark.read.option("header", True).csv(path).toDF("mistake", "correction").withColumn("ord", F.monotonically_increasing_id()))


def ordered_rules(rules: DataFrame) -> list[tuple[str, str]]:
    """Rules of a table (mistake, correction, ord), a hand-made list of some hundred rows, in order."""
    return [(r.mistake, r.correction or "") for r in rules.orderBy("ord", "mistake").collect() if r.mistake]


def scanned_pages(ocr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages that can be read, and (psmid, pageid) of those that have no text, to be reported."""
    return ocr.where("ocrtext IS NOT NULL"), ocr.where("ocrtext IS NULL").select("psmid", "pageid")


def unprocessed_pages(ocr: DataFrame, book_info: DataFrame, book_subject: DataFrame, requests: DataFrame, excluded: list[str], batch: int) -> DataFrame:
    if batch < 0:
        raise ValueError("a batch can't be negative")
    left_out = book_subject.where(F.col("subject").isin(excluded)).select("psmid")
    return ocr.join(book_info.select("psmid"), "psmid", "left_semi").join(left_out, "psmid", "left_anti").join(requests.select("psmid", "pageid"), ["psmid", "pageid"], "left_anti").orderBy("psmid", "pageid").limit(batch)


def first_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    others = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def english_dates(raw: Column) -> Column:
    """Day, month and year in some common forms; null if it is none of them."""
    return F.coalesce(*[F.try_to_date(raw, f) for f in ("d/M/yyyy", "d-M-yyyy", "d MMMM yyyy", "d MMM yyyy")])
