"""Grading populations: report pages and text reports to rows, set totals, snapshots, top items."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.functions.text import count_cell, gem_rate, is_foreign, report_count

#: The grade columns in the order of the report.
GRADES = ("auth", "psa_1", "psa_1_5", "psa_2", "psa_3", "psa_4", "psa_5", "psa_6", "psa_7", "psa_8", "psa_9", "psa_10", "total_graded")
FIRST_GRADE_CELL, LEAST_CELLS = 4, 17
_CELLS = "page_id bigint, pos int, number string, strong string, after_break string, spec_id string, name_text string, counts array<string>"


class _Rows(HTMLParser):
    """Cells of the first table body: number, name parts, first division of each grade cell.

    A page comes in pieces that end anywhere, also within a text; a text's parts are kept until what ends it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.rows: list[dict] = []
        self.row: dict | None = None
        self.body = self.done = False
        self.cell, self.strong, self.broken, self.division = -1, False, False, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_text()
        a = {k: v or "" for k, v in attrs}
        if tag == "tbody" and not self.done:
            self.body = True
        elif tag == "tr" and self.body:
            self.row, self.cell = {"number": "", "strong": "", "after_break": "", "spec_id": "", "name_text": "", "counts": {}}, -1
        elif self.row is not None and tag == "td":
            self.cell, self.strong, self.broken, self.division = self.cell + 1, False, False, 0
            self.row["counts"].setdefault(self.cell, "")
        elif self.row is not None and tag == "strong":
            self.strong = self.cell == 2 and not self.row["strong"]
        elif self.row is not None and tag == "br":
            self.broken = self.cell == 2
        elif self.row is not None and tag == "div":
            self.division += 1
        elif self.row is not None and tag == "a":
            if "shop-link" in a.get("class", "").split() and not self.row["spec_id"]:
                self.row["spec_id"] = a.get("data-id", "")
            self.broken = False

    def handle_endtag(self, tag: str) -> None:
        self._end_text()
        if tag == "tbody" and self.body:
            self.body, self.done = False, True
        elif tag == "strong":
            self.strong = False
        elif tag == "tr" and self.row is not None:
            self.row["counts"] = [self.row["counts"][i] for i in sorted(self.row["counts"])]
            self.rows.append(self.row)
            self.row = None

    def handle_data(self, data: str) -> None:
        if self.row is not None:
            self.text.append(data)

    def handle_comment(self, data: str) -> None:
        self._end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def _end_text(self) -> None:
        if not self.text:
            return
        t = "".join(self.text).strip()
        self.text.clear()
        if self.row is None or not t:
            return
        if self.cell == 1:
            self.row["number"] += t
        elif self.cell == 2:
            self.row["name_text"] += t
            if self.strong:
                self.row["strong"] += t
            elif self.broken and not self.row["after_break"]:
                self.row["after_break"] = t
        elif self.cell >= FIRST_GRADE_CELL and self.division == 1:
            self.row["counts"][self.cell] += t


#: Characters of a page that are parsed, and rows that a task hands on, at a time.
_PIECE, _ROWS_AT_ONCE = 65_536, 2_000


def report_cells(pages: DataFrame) -> DataFrame:
    """Cells of every row of report pages. A page is parsed piece by piece, and its rows leave the task as they come."""
    names = [c.split()[0] for c in _CELLS.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.string()] * 5, pa.list_(pa.string())]

    def rows(page_id: int | None, html: str) -> Iterator[tuple]:
        parser, pos = _Rows(), 0
        for k in range(0, len(html), _PIECE):
            parser.feed(html[k : k + _PIECE])
            found, parser.rows = parser.rows, []
            for r in found:
                if len(r["counts"]) >= LEAST_CELLS:
                    yield page_id, pos, *(r[n] for n in names[2:])
                pos += 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
        for batch in batches:
            for i in range(batch.num_rows):
                for row in rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or ""):
                    out.append(row)
                    if len(out) >= _ROWS_AT_ONCE:
                        yield flush()
                        out.clear()
        yield flush()

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html").mapInArrow(cut, _CELLS)


def set_identity(pages: DataFrame, known_sets: DataFrame) -> DataFrame:
    """page_id, set_name, release_year: by the heading's id among ``known_sets`` (heading_id, name, year), else by the title."""
    title = F.regexp_replace(F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)), r"\s*[|–—]\s*PSA.*$", "")
    heading = F.regexp_extract("html", r'"headingID":\s*([0-9]+)', 1)
    p = pages.select("page_id", title.alias("title"), heading.alias("heading_id")).join(known_sets.select(F.col("heading_id").cast("string").alias("heading_id"), "name", "year"), "heading_id", "left")
    forms = (r"^([0-9]{4})\s+(.+?)\s+TCG Cards", r"^([0-9]{4})\s+(.+?)\s+(?:Non-Sport\s+)?Cards")
    named = lambda n: F.when(F.startswith(n, F.lit("Pokemon")), n).otherwise(F.concat(F.lit("Pokemon "), n))
    part = lambda k: F.coalesce(*[F.when(F.regexp_extract("title", f, k) != "", F.regexp_extract("title", f, k)) for f in forms])
    start = F.regexp_extract("title", r"^([0-9]{4})", 1)
    year = F.when(F.col("name").isNotNull(), F.coalesce(F.when(F.col("year").cast("string") != "", F.col("year").cast("string")), start)).otherwise(F.coalesce(part(1), F.lit("")))
    return p.select("page_id", F.coalesce("name", named(part(2)), "title").alias("set_name"), year.alias("release_year"))


def _counted(cells: DataFrame, sets: DataFrame, day: dt.date) -> DataFrame:
    counts = [count_cell(F.coalesce(F.get("counts", F.lit(k + FIRST_GRADE_CELL)), F.lit(""))).cast("int").alias(g) for k, g in enumerate(GRADES)]
    j = cells.join(sets, "page_id").select("page_id", "pos", "set_name", "release_year", "number", "strong", "after_break", "spec_id", "name_text", *counts)
    return j.withColumn("gem_rate", gem_rate(F.col("psa_10"), F.col("total_graded")).cast("decimal(5,2)")).withColumn("day", F.lit(day).cast("date"))


def population_rows(cells: DataFrame, sets: DataFrame, day: dt.date, *, keep_foreign: bool = False) -> DataFrame:
    """One row per item of the report; rows without number or name aren't items; foreign variants go unless kept."""
    variant = F.trim(F.replace("after_break", F.lit("Shop with Affiliates"), F.lit("")))
    rows = _counted(cells, sets, day).where("number <> '' and strong <> ''").withColumn("variant", variant)
    rows = rows if keep_foreign else rows.where(~is_foreign(F.col("variant")))
    full = F.when(F.col("variant") != "", F.concat(F.col("strong"), F.lit(" ("), F.col("variant"), F.lit(")"))).otherwise(F.col("strong"))
    return rows.select("set_name", "release_year", F.col("number").alias("card_number"), F.col("strong").alias("card_name"), "variant", full.alias("full_name"), F.col("spec_id").alias("psa_spec_id"), *GRADES, "gem_rate", F.col("day").alias("scraped_date"))


def reported_totals(cells: DataFrame, sets: DataFrame, day: dt.date) -> DataFrame:
    """Set totals from the report's own total row."""
    rows = _counted(cells, sets, day).where((F.col("number") == "") & F.contains(F.upper("name_text"), F.lit("TOTAL POPULATION")))
    return rows.select("set_name", "release_year", "total_graded", F.col("psa_10").alias("total_psa_10"), F.col("psa_9").alias("total_psa_9"), F.col("psa_8").alias("total_psa_8"), "gem_rate", F.col("day").alias("snapshot_date"))


def set_totals(population: DataFrame) -> DataFrame:
    """Totals by set from item rows."""
    out = population.groupBy("set_name").agg(F.sum("total_graded").alias("total_graded"), *[F.sum(f"psa_{g}").alias(f"total_psa_{g}") for g in (10, 9, 8)])
    return out.withColumn("gem_rate", gem_rate(F.col("total_psa_10"), F.col("total_graded")))


def snapshot(population: DataFrame, day: dt.date) -> DataFrame:
    """History rows of graded items."""
    keys = [c for c in ("set_name", "card_number", "card_name", "variant") if c in population.columns]
    return population.where("total_graded > 0").select(*keys, "psa_8", "psa_9", "psa_10", "total_graded", gem_rate(F.col("psa_10"), F.col("total_graded")).alias("gem_rate"), F.lit(day).cast("date").alias("snapshot_date"))


def top_of_sets(population: DataFrame, n: int = 5) -> DataFrame:
    """The n most graded items of each set with the set's total; a ranked filter, so each task sends at most n rows a set."""
    own = W.partitionBy("set_name")
    rank = F.row_number().over(own.orderBy(F.desc("total_graded"), "card_number"))
    totals = population.groupBy("set_name").agg(F.sum("total_graded").alias("set_total"))
    return population.withColumn("rank", rank).where(F.col("rank") <= n).join(totals, "set_name").select("set_name", "rank", "card_number", "card_name", "total_graded", "set_total")


def text_report(reports: DataFrame) -> DataFrame:
    """(set_name, text) of text reports to item rows.

    A block starts with a line of number, tab and name; after the variant and the labels Grade, + and Q come 39 values, of which every third,
    from the first, is a grade's count. Blocks with fewer values, and the block of totals, give nothing.
    """
    blocks = F.split(F.concat(F.lit("\n"), F.regexp_replace("text", r"\r", "")), r"\n(?=\s*(?:[0-9]+\t|TOTAL POPULATION))")
    return report_items(reports.select("set_name", F.posexplode(blocks).alias("pos", "block")))


def report_items(blocks: DataFrame) -> DataFrame:
    """Item rows of blocks (set_name, pos, block) of text reports, however they were cut."""
    rows = blocks.where(F.rlike(F.ltrim("block"), F.lit(r"^[0-9]+\t")))
    lines = F.transform(F.split(F.trim("block"), "\n"), lambda v: F.trim(v))
    rows = rows.select("set_name", "pos", lines.alias("lines"))
    clean = lambda v: F.trim(F.replace(v, F.lit("Shop with Affiliates"), F.lit("")))
    label = F.coalesce(F.array_position("lines", "Grade"), F.lit(0))
    head = F.element_at("lines", 1)
    rows = rows.withColumn("at", label).withColumn("card_number", F.regexp_extract(head, r"^([0-9]+)\t", 1)).withColumn("card_name", clean(F.regexp_replace(head, r"^[0-9]+\t", "")))
    rows = rows.withColumn("variant", F.array_join(F.filter(F.transform(F.slice("lines", F.lit(2), F.greatest(F.lit(0), F.col("at") - 2)), clean), lambda v: v != ""), " "))
    rest = F.filter(F.slice("lines", F.greatest(F.lit(1), F.col("at")), F.size("lines")), lambda v: ~v.isin("Grade", "+", "Q"))
    rows = rows.withColumn("values", F.transform(rest, report_count)).where("at > 0 and size(values) >= 39 and not exists(slice(values, 1, 39), v -> v is null)")
    counts = [F.get("values", F.lit(3 * k)).alias(g) for k, g in enumerate(GRADES)]
    full = F.when(F.col("variant") != "", F.concat("card_name", F.lit(" ("), "variant", F.lit(")"))).otherwise(F.col("card_name"))
    out = rows.select("set_name", "card_number", "card_name", "variant", full.alias("full_name"), *counts)
    return out.withColumn("gem_rate", gem_rate(F.col("psa_10"), F.col("total_graded")))
