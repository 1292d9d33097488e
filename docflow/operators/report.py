"""The index of the registry: counters, cells, rows and pages in HTML, all as projections and one aggregate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import forward_slashes, html_escape, sha_prefix, strip, url_quote
from .registry import by_name

#: Words of the index.
WORDS = {"yes": "כן", "no": "לא", "none": "—", "not_run": "לא הופעל", "skipped": "דילוג (עברית)", "from_translation": "מתוך התרגום לעברית", "from_original": "מתוך המקור העברי", "md_source": "Markdown (אנגלית)", "md_target": "Markdown (עברית)", "already": "כבר בעברית", "error": "שגיאה"}

#: Title, line of the time, and labels of the index's counters and columns.
TITLE = "מאמרים מתורגמים"
MADE_AT = "נוצר אוטומטית ב-"
COUNTERS = {"total": 'סה"כ מסמכים', "translated": "תורגמו לעברית", "already": "כבר בעברית", "errors": "שגיאות", "pending": "ממתינים", "ocr": "עברו OCR", "summaries": "עם תקציר עברי"}
COLUMNS = ("מסמך מקור (PDF)", "תקציר קצר", "שלב 1: Markdown באנגלית", "שלב 2: Markdown בעברית", "עמודים", "תמונות", "שפת מקור", "OCR", "שלב 1 (חילוץ)", "שלב 2 (תרגום)")

PLAIN_COLUMNS = ("מסמך מקור", "תרגום", "מכיל תמונות", "מספר עמודים", "שפת מקור", "תורגם ב-")


def _at(step: Column, name: str) -> Column:
    return F.coalesce(step[name], F.lit(""))


def yes_no(b: Column) -> Column:
    return F.when(b, WORDS["yes"]).when(~b, WORDS["no"]).otherwise(WORDS["none"])


def status_class(status: Column, error: Column, present: Column, success: tuple[str, ...]) -> Column:
    """pending, ok, skip, err or warn."""
    return F.when(~present, "pending").when(status.isin(*success), "ok").when(status == "already_hebrew", "skip").when((F.coalesce(error, F.lit("")) != "") | (status == "error"), "err").otherwise("warn")


def status_pill(step: Column, success: tuple[str, ...]) -> Column:
    kind = status_class(step["status"], step["error"], step.isNotNull(), success)
    label = html_escape(F.coalesce(F.nullif(step["status"], F.lit("")), F.lit(WORDS["none"])))
    title = html_escape(F.coalesce(F.nullif(step["error"], F.lit("")), step["status"], F.lit("")))
    text = F.when(kind == "pending", WORDS["not_run"]).when(kind == "skip", WORDS["skipped"]).otherwise(label)
    return F.concat(F.lit('<span class="pill '), kind, F.lit('"'), F.when(kind == "err", F.concat(F.lit(' title="'), title, F.lit('"'))).otherwise(""), F.lit(">"), text, F.lit("</span>"))


def href(path: Column) -> Column:
    return url_quote(forward_slashes(path), "/")


def file_link(path: Column, label: Column, exists: Column) -> Column:
    missing = F.concat(F.lit('<span class="missing" title="missing on disk">'), html_escape(label), F.lit("</span>"))
    link = F.concat(F.lit('<a href="'), html_escape(href(path)), F.lit('">'), html_escape(label), F.lit("</a>"))
    return F.when(F.coalesce(path, F.lit("")) == "", WORDS["none"]).when(~F.coalesce(exists, F.lit(False)), missing).otherwise(link)


def summary_cell(summary: Column) -> Column:
    text = strip(_at(summary, "text"))
    kind = _at(summary, "source_kind")
    label = F.when(kind == "translated_md", WORDS["from_translation"]).when(kind == "step1_md_hebrew", WORDS["from_original"]).otherwise(kind)
    title = F.concat(label, F.when(_at(summary, "at") != "", F.concat(F.lit(" · "), summary["at"])).otherwise(""))
    full = F.concat(F.lit('<td class="summary-cell"><div class="summary-text" lang="he" dir="rtl">'), html_escape(text), F.lit('</div><div class="summary-meta" title="'), html_escape(title), F.lit('">'), html_escape(label), F.lit("</div></td>"))
    return F.when(text == "", f'<td class="summary-cell"><span class="missing">{WORDS["none"]}</span></td>').otherwise(full)


def counters(registry: DataFrame) -> DataFrame:
    """One row: total, translated, already, errors, pending, ocr, summaries."""
    status = F.col("translation_md")["status"]
    one = registry.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "done").alias("translated"),
        F.count_if(status == "already_hebrew").alias("already"),
        F.count_if(status == "error").alias("errors"),
        F.count_if(F.col("step1")["mode"] == "ocr").alias("ocr"),
        F.count_if(F.length(F.col("summary")["text"]) > 0).alias("summaries"),
    )
    return one.withColumn("pending", F.col("total") - F.col("translated") - F.col("already") - F.col("errors"))


def index_rows(registry: DataFrame, listing: DataFrame, source_dir: str = "to_translate") -> DataFrame:
    """(original_name, sha256, row): a table row per entry. listing has the paths that exist."""
    paths = {"_original": F.concat(F.lit(source_dir + "/"), F.coalesce("original_name", F.lit("?"))), "_md": F.col("step1")["md_relpath"], "_target": F.col("translation_md")["translated_md_relpath"]}
    df = registry.withColumns(paths)
    for name in paths:
        here = listing.select(F.col("path").alias(f"{name}_path")).distinct().withColumn(f"{name}_here", F.lit(True))
        df = df.join(here, F.col(name) == F.col(f"{name}_path"), "left")
    step1, translation = F.col("step1"), F.col("translation_md")
    none = F.lit(WORDS["none"])
    pictures = F.when(F.col("has_pictures") & (F.coalesce(step1["image_count"], F.lit(0)) > 0), F.concat(F.lit(WORDS["yes"] + " ("), step1["image_count"], F.lit(")"))).otherwise(yes_no(F.col("has_pictures")))
    ocr = F.when(step1["mode"] == "ocr", F.concat(F.lit('<span class="pill warn" title="text-layer chars='), F.coalesce(F.col("text_layer_chars").cast("string"), F.lit("None")), F.lit('">OCR</span>'))).otherwise(none)
    td = lambda *c, kind="": F.concat(F.lit(f"<td{kind}>"), *c, F.lit("</td>"))
    when = lambda step: F.concat(F.lit('<div class="when">'), html_escape(F.coalesce(step["at"], none)), F.lit("</div>"))
    row = F.concat(
        F.lit("<tr>"),
        td(file_link(F.col("_original"), F.coalesce("original_name", F.lit("?")), F.col("_original_here")), F.lit('<div class="sha">'), html_escape(sha_prefix(F.col("sha256"))), F.lit("</div>")),
        summary_cell(F.col("summary")),
        td(file_link(F.col("_md"), F.lit(WORDS["md_source"]), F.col("_md_here"))),
        td(file_link(F.col("_target"), F.lit(WORDS["md_target"]), F.col("_target_here"))),
        td(F.coalesce(F.col("page_count").cast("string"), none), kind=' class="num"'),
        td(pictures),
        td(html_escape(F.coalesce(F.nullif(F.col("source_lang"), F.lit("")), none))),
        td(ocr),
        td(status_pill(step1, ("done",)), when(step1)),
        td(status_pill(translation, ("done", "already_hebrew")), when(translation)),
        F.lit("</tr>"),
    )
    return by_name(df.select("original_name", "sha256", row.alias("row")))


def plain_rows(registry: DataFrame) -> DataFrame:
    """The rows of the smaller index, of documents kept as DOCX."""
    d = F.col("translation_docx")
    original = F.when(_at(d, "original_relpath") != "", F.concat(F.lit('<a href="'), html_escape(d["original_relpath"]), F.lit('">'), html_escape(F.col("original_name")), F.lit("</a>"))).otherwise(html_escape(F.col("original_name")))
    link = F.when((d["status"] == "translated") & (_at(d, "translated_relpath") != ""), F.concat(F.lit('<a href="'), html_escape(d["translated_relpath"]), F.lit('">DOCX</a>')))
    link = link.when(d["status"] == "already_hebrew", f"<em>{WORDS['already']}</em>").when(d["status"] == "error", F.concat(F.lit(f'<span class="err">{WORDS["error"]}: '), html_escape(F.coalesce(F.nullif(d["error"], F.lit("")), F.lit("unknown error"))), F.lit("</span>"))).otherwise(WORDS["none"])
    cells = [original, link, F.when(F.col("has_pictures"), WORDS["yes"]).otherwise(WORDS["no"]), F.coalesce(F.col("page_count"), F.lit(0)).cast("string"), html_escape(F.coalesce("source_lang", F.lit(""))), html_escape(_at(d, "translated_at"))]
    row = F.concat(F.lit("<tr>"), *(x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))), F.lit("</tr>"))
    return by_name(registry.select("original_name", "sha256", row.alias("row")))


PAGE_ROWS = 1000


def numbered(rows: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rows (original_name, sha256, ...) with number, from 0 in order of names: dealt out by ranges of names, numbered within each,
    and moved on by the counts of the ranges before, one number for each partition."""
    order = [F.lower(F.coalesce("original_name", F.lit(""))), F.col("sha256")]
    ranged = store(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy(part.alias("part")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    offset = F.broadcast(rows.sparkSession.createDataFrame(offsets, "_part long, _before long"))  # a row for each partition
    return ranged.join(offset, part == F.col("_part")).withColumn("number", F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)).drop("_part", "_before", "_at")


def pages(rows: DataFrame, counts: DataFrame | None, at: str, store: Callable[[DataFrame], DataFrame], name: str = "index.html", per_page: int = PAGE_ROWS, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(path, content): the index in files of per_page rows (original_name, sha256, row) in order, each with links to the one before
    and the one after. The first has the name, the others the name and their number. Only counters reach the driver."""
    own = numbered(rows.select("original_name", "sha256", "row"), store).withColumn("page", F.floor(F.col("number") / per_page) + 1)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "row"))), lambda x: x["row"]), "\n")  # of per_page rows
    made = own.groupBy("page").agg(body.alias("body"))
    last = max(1, -(-rows.count() // per_page))
    made = made if last > 1 or not rows.isEmpty() else rows.sparkSession.createDataFrame([(1, "")], "page long, body string")
    base, dot, kind = name.rpartition(".")
    file = lambda n: F.when(n == 1, name).otherwise(F.concat(F.lit(f"{base if dot else kind}-"), n.cast("string"), F.lit(f".{kind}" if dot else "")))
    link = lambda n, sign, there: F.when(there, F.concat(F.lit('<a href="'), html_escape(href(file(n))), F.lit(f'">{sign}</a> '))).otherwise("")
    n = F.col("page")
    links = F.concat(F.lit('<div class="pages">'), link(n - 1, "&lsaquo;", n > 1), n.cast("string"), F.lit(f" / {last} "), link(n + 1, "&rsaquo;", n < last), F.lit("</div>"))
    top, bottom = _frame({} if counts is None else counts.first().asDict(), at, columns)
    return made.select(file(n).alias("path"), F.concat(F.lit(top), F.col("body"), F.lit("\n</tbody>\n</table>\n"), links, F.lit(bottom)).alias("content"))


def page(rows: DataFrame, counts: DataFrame | None, at: str, columns: tuple[str, ...] = COLUMNS) -> str:
    """The HTML page: counters, a header row and the rows in order, streamed to the driver. One page is a driver's object by nature."""
    body = "\n".join(r.row for r in rows.toLocalIterator())
    top, bottom = _frame({} if counts is None else counts.first().asDict(), at, columns)
    return f"{top}{body}\n</tbody>\n</table>{bottom}"


def _frame(got: dict, at: str, columns: tuple[str, ...]) -> tuple[str, str]:
    """What stands before an index's rows and after its table."""
    head = "".join(f"<div><strong>{got[k]}</strong>{label}</div>" for k, label in COUNTERS.items() if k in got)
    names = "".join(f"<th>{c}</th>" for c in columns)
    return (
        f'<!DOCTYPE html>\n<html lang="he" dir="rtl"><head><meta charset="utf-8"><title>{TITLE}</title></head>\n<body>\n<h1>{TITLE}</h1>\n<p class="subtitle">{MADE_AT}{at}</p>\n'
        f'<div class="summary">{head}</div>\n<table>\n<thead><tr class="head">{names}</tr></thead>\n<tbody>\n'
    ), "</body></html>\n"
