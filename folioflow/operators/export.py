"""Elements to Markdown documents and numbered artifacts.

Whether an element glues to the section before it depends on the element before
it on its page: one lag. A section then knows its own separator, so a document
is one ordered string aggregation; islands of glued sections are a running sum.
Image numbers are the rank of first use over the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.arrow import column, once
from ..functions.exams import maybe_exam, question_layout
from ..functions.markup import image_sources, with_sources
from ..functions.mathtext import cell_markdown, escape_cell, strip, tidy_inline
from ..schema import IGNORED_KINDS, TITLE_KINDS
from .normalize import page_order

_tidied = column(tidy_inline, "string")
_cell = column(cell_markdown, "string")
_math_cells = column(lambda rows: [[cell_markdown(c) for c in r] for r in rows], "array<array<string>>")

# Characters that need no blank before them.
CLINGS = r"^[.,;:!?]"


def tidied(text: Column) -> Column:
    """text with its inline math trimmed and set off; only texts with a dollar leave the JVM."""
    return F.coalesce(_tidied(F.when(text.contains("$"), text)), text)


def cell(text: Column) -> Column:
    """A cell's Markdown, null where its math can't stand in a cell; only texts with a dollar leave the JVM."""
    return F.when(text.contains("$"), _cell(F.when(text.contains("$"), text))).otherwise(escape_cell(text))


def rendered_cells(rows: Column) -> Column:
    """Rows with each cell as Markdown, null where one can't be; only tables with a dollar leave the JVM."""
    math = F.array_join(F.flatten(rows), "").contains("$")
    return F.when(math, _math_cells(F.when(math, rows))).otherwise(F.transform(rows, lambda r: F.transform(r, escape_cell)))


def mapped_sources(markup: Column, targets: Column) -> Column:
    """markup with its image sources mapped; only markup with images and a map leaves the JVM."""
    touched = targets.isNotNull() & F.lower(markup).contains("<img")
    return F.coalesce(with_sources(F.when(touched, markup), targets), markup)


def exam_layout(markup: Column) -> Column:
    """The layout of an exam table, else null; only markup that may be one leaves the JVM."""
    return question_layout(F.when(maybe_exam(markup), markup))


def table_markdown(table: Column, cells: Column | None = None) -> Column:
    """A table struct's Markdown; its HTML if it has no plain rows or a cell can't be Markdown.

    cells: the rows with each cell rendered, or null, if already at hand."""
    return once(rendered_cells(table["rows"]) if cells is None else cells, lambda c: _table_lines(table, c))


def _table_lines(table: Column, cells: Column) -> Column:
    line = lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |"))
    plain = cells.isNotNull() & ~table["has_merged_cells"] & ~F.exists(cells, lambda r: F.exists(r, lambda c: c.isNull()))
    width = F.size(F.get(cells, F.lit(0)))
    head = F.when(table["has_header"], F.get(cells, F.lit(0))).otherwise(F.array_repeat(F.lit(""), width))
    body = F.when(table["has_header"], F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))).otherwise(cells)
    lines = F.concat(F.array(line(head), line(F.array_repeat(F.lit("---"), width))), F.transform(body, line))
    return F.when(plain, F.array_join(lines, "\n")).otherwise(table["html"])


def rendered(content: Column, kind: Column, placement: Column, tidy: Column) -> Column:
    """A text element's section: formulas in dollars, bare titles marked, the rest with tidy math."""
    return (
        F.when(placement == "inline", F.concat(F.lit("$"), content, F.lit("$")))
        .when(placement == "display", F.concat(F.lit("$$\n"), content, F.lit("\n$$")))
        .when(kind.isin(*TITLE_KINDS) & ~tidy.startswith("#"), F.concat(F.lit("## "), tidy))
        .otherwise(tidy)
    )


def _markup(elements: DataFrame) -> DataFrame:
    shown = elements.withColumn("_text", strip(F.coalesce("content", F.lit(""))))
    return shown.withColumn("_markup", F.when(F.col("kind") == "table", F.coalesce("table.html", "content")).when(F.lower("_text").contains("<img"), F.col("_text")))


def image_uses(elements: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord, pos, path): images in order of use; path is null for an element's own pixels."""
    keys = ["doc_id", "page_no", "ord"]
    shown = _markup(elements.where(~F.col("kind").isin(*IGNORED_KINDS)))
    use = lambda pos, path: F.struct(pos.cast("int").alias("pos"), path.cast("string").alias("path"))
    own = (F.col("kind") != "table") & F.col("image_png").isNotNull()
    named = shown.select(*keys, own.alias("_own"), image_sources(F.when(F.lower("_markup").contains("<img"), F.col("_markup"))).alias("_sources"))
    uses = F.concat(F.transform(F.coalesce("_sources", F.array().cast("array<string>")), lambda s, i: use(i, s)), F.when(F.col("_own"), F.array(use(F.lit(1 << 30), F.lit(None)))).otherwise(F.array().cast("array<struct<pos:int,path:string>>")))
    return named.select(*keys, F.explode_outer(uses).alias("u")).where("u IS NOT NULL").select(*keys, "u.*")


def number_images(uses: DataFrame) -> DataFrame:
    """uses with image_no: one counter a document; an embedded path keeps the number of its first use."""
    first = F.when(F.col("path").isNotNull(), F.min(F.struct("page_no", "ord", "pos")).over(W.partitionBy("doc_id", "path"))).otherwise(F.struct("page_no", "ord", "pos"))
    return uses.withColumn("_first", first).withColumn("image_no", (F.dense_rank().over(W.partitionBy("doc_id").orderBy("_first")) - 1).cast("int")).drop("_first")


def number_tables(elements: DataFrame) -> DataFrame:
    """Table elements with table_no, counted through their document."""
    order = W.partitionBy("doc_id").orderBy("page_no", "ord")
    return elements.where("kind = 'table'").withColumn("table_no", (F.row_number().over(order) - 1).cast("int"))


def resolve_images(uses: DataFrame, assets: DataFrame) -> DataFrame:
    """Numbered embedded uses with their pixels; error where an asset is missing. Assets are never broadcast."""
    wanted = uses.where("path IS NOT NULL").select("doc_id", "path", "image_no").distinct()
    found = wanted.join(assets, ["doc_id", "path"], "left")
    return found.withColumn("error", F.when(F.col("png").isNull(), F.concat(F.lit("Embedded image has no pixels: "), "path")))


def image_artifacts(elements: DataFrame, assets: DataFrame) -> DataFrame:
    """(doc_id, name, png): every image file of every document."""
    uses = number_images(image_uses(elements))
    own = uses.where("path IS NULL").join(elements.select("doc_id", "page_no", "ord", "image_png"), ["doc_id", "page_no", "ord"]).select("doc_id", "image_no", F.col("image_png").alias("png"))
    both = own.unionByName(resolve_images(uses, assets).where("error IS NULL").select("doc_id", "image_no", "png"))
    return both.select("doc_id", F.concat(F.lit("img-"), F.col("image_no").cast("string"), F.lit(".png")).alias("name"), "png")


def _targets(uses: DataFrame, prefix: str, out: str) -> DataFrame:
    name = F.concat(F.lit(prefix + "img-"), F.col("image_no").cast("string"), F.lit(".png"))
    return uses.where("path IS NOT NULL").groupBy("doc_id", "page_no", "ord").agg(F.map_from_entries(F.collect_set(F.struct("path", name.alias("name")))).alias(out))


def table_artifacts(elements: DataFrame) -> DataFrame:
    """(doc_id, page_no, ord, name, html): every table file, its images one folder up."""
    maps = _targets(number_images(image_uses(elements)), "../images/", "_map")
    tables = _markup(number_tables(elements)).join(maps, ["doc_id", "page_no", "ord"], "left")
    return tables.select("doc_id", "page_no", "ord", F.concat(F.lit("tbl-"), F.col("table_no").cast("string"), F.lit(".html")).alias("name"), mapped_sources(F.col("_markup"), F.col("_map")).alias("html"))


def flags(elements: DataFrame) -> DataFrame:
    """elements with glues: whether what they emit joins the section before it, by the element before on their page."""
    ignored = F.col("kind").isin(*IGNORED_KINDS)
    text = strip(F.coalesce("content", F.lit("")))
    grouped = F.col("option_group").isNotNull() & (F.col("kind") != "table") & F.col("image_png").isNull() & (text != "")
    clears = ignored | grouped
    inline = F.coalesce(F.col("formula_placement") == "inline", F.lit(False))
    before = lambda c: F.coalesce(F.lag(~clears & c).over(page_order()), F.lit(False))
    told = elements.withColumn("_after_inline", before(inline)).withColumn("_after_text", before(F.col("kind") == "text"))
    own = (F.col("kind") != "table") & F.col("image_png").isNull() & F.col("option_group").isNull()
    glues = own & ((inline & (F.col("_after_text") | F.col("_after_inline"))) | ((F.col("kind") == "text") & F.col("_after_inline")))
    return told.withColumn("glues", glues).drop("_after_inline", "_after_text")


def sections(elements: DataFrame, question_layouts: bool = True) -> DataFrame:
    """(doc_id, page_no, ord, sub, glues, text): what each element emits, in order."""
    return _emitted(elements, question_layouts).where("sub IS NOT NULL")


def _emitted(elements: DataFrame, question_layouts: bool) -> DataFrame:
    """sections(), and a row with a null sub for each element that emits nothing."""
    keys = ["doc_id", "page_no", "ord"]
    name = F.concat(F.lit("images/img-"), F.col("image_no").cast("string"), F.lit(".png"))
    names = F.collect_set(F.when(F.col("path").isNotNull(), F.struct("path", name.alias("name"))))
    used = number_images(image_uses(elements)).groupBy(*keys).agg(F.when(F.size(names) > 0, F.map_from_entries(names)).alias("_map"), F.max(F.when(F.col("path").isNull(), F.col("image_no"))).alias("_own"))
    # The document's order first: pages are then in place for their own windows.
    order = W.partitionBy("doc_id").orderBy("page_no", "ord").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = elements.withColumn("table_no", (F.sum(F.when(F.col("kind") == "table", 1).otherwise(0)).over(order) - 1).cast("int"))
    hidden = F.col("kind").isin(*IGNORED_KINDS)
    rows = _markup(flags(counted)).join(used, keys, "left")
    is_table = (F.col("kind") == "table") & ~hidden
    rows = rows.withColumn("_shown", F.coalesce(mapped_sources(F.col("_markup"), F.col("_map")), "_text")).withColumn("_group", F.when(F.col("_own").isNull() & ~is_table, F.col("option_group")))
    rows = rows.withColumn("_layout", exam_layout(F.when(is_table, F.col("_shown"))) if question_layouts else F.lit(None).cast("struct<markdown:string>"))
    rows = rows.withColumn("_cells", rendered_cells(F.when(is_table & F.col("_layout").isNull(), F.col("table.rows"))))
    rows = rows.withColumn("_plain", F.when(is_table & F.col("_layout").isNull() & F.col("table").isNotNull(), table_markdown(F.col("table"), F.col("_cells"))))
    # The map rewrites again what a cell's text decodes to.
    rows = rows.withColumn("_table", F.coalesce("_layout.markdown", mapped_sources(F.col("_plain"), F.col("_map")), "_shown"))
    options = F.transform("_group.options", lambda o: F.concat(o["label"], F.lit(" "), o["content"]))
    rows = rows.withColumn("_options", F.concat(F.filter(F.array("_group.question"), lambda q: q != ""), options))
    rows = rows.withColumn("_options", F.coalesce(_tidied_all(F.when(F.exists("_options", lambda o: o.contains("$")), F.col("_options"))), "_options"))
    rows = rows.withColumn("_tidy", tidied(F.when(~is_table & F.col("_group").isNull(), F.col("_shown"))))
    digit = lambda c: c.cast("string")
    link = F.concat(F.lit("[Table "), digit(F.col("table_no") + 1), F.lit("](tables/tbl-"), digit(F.col("table_no")), F.lit(".html)"))
    image = F.concat(F.lit("![Image "), digit(F.col("_own") + 1), F.lit("](images/img-"), digit(F.col("_own")), F.lit(".png)"))
    emitted = (
        F.when(hidden, F.array().cast("array<string>"))
        .when(is_table, F.array("_table", link))
        .when(F.col("_own").isNotNull(), F.when(F.col("_shown") == "", F.array(image)).otherwise(F.array(image, F.col("_shown"))))
        .when(F.col("_shown") == "", F.array().cast("array<string>"))
        .when(F.col("_group").isNotNull(), F.col("_options"))
        .otherwise(F.array(rendered(F.col("_shown"), F.col("kind"), F.col("formula_placement"), F.col("_tidy"))))
    )
    # An outer generator: a plain one would evaluate its argument twice more, in filters that Catalyst infers from it.
    return rows.select(*keys, "glues", F.posexplode_outer(emitted).alias("sub", "text"))


_tidied_all = column(lambda texts: [tidy_inline(t) for t in texts], "array<string>")


def separated(parts: DataFrame) -> DataFrame:
    """sections with separator: nothing or a blank where they glue, else a blank line."""
    return parts.withColumn("separator", F.when(F.col("glues") & (F.col("sub") == 0), F.when(F.col("text").rlike(CLINGS), "").otherwise(" ")).otherwise("\n\n"))


def islands(parts: DataFrame) -> DataFrame:
    """sections with section_no: glued ones share a number within their document."""
    order = W.partitionBy("doc_id").orderBy("page_no", "ord", "sub")
    new = F.when(F.col("glues") & (F.col("sub") == 0) & (F.row_number().over(order) > 1), 0).otherwise(1)
    return parts.withColumn("_new", new).withColumn("section_no", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int")).drop("_new")


def markdown(elements: DataFrame, question_layouts: bool = True) -> DataFrame:
    """(doc_id, markdown): one row a document; a document without sections is a single newline."""
    parts = separated(_emitted(elements, question_layouts))
    # One pre-sorted array of strings a document: the first separator falls away.
    texts = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("sub").isNotNull(), F.struct("page_no", "ord", "sub", "separator", "text")))).alias("s"))
    joined = F.array_join(F.transform("s", lambda x, i: F.concat(F.when(i == 0, "").otherwise(x["separator"]), x["text"])), "")
    return texts.select("doc_id", F.concat(joined, F.lit("\n")).alias("markdown"))


def layout_report(elements: DataFrame) -> DataFrame:
    """(doc_id, page, table, converted, warnings, repairs) of every table."""
    keys = ["doc_id", "page_no", "ord"]
    maps = _targets(number_images(image_uses(elements)), "images/", "_map")
    rows = _markup(number_tables(elements)).join(maps, keys, "left")
    rows = rows.withColumn("_layout", exam_layout(mapped_sources(F.col("_markup"), F.col("_map"))))
    none = F.array().cast("array<string>")
    return rows.select("doc_id", F.col("page_no").alias("page"), F.concat(F.lit("tbl-"), F.col("table_no").cast("string"), F.lit(".html")).alias("table"), F.col("_layout").isNotNull().alias("converted"), F.coalesce("_layout.warnings", none).alias("warnings"), F.coalesce("_layout.repairs", none).alias("repairs"))


def debug_elements(elements: DataFrame, engine: str) -> DataFrame:
    """The debug view of elements; server addresses never reach it."""
    return elements.select(
        "doc_id", F.col("page_no").alias("page"), F.col("ord").alias("order"), "kind", F.col("kind").alias("label"), "bbox", "content", F.lit(engine).alias("source"), "formula_placement", "option_group",
        F.col("table.has_merged_cells").alias("has_merged_cells"), F.col("image_png").isNotNull().alias("has_image"), (~F.col("kind").isin(*IGNORED_KINDS)).alias("included_in_markdown"),
    )


def watermark_json(report: DataFrame, mode: str, documents: DataFrame | None = None) -> DataFrame:
    """(doc_id, json): each document's report; NaN never occurs, as boxes are validated.

    documents: (doc_id) of those that get one, without candidates too; else those that have some."""
    rows = report.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "block_index", "kind", "bbox", "phrase", "repetitions", "content", "decision", "reason"))).alias("candidates"))
    if documents is not None:
        rows = documents.join(rows, "doc_id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(rows.schema["candidates"].dataType)))
    return rows.select("doc_id", F.to_json(F.struct(F.lit(1).alias("schema_version"), F.lit(mode).alias("mode"), F.lit("original page pixels, top-left origin").alias("bbox_coordinates"), "candidates")).alias("json"))
