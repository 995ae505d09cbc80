"""Raw blocks to elements: headings, formulas, tables, pictures, answer options.

Everything but the table reader is a Column expression. Neighbours and carried
state are one window by (doc_id, page_no) in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.mathtext import WS, mask_math, strip
from ..functions.markup import table_content
from ..schema import FORMULA_KINDS, IGNORED_KINDS, PICTURE_KINDS

# Delimiters of a formula, in the order they are tried.
DELIMITERS = (("$$", "$$"), (r"\[", r"\]"), (r"\(", r"\)"), ("$", "$"))
# Question and option markers. The first needs its Q, the second doesn't.
QUESTION = rf"(?dmiU)^[{WS}]*(?:Q(?:uestion)?[{WS}]*\d+[{WS}]*[.:])"
NUMBERED = rf"(?dmiU)^[{WS}]*(?:Q(?:uestion)?[{WS}]*)?(\d+)[{WS}]*[.:][{WS}]*"
OPTION = rf"(?U)(?<![^{WS}])\(([1-9])\)(?=[{WS}])"
LOOSE_OPTION = rf"(?U)(?<![^{WS}])\(([1-9])\)"
ANY_TAG = r"</?[A-Za-z][^>]*>"


def page_order():
    """Reading order of a page."""
    return W.partitionBy("doc_id", "page_no").orderBy("ord")


def normalize_formula(content: Column) -> Column:
    """content without blanks around it and without its first matching pair of delimiters."""
    text = strip(content)
    out = None
    for a, b in DELIMITERS:
        inside = strip(F.substring(text, F.lit(len(a) + 1), F.length(text) - len(a) - len(b)))
        hit = text.startswith(a) & text.endswith(b)
        out = F.when(hit, inside) if out is None else out.when(hit, inside)
    return out.otherwise(text)


def heading(kind: Column, content: Column, level: Column) -> Column:
    """content with the heading marks of a title, unless it has some."""
    depth = F.when(kind == "doc_title", 1).otherwise(F.coalesce(level, F.lit(1)) + 1)
    marks = F.repeat(F.lit("#"), F.least(F.lit(6), F.greatest(F.lit(1), depth)).cast("int"))
    return F.when(kind.isin("doc_title", "paragraph_title") & ~content.startswith("#"), F.concat(marks, F.lit(" "), content)).otherwise(content)


def valid_bbox(box: Column) -> Column:
    """The box as a struct if it is four finite numbers with 0 <= l < r and 0 <= t < b, else null."""
    l, t, r, b = (F.get(box, F.lit(i)).cast("double") for i in range(4))
    finite = F.forall(box, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.when((F.size(box) == 4) & finite & (l >= 0) & (l < r) & (t >= 0) & (t < b), F.struct(l.alias("l"), t.alias("t"), r.alias("r"), b.alias("b")))


def _beside(box: Column, label: Column, other: Column) -> Column:
    """Whether text block other is on box's line, at most two of its heights away."""
    height, theirs = box["b"] - box["t"], other["b"] - other["t"]
    overlap = F.least(box["b"], other["b"]) - F.greatest(box["t"], other["t"])
    gap = F.greatest(other["l"] - box["r"], box["l"] - other["r"])
    near = (height > 0) & (theirs > 0) & (overlap >= 0.8 * F.greatest(height, theirs)) & (gap >= 0) & (gap <= 2 * height)
    return F.coalesce((label == "text") & near, F.lit(False))


def formula_placement(blocks: DataFrame) -> DataFrame:
    """blocks with formula_placement: as the kind says, or inline beside text of the same line, else display."""
    inline = F.lit(False)
    for shift in (F.lag, F.lead):
        inline = inline | _beside(F.col("bbox"), shift("kind").over(page_order()), shift("bbox").over(page_order()))
    placed = F.when(F.col("kind") == "inline_formula", "inline").when(F.col("kind") == "display_formula", "display").when(F.col("kind") == "formula", F.when(inline, "inline").otherwise("display"))
    return blocks.withColumn("formula_placement", placed)


def adapt(raw_blocks: DataFrame) -> DataFrame:
    """Elements of raw blocks. A picture without pixels gets an error, and its document's other rows don't."""
    box = lambda b: F.when(b.isNotNull(), F.struct(*[F.get(b, F.lit(i)).cast("double").alias(n) for i, n in enumerate("ltrb")]))
    blocks = raw_blocks.select(
        "doc_id",
        # A missing index is the page's place, never zero.
        (F.coalesce("page_index", "page_pos") + 1).alias("page_no"),
        "ord",
        F.col("label").alias("kind"),
        heading(F.col("label"), F.when(F.col("label").isin(*FORMULA_KINDS), normalize_formula(F.col("content"))).otherwise(F.col("content")), F.col("title_level")).alias("content"),
        box(F.col("bbox")).alias("bbox"),
        F.col("image").alias("image_png"),
    )
    table = table_content(F.when(F.col("kind") == "table", F.col("content")))  # null for the rest: they stay in the JVM
    error = F.when(F.col("kind").isin(*PICTURE_KINDS) & F.col("image_png").isNull(), F.concat(F.lit("image without pixels on page "), F.col("page_no").cast("string")))
    return formula_placement(blocks).withColumn("table", table).withColumn("error", error)


def adapt_alternative(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Elements, with error, of the second engine's items (doc_id, seq, page_no, kind, text, level, marker, bbox bottom-left, png).

    A table's text is its HTML; a generic formula is displayed, as items have no neighbours. Items without provenance go to page 1; an item on an unlisted page keeps a null bbox and an error."""
    kind = F.col("kind")
    text = (
        F.when(kind.isin("title", "section_header"), F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(1)).cast("int")), F.lit(" "), "text"))
        .when(kind == "list_item", F.concat(F.when(F.coalesce("marker", F.lit("")) == "", "-").otherwise(F.col("marker")), F.lit(" "), "text"))
        .when(kind.isin(*FORMULA_KINDS), normalize_formula(F.col("text")))
        .otherwise(F.col("text"))
    )
    placed = items.join(pages.select("doc_id", "page_no", "height"), ["doc_id", "page_no"], "left")
    box = F.when(F.col("page_no").isNotNull() & F.col("height").isNotNull(), F.struct(F.col("bbox.l").alias("l"), (F.col("height") - F.col("bbox.t")).alias("t"), F.col("bbox.r").alias("r"), (F.col("height") - F.col("bbox.b")).alias("b")))
    placement = F.when(kind == "inline_formula", "inline").when(kind.isin("formula", "display_formula"), "display")
    error = F.when((kind == "image") & F.col("png").isNull(), "picture without pixels").when(F.col("page_no").isNotNull() & F.col("height").isNull(), "item on an unlisted page")
    return placed.select("doc_id", F.coalesce("page_no", F.lit(1)).alias("page_no"), F.col("seq").cast("int").alias("ord"), "kind", text.alias("content"), box.alias("bbox"), F.when(kind == "image", F.col("png")).alias("image_png"), placement.alias("formula_placement"), table_content(F.when(kind == "table", F.col("text"))).alias("table"), error.alias("error"))


def ascending(numbers: Column) -> Column:
    """Whether an array's numbers go up at every step."""
    return numbers == F.array_sort(F.array_distinct(numbers))


def with_pages(pages: DataFrame, elements: DataFrame) -> DataFrame:
    """pages (doc_id, page_no) with how many elements each has and the first one's place: pages without any stay."""
    counted = elements.groupBy("doc_id", "page_no").agg(F.count("*").alias("elements"), F.min("ord").alias("first_ord"))
    return pages.join(counted, ["doc_id", "page_no"], "left").withColumn("elements", F.coalesce("elements", F.lit(0).cast("long")))


def failures(elements: DataFrame) -> DataFrame:
    """(doc_id, errors) of documents with elements in error, their messages in reading order."""
    rows = elements.where("error IS NOT NULL").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "ord", "error"))).alias("e"))
    return rows.select("doc_id", F.transform("e", lambda x: x["error"]).alias("errors"))


def markdown_elements(elements: DataFrame) -> DataFrame:
    """Elements that Markdown shows."""
    return elements.where(~F.col("kind").isin(*IGNORED_KINDS))


def _pieces(df: DataFrame, content: str, pattern: str) -> DataFrame:
    """df with the option labels outside math (_labels), the text before the first (_before) and each label's value."""
    masked = df.withColumn("_visible", F.when(~F.col(content).rlike(ANY_TAG), mask_math(F.col(content))))
    cut = masked.withColumn("_gaps", F.split("_visible", pattern, -1)).withColumn("_labels", F.regexp_extract_all("_visible", F.lit(pattern), F.lit(1)).cast("array<int>"))
    # Masking keeps lengths: places found in the masked text cut the text itself.
    sizes = F.transform("_gaps", lambda g: F.length(g))
    start = lambda i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x) + 3 * i
    values = F.transform("_labels", lambda _, i: strip(F.substring(F.col(content), start(i + 1) + 1, F.get(sizes, i + 1))))
    return cut.withColumn("_before", F.substring(F.col(content), F.lit(1), F.get(sizes, F.lit(0)))).withColumn("_values", values)


def recognize_options(df: DataFrame, content: str = "content", follows: Column | None = None, out: str = "option_group") -> DataFrame:
    """df with out: the answer options that content clearly labels (1), (2), ..., else null.

    follows: whether the element before is a bare question."""
    parts = _pieces(df, content, OPTION)
    n = F.size("_labels")
    questions = F.regexp_count("_visible", F.lit(QUESTION))
    asked = (questions == 1) & (F.length(F.get(F.split("_visible", QUESTION, 2), F.lit(0))) < F.length("_before"))
    prefix = strip(F.col("_before"))
    carried = F.lit(False) if follows is None else F.coalesce(follows, F.lit(False))
    set_off = (prefix == "") | prefix.endswith(":") | F.regexp_extract("_before", rf"(?U)[{WS}]*\z", 0).contains("\n")
    good = (
        (n >= 2)
        & (questions <= 1)
        & (asked | (carried & (prefix == "")))
        & set_off
        & (F.get("_labels", F.lit(0)) == 1)
        & (F.array_sort("_labels") == F.sequence(F.lit(1), F.greatest(n, F.lit(1))))
        & ~F.exists("_values", lambda v: v == "")
    )
    options = F.zip_with("_labels", "_values", lambda label, v: F.struct(F.concat(F.lit("("), label.cast("string"), F.lit(")")).alias("label"), v.alias("content")))
    group = F.when(F.col("_visible").isNotNull() & good, F.struct(prefix.alias("question"), options.alias("options")))
    return parts.withColumn(out, group).drop("_visible", "_gaps", "_labels", "_before", "_values")


def normalize_options(elements: DataFrame) -> DataFrame:
    """elements with option_group. A question alone lets the next element give its options: no recursion,
    as a question's own group never depends on the element before it."""
    eligible = (F.col("kind") == "text") & F.col("formula_placement").isNull()
    # Only what may hold labels is looked through.
    texts = elements.drop("option_group").withColumn("_text", F.when(eligible & F.col("content").contains("("), F.col("content")))
    alone = recognize_options(texts, "_text", out="_alone")
    bare = eligible & F.col("content").rlike(QUESTION.replace("(?dmiU)^", r"(?diU)\A")) & F.col("_alone").isNull()
    carried = alone.withColumn("_follows", F.coalesce(F.lag(bare).over(page_order()), F.lit(False)))
    found = recognize_options(carried, "_text", follows=F.col("_follows"), out="option_group")
    return found.drop("_text", "_alone", "_follows")


def parse_options(df: DataFrame, content: str, out: str) -> DataFrame:
    """df with out: label -> value of ascending labels up to 4; an empty map if the text is ambiguous."""
    parts = _pieces(df, content, LOOSE_OPTION)
    labels = F.col("_labels")
    good = F.col("_visible").isNotNull() & ascending(labels) & ~F.exists(labels, lambda x: x > 4) & ~F.exists("_values", lambda v: v == "")
    none = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<string>"))
    return parts.withColumn(out, F.when(good, F.map_from_arrays(labels, F.col("_values"))).otherwise(none)).drop("_visible", "_gaps", "_labels", "_before", "_values")
