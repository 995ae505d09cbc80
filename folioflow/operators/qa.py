"""Checks of extracted question papers, one row a document and check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Headings, options and the patterns that six questions must hold.
HEADING = r"(?dmU)^\s*(?:#+\s*)?Q\s*(\d+)\s*[.:]"
LABELS = r"(?U)(?<!\w)\(([1-4])\)(?=\s|$)"
OPTION_QUESTIONS = (1, 8, 15)
REQUIRED = {
    "Q2 bounds": (2, (r"\b1600\b", r"\b1800\b")),
    "Q3 formula": (3, (r"\\frac", r"\\sqrt")),
    "Q4 pi/2": (4, (r"(?:\\[dt]?frac\s*\{\s*\\pi\s*\}\s*\{\s*2\s*\}|π\s*/\s*2|\\pi\s*/\s*2)",)),
    "Q6 digit restriction": (6, (r"digits?\s*\$?\s*1\s*,\s*2\s*(?:,\s*(?:and\s*)?|and\s*)3", r"\bonly\b")),
    "Q11 matrix": (11, (r"\\begin\{(?:bmatrix|pmatrix|matrix|array)\}",)),
    "Q14 determinant": (14, (r"\\begin\{vmatrix\}",)),
}
MARK = r"(?i)MathonGo"


def question_bodies(documents: DataFrame) -> DataFrame:
    """(doc_id, question, body): texts under each heading; those of a repeated number in order."""
    parts = documents.select("doc_id", F.split("markdown", HEADING, -1).alias("p"), F.regexp_extract_all("markdown", F.lit(HEADING), F.lit(1)).cast("array<int>").alias("n"))
    rows = parts.select("doc_id", F.posexplode("n").alias("at", "question"), "p").select("doc_id", "question", "at", F.get("p", F.col("at") + 1).alias("body"))
    return rows.groupBy("doc_id", "question").agg(F.expr("listagg(body) WITHIN GROUP (ORDER BY at)").alias("body"))


def checks(documents: DataFrame, max_watermarks: int = 0) -> DataFrame:
    """(doc_id, check, passed) for every check, and check 'all'. documents: doc_id, markdown."""
    bodies = question_bodies(documents).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("question", "body"))).alias("q"))
    rows = documents.join(bodies, "doc_id", "left")
    body = lambda n: F.coalesce(F.try_element_at("q", F.lit(n)), F.lit(""))
    tests = {f"Q{n} options": F.array_sort(F.regexp_extract_all(body(n), F.lit(LABELS), F.lit(1))) == F.array(*map(F.lit, "1234")) for n in OPTION_QUESTIONS}
    for name, (n, patterns) in REQUIRED.items():
        hit = F.lit(True)
        for p in patterns:
            hit = hit & body(n).rlike("(?iU)" + p)
        tests[name] = hit
    tests["MathonGo occurrences"] = F.regexp_count("markdown", F.lit(MARK)) <= max_watermarks
    each = rows.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("check"), v.alias("passed")) for k, v in tests.items()])).alias("c")).select("doc_id", "c.*")
    return each.unionByName(each.groupBy("doc_id").agg(F.bool_and("passed").alias("passed")).select("doc_id", F.lit("all").alias("check"), "passed"))
