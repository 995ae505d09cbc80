"""Schemas of the document tables. Every operator carries (doc_id, page_no, ord)."""

from __future__ import annotations

BBOX = "struct<l:double,t:double,r:double,b:double>"
TABLE = "struct<html:string,has_merged_cells:boolean,rows:array<array<string>>,has_header:boolean>"
OPTION_GROUP = "struct<question:string,options:array<struct<label:string,content:string>>>"
LAYOUT = "struct<markdown:string,warnings:array<string>,repairs:array<string>>"

RAW_PAGES = "doc_id long, page_pos int, page_index int, page_count int, width int, height int"
RAW_BLOCKS = "doc_id long, page_pos int, page_index int, ord int, label string, content string, bbox array<double>, image binary, title_level int"
#: What an engine yields for a file, told apart by row: 'page', 'block' or 'item' (with boxes from the bottom), 'asset', or 'error' for a file that failed.
RAW = "doc_id long, row string, page_pos int, page_index int, page_count int, width int, height int, pixels binary, ord int, label string, content string, bbox array<double>, image binary, title_level int, marker string, page_height double, path string, png binary, error string"
ASSETS = "doc_id long, path string, png binary"
ELEMENTS = f"doc_id long, page_no int, ord int, kind string, content string, bbox {BBOX}, image_png binary, formula_placement string, table {TABLE}, option_group {OPTION_GROUP}"
PAGE_GEOMETRY = "doc_id long, page_index int, px_w int, px_h int, pt_w double, pt_h double, rotation int, full_bbox boolean"
#: A page rendered as it is and without its background form: RGB bytes.
RENDERS = "doc_id long, page_index int, width int, height int, original binary, foreground binary"
#: What a PDF reader tells of a page, by row: 'page', 'form', 'path', 'segment', 'render', or 'failed' for a file.
EVIDENCE = "doc_id long, row string, page_index int, pt_w double, pt_h double, rotation int, full_bbox boolean, form_no int, path_no int, seg_no int, l double, b double, r double, t double, other_objects int, type int, x double, y double, is_close boolean, width int, height int, original binary, foreground binary"
REGION_EVIDENCE = "doc_id long, page_index int, block_index int, darkest int, remaining int"

# Kinds of block that Markdown leaves out.
IGNORED_KINDS = ("number", "footnote", "header", "header_image", "footer", "footer_image", "aside_text")
FORMULA_KINDS = ("formula", "display_formula", "inline_formula")
PICTURE_KINDS = ("image", "chart", "seal")
TITLE_KINDS = ("doc_title", "paragraph_title", "title", "section_header")
