"""Schemas of records and layouts. What they leave out survives in a record's raw line."""

STATISTICS = "STRUCT<clean_image_num: LONG, clean_total_token: LONG, clean_text_token: LONG>"
VERDICT = "STRUCT<decision: STRING, score: DOUBLE>"
LANGUAGE = "STRUCT<language: STRING>"
IMAGE = "STRUCT<relative_img_path: STRING, width: INT, height: INT>"

RECORD = f"""
pdf_md5 STRING, id STRING, texts ARRAY<STRING>, images ARRAY<{IMAGE}>, img_cnt LONG, text_cnt LONG,
statistics_info {STATISTICS}, language_fasttext {LANGUAGE}, `category_cls_v1.3` STRING, chapter_info STRING,
meta_info STRUCT<statistics_info: {STATISTICS}, origin_pdf_layout_score: {VERDICT}, origin_pdf_nsfw_score: {VERDICT},
  language_fasttext: {LANGUAGE}, `category_cls_v1.3`: STRING, chapter_info: STRING,
  address: STRUCT<s3_origin_address: STRING, s3_parse_address: STRING, s3_clean_address: STRING>>
"""

CATEGORY = "STRUCT<category_code: STRING, category_name: STRING, score: DOUBLE>"

# Fixed values of the layout format: block and span types.
TEXT, TITLE, IMAGE_BLOCK, TABLE, LIST, CODE, INDEX = "text", "title", "image", "table", "list", "code", "index"
INTERLINE_EQUATION, INLINE_EQUATION = "interline_equation", "inline_equation"
PHONETIC, REF_TEXT, ALGORITHM = "phonetic", "ref_text", "algorithm"
IMAGE_BODY, IMAGE_CAPTION, IMAGE_FOOTNOTE = "image_body", "image_caption", "image_footnote"
TABLE_BODY, TABLE_CAPTION, TABLE_FOOTNOTE = "table_body", "table_caption", "table_footnote"
CODE_BODY, CODE_CAPTION = "code_body", "code_caption"
HEADER, FOOTER, PAGE_NUMBER, ASIDE_TEXT, PAGE_FOOTNOTE = "header", "footer", "page_number", "aside_text", "page_footnote"
