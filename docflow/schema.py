"""Schemas of the registry and of the tables between steps."""

from __future__ import annotations

STEP1 = "status string, md_relpath string, images_dir_relpath string, image_count int, dropped_foreign_paragraphs int, mode string, at string, error string"
TRANSLATION = "status string, translated_md_relpath string, source_md_relpath string, engine string, target_language string, at string, error string, partial_relpath string, partial_blocks_done int"
DOCX = "status string, translated_relpath string, original_relpath string, error string, translated_at string"
SUMMARY = "text string, source_relpath string, source_kind string, source_fingerprint struct<size: bigint, mtime: bigint>, method string, sentences int, at string"


def _struct(fields: str) -> str:
    return "struct<" + fields.replace(" string", ": string").replace(" int", ": int").replace(" struct<", ": struct<") + ">"


ENTRY = (
    "sha256 string, original_name string, duplicates array<string>, page_count int, has_pictures boolean, source_lang string, text_layer_chars bigint, "
    f"step1 {_struct(STEP1)}, translation_md {_struct(TRANSLATION)}, translation_docx {_struct(DOCX)}, summary {_struct(SUMMARY)}"
)
LEDGER = "path string, length bigint, mtime timestamp, sha256 string"
FILES = "path string, modificationTime timestamp, length bigint, content binary"
PAGES = "sha256 string, page_no int, text string, n_images int"
OCR_CANDIDATES = "sha256 string, page_no int, lang string, lang_ord int, text string, error string"
BLOCKS = "sha256 string, block_idx int, kind string, text string"
CHUNKS = "sha256 string, block_idx int, chunk_no int, text string"
BLOCK_CACHE = "src_sha string, text string"
