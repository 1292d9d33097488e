"""Settings: TOML merged section by section over defaults, into a frozen record."""

from __future__ import annotations

import json
import tomllib
from copy import deepcopy
from dataclasses import asdict, dataclass, field
from pathlib import Path

#: Default settings.
DEFAULTS = {
    "paths": {"source_dir": "to_translate", "step1_md_dir": "step1_md", "translated_md_dir": "translated_md", "translated_dir": "translated", "error_dir": "error_translate", "log_file": "translation_log.json", "index_file": "index.html"},
    "drive": {"folder_url": "", "pdfs_only": True},
    "step1": {"extract_images": True, "images_subdir": "images", "image_dpi": 150, "drop_foreign_paragraphs": True, "ocr_when_empty": True, "force_ocr": False, "ocr_min_chars": 200, "ocr_language": "eng", "ocr_fallback_languages": ["heb", "eng+heb"], "ocr_dpi": 300, "tesseract_cmd": "", "tessdata_prefix": ""},
    "translation": {"target_language": "iw", "engine": "google", "chunk_char_limit": 4500, "retries": 3, "retry_backoff_seconds": 2.0, "skip_already_hebrew": True},
    "docx": {"font_name": "Arial", "font_size_pt": 11},
}


@dataclass(frozen=True)
class Config:
    root: str
    settings: dict = field(hash=False)
    raw: dict = field(default_factory=dict, hash=False)

    def __getattr__(self, name: str):
        for section, values in self.__dict__.get("settings", {}).items():
            if name in values:
                return str(Path(self.root, values[name])) if section == "paths" else values[name]
        raise AttributeError(name)

    @property
    def folder_id(self) -> str:
        return self.folder_url.split("?")[0].rstrip("/").rsplit("/", 1)[-1]

    def ocr_languages(self) -> list[str]:
        return [self.ocr_language, *self.ocr_fallback_languages]

    def dump(self) -> str:
        return json.dumps(asdict(self), indent=2, sort_keys=True, ensure_ascii=False)


def load(path: str | None = None, root: str = ".") -> Config:
    """Settings of a file over the defaults; sections and keys that aren't known stay in raw alone."""
    given = tomllib.loads(Path(path).read_text("utf-8")) if path and Path(path).exists() else {}
    merged = deepcopy(DEFAULTS)
    for section, values in given.items():
        if section in merged and isinstance(values, dict):
            merged[section] |= {k: v for k, v in values.items() if k in merged[section]}
    return Config(str(Path(root).resolve()), merged, given)
