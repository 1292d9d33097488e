"""Engines: what turns files into pages, images into text and text into other text. They are looked up by name.

Each has a small protocol and an implementation that needs nothing from outside and always gives the same result, so that
pipelines can be run and tested; engines for outside services are registered the same way.
"""

from __future__ import annotations

import itertools
import os
import re
import shutil
import struct
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

from .functions import fixed
from .operators.chunks import chunk_sentences, split_halves, split_sentences


class Translate(Protocol):
    def __call__(self, text: str) -> str: ...


class Extract(Protocol):
    """(text, number of images) of every page of a file's bytes."""

    def __call__(self, content: bytes) -> Iterator[tuple[str, int]]: ...


class Ocr(Protocol):
    """The texts of a page of a file's bytes, one for each language, or the exception that came in its place; page numbers start at 1."""

    def __call__(self, content: bytes, page: int, langs: list[str]) -> list[str | Exception]: ...


class Render(Protocol):
    """The picture of a page, at dpi dots an inch (a page's own unit is 1/72 inch, so that it is enlarged dpi / 72 times)."""

    def __call__(self, content: bytes, page: int, dpi: int) -> bytes: ...


class Recognise(Protocol):
    """The text in a picture in a language; command and data are where the engine's program and its language files are."""

    def __call__(self, picture: bytes, lang: str, command: str, data: str) -> str: ...


@dataclass
class RasterOcr:
    """An OCR engine of a renderer and a recogniser: a page is rendered once, then read in each language."""

    render: Render
    recognise: Recognise
    dpi: int = 300
    command: str = ""
    data: str = ""

    def __call__(self, content: bytes, page: int, langs: list[str]) -> list[str | Exception]:
        picture = self.render(content, page, self.dpi)
        out: list[str | Exception] = []
        for lang in langs:
            try:
                out.append(self.recognise(picture, lang, self.command, self.data))
            except Exception as e:
                out.append(e)
        return out


def find_program(name: str, command: str = "", data: str = "", folders: tuple[str, ...] = (), environ: dict | None = None) -> tuple[str, str]:
    """(command, data folder) of an outside program: what is set and exists, else the search path and folders; its data folder is
    what is set, what the environment names, or the one beside the program. Empty where nothing is found."""
    environ = os.environ if environ is None else environ
    places = [command, shutil.which(name, path=environ.get("PATH", "")) or "", *(os.path.join(f, name) for f in folders)]
    program = next((p for p in places if p and os.path.isfile(p)), "")
    beside = os.path.join(os.path.dirname(program), "tessdata") if program else ""
    return program, next((d for d in (data, environ.get("TESSDATA_PREFIX", ""), beside) if d and os.path.isdir(d)), "")


def failing(pattern: str, times: int, message: str = "ConnectionError") -> Translate:
    """Upper-cases, but fails the first times that a text matches the pattern."""
    left = {}

    def run(text: str) -> str:
        if re.search(pattern, text):
            left[text] = left.get(text, times) - 1
            if left[text] >= 0:
                raise RuntimeError(message)
        return text.upper()

    return run


def form_feed_pages(content: bytes) -> Iterator[tuple[str, int]]:
    """Plain text, pages parted by form feeds."""
    for page in content.decode("utf-8", "replace").split("\f"):
        yield page, 0


_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOW = re.compile(rb"\(((?:\\.|[^\\()])*)\)\s*(?:Tj|')|\[((?:\((?:\\.|[^\\()])*\)|[^\]])*)\]\s*TJ|(T\*|Td|TD|ET)")
_STRING = re.compile(rb"\(((?:\\.|[^\\()])*)\)")


def simple_pdf_pages(content: bytes) -> Iterator[tuple[str, int]]:
    """Pages of a PDF whose pages' content streams are in order, plain or deflated, with text in single-byte strings."""
    images = len(re.findall(rb"/Subtype\s*/Image", content))
    found = []
    for head, body in _STREAM.findall(content):
        if b"/Image" in head or b"/Length1" in head or b"/ObjStm" in head or b"/XRef" in head:
            continue
        if b"/FlateDecode" in head:
            try:
                body = zlib.decompressobj().decompress(body)
            except zlib.error:
                continue
        if b"BT" not in body:
            continue
        parts = []
        for one, many, move in _SHOW.findall(body):
            if move:
                parts.append(b"\n")
            else:
                parts += [one] if one else _STRING.findall(many)
        text = b"".join(re.sub(rb"\\([()\\])", rb"\1", p) for p in parts).decode("latin-1")
        found.append(re.sub(r"\n+", "\n", text).strip("\n"))
    for i, text in enumerate(found or [""]):
        yield text, images if i == 0 else 0


class Pictures(Protocol):
    """(suffix, bytes) of the pictures in a file's bytes."""

    def __call__(self, content: bytes) -> Iterator[tuple[str, bytes]]: ...


def png(width: int, height: int, samples: int, pixels: bytes) -> bytes:
    """A PNG of 8-bit gray (1 sample) or RGB (3 samples) pixels."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    row = width * samples
    raw = b"".join(b"\0" + pixels[i * row : (i + 1) * row] for i in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0 if samples == 1 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def simple_pdf_images(content: bytes) -> Iterator[tuple[str, bytes]]:
    """Pictures of a PDF: JPEG streams as they are, deflated or plain 8-bit gray and RGB ones as PNG; other kinds are left out."""
    for head, body in _STREAM.findall(content):
        if not re.search(rb"/Subtype\s*/Image", head):
            continue
        if b"/DCTDecode" in head:
            yield "jpg", body
            continue
        number = lambda name: int((re.search(rb"/" + name + rb"\s+(\d+)", head) or [0, 0])[1])
        width, height, samples = number(b"Width"), number(b"Height"), 3 if b"/DeviceRGB" in head else 1 if b"/DeviceGray" in head else 0
        if not samples or number(b"BitsPerComponent") != 8 or re.search(rb"/Predictor\s+(?!1\b)\d", head) or b"/Filter" in head and b"/FlateDecode" not in head:
            continue
        size = width * height * samples
        pixels = zlib.decompressobj().decompress(body, size) if b"/FlateDecode" in head else body[:size]
        if size and len(pixels) == size:
            yield "png", png(width, height, samples, pixels)


def _ranged(extract: Extract, count: Callable[[bytes], int]) -> Extract:
    """An extractor that can tell a file's pages and read a range of them (first, end) alone."""
    extract.count = count
    extract.read_range = lambda content, first, end: itertools.islice(extract(content), first - 1, end - 1)
    return extract


_ranged(form_feed_pages, lambda content: content.count(b"\f") + 1)

TRANSLATORS: dict[str, Callable[[], Translate]] = {"identity": lambda: lambda t: t, "upper": lambda: str.upper, "pseudo": lambda: lambda t: f"⟦{t}⟧"}
EXTRACTORS: dict[str, Extract] = {"text": form_feed_pages, "pdf": simple_pdf_pages}
IMAGES: dict[str, Pictures] = {"pdf": simple_pdf_images}
#: By name, what makes an engine of settings (dpi, command, data).
OCRS: dict[str, Callable[..., Ocr]] = {
    "blank": lambda **settings: RasterOcr(lambda content, page, dpi: b"", lambda picture, lang, command, data: "", **settings),
    "text": lambda **settings: RasterOcr(lambda content, page, dpi: [*form_feed_pages(content)][page - 1][0].encode(), lambda picture, lang, command, data: picture.decode(), **settings),
}


def find(engines: dict, name: str):
    if name not in engines:
        raise NotImplementedError(f"no engine is named {name!r}; there are {sorted(engines)}")
    return engines[name]


@dataclass
class Retrying:
    """An engine with two kinds of patience: after a rate limit the waits of RATE_LIMIT_WAITS, after other failures and
    error pages waits that grow by backoff, up to tries. The rate-limit waits start anew with each call; with
    keep_tier they go on from call to call until one succeeds."""

    engine: Translate
    tries: int = fixed.LEAST_TRIES
    backoff: float = 2.0
    keep_tier: bool = False
    check_pages: bool = True
    sleep: Callable[[float], None] = time.sleep
    _tier: int = field(default=0, repr=False)

    def __call__(self, text: str) -> str:
        if not text.strip():
            return ""
        if not self.keep_tier:
            self._tier = 0
        failed = 0
        while True:
            try:
                out = self.engine(text)
            except Exception as e:
                message = str(e).lower()
                if self.check_pages and any(s.lower() in message for s in fixed.RATE_LIMIT):
                    if self._tier >= len(fixed.RATE_LIMIT_WAITS):
                        raise RuntimeError(f"rate limit lasts: {e}") from e
                    self._tier += 1
                    self.sleep(fixed.RATE_LIMIT_WAITS[self._tier - 1])
                    continue
                failed += 1
                if failed >= self.tries:
                    raise RuntimeError(f"failed {failed} times: {e}") from e
                self.sleep(self.backoff * failed)
                continue
            head = (out or "")[: fixed.ERROR_PAGE_HEAD]
            if self.check_pages and any(re.search(p, head, re.I) for p in fixed.ERROR_PAGE):
                failed += 1
                if failed >= self.tries:
                    raise RuntimeError(f"an error page came {failed} times")
                self.sleep(self.backoff * (failed + 1))
                continue
            self._tier = 0
            return out or ""


@dataclass
class Paced:
    """An engine that many slots call, kept below a rate for all of them together.

    Each of slots paces itself at its share of the rate (calls a second), the first calls apart from one another; slots is the
    number of partitions that hold the work, so that no more of them ever run at a time. Where one is told of a rate limit, it notes in a
    file of the shared folder pause until when nobody should call, and all slots, which look there before each call, wait."""

    engine: Translate
    rate: float
    slots: int = 1
    slot: int = 0
    pause: str = ""
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    _next: float = field(default=0.0, repr=False)

    def __call__(self, text: str) -> str:
        if not self._next:
            self._next = self.clock() + self.slot / self.rate
        while (wait := max(self._next, self._paused()) - self.clock()) > 0:
            self.sleep(wait)
        self._next = max(self._next, self.clock() - 1e-9) + self.slots / self.rate
        try:
            return self.engine(text)
        except Exception as e:
            if self.pause and any(s.lower() in str(e).lower() for s in fixed.RATE_LIMIT):
                self._note(self.clock() + fixed.RATE_LIMIT_WAITS[0])
            raise

    def _folder(self):
        import pyarrow.fs as pafs

        return pafs.FileSystem.from_uri(self.pause if "://" in self.pause else f"file://{self.pause}")

    def _paused(self) -> float:
        """Until when nobody should call."""
        if not self.pause:
            return 0.0
        fs, root = self._folder()
        try:
            with fs.open_input_stream(f"{root}/until") as f:
                return float(f.read().decode() or 0)
        except (FileNotFoundError, ValueError):
            return 0.0

    def _note(self, until: float) -> None:
        fs, root = self._folder()
        fs.create_dir(root, recursive=True)
        own = f"{root}/.until-{self.slot}"
        with fs.open_output_stream(own) as f:
            f.write(f"{until:.3f}".encode())
        fs.move(own, f"{root}/until")


def translate_long(text: str, engine: Translate, limit: int = fixed.CHUNK_CHARS) -> str:
    """Chunk by chunk, joined by blanks; outer white space goes, and a blank text is empty."""
    text = text.strip()
    return " ".join(engine(part) for part in chunk_sentences(text, limit)) if text else ""


def translate_or_split(text: str, engine: Translate, limit: int = fixed.CHUNK_CHARS) -> str:
    """As translate_long; a text that fails is tried again in sentences, then in halves, down to LEAST_SPLIT_CHARS."""
    try:
        return translate_long(text, engine, limit)
    except Exception:
        text = text.strip()
        if len(text) <= fixed.LEAST_SPLIT_CHARS:
            raise
        parts = split_sentences(text)
        parts = parts if len(parts) > 1 else split_halves(text)
        if len(parts) < 2:
            raise
        return " ".join(translate_or_split(p, engine, limit) for p in parts)
