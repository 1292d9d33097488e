import zlib

import pytest

from docflow import engines
from docflow.engines import Retrying, failing, find, translate_or_split


def waits(engine, text="hello", **options):
    slept = []
    try:
        return slept, Retrying(engine, sleep=slept.append, **options)(text)
    except RuntimeError as e:
        return slept, e


def test_transient_failures_and_error_pages():
    assert waits(failing("hello", 3, "boom")) == ([2, 4, 6], "HELLO")
    slept, error = waits(failing("hello", 9, "boom"))
    assert slept == [2, 4, 6, 8] and isinstance(error, RuntimeError)
    slept, error = waits(lambda t: "Error 500 (Server)")
    assert slept == [4, 6, 8, 10] and isinstance(error, RuntimeError)
    assert waits(str.upper, "  ") == ([], "")


def test_rate_limits():
    assert waits(failing("hello", 2)) == ([30, 90], "HELLO")
    slept, error = waits(failing("hello", 3))
    assert slept == [30, 90] and isinstance(error, RuntimeError)
    slept = []
    kept = Retrying(failing(".", 3), keep_tier=True, sleep=slept.append)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            kept("a")
        kept.engine = failing(".", 1)
    assert slept == [30, 90]


def test_splitting_goes_round_a_bad_part():
    def engine(t):
        if "bad" in t and len(t) > 20:
            raise RuntimeError("no")
        return t.upper()

    assert translate_or_split("This is one sentence here. And a bad one. A third sentence follows now.", engine) == "THIS IS ONE SENTENCE HERE. AND A BAD ONE. A THIRD SENTENCE FOLLOWS NOW."
    with pytest.raises(RuntimeError):
        translate_or_split("bad bad bad bad bad bad bad", engine)


def test_unknown_engine():
    with pytest.raises(NotImplementedError):
        find(engines.TRANSLATORS, "google")


def test_simple_pdf():
    page = b"BT (Hello \\(you\\)) Tj T* [(Wor) -20 (ld)] TJ ET"
    packed = zlib.compress(b"BT (Second) Tj ET")
    pdf = b"%PDF-1.4\n1 0 obj << /Length 9 >> stream\n" + page + b"\nendstream endobj\n2 0 obj << /Filter /FlateDecode >> stream\n" + packed + b"\nendstream\n<< /Subtype /Image >> stream\nxx\nendstream"
    assert list(engines.simple_pdf_pages(pdf)) == [("Hello (you)\nWorld", 1), ("Second", 0)]
