"""Rows with every oddity, as fixtures that the test modules import."""

from __future__ import annotations

import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
SYLLABLES = "tha re on ing er st le ti or an es ba do ki mu no".split()


def prose(draw: random.Random, n: int) -> str:
    out = []
    for i in range(n):
        word = "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 3)))
        out.append(word.capitalize() + "" if i % 9 == 0 else word + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def nasty_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows and copies."""
    draw = random.Random(7)
    base, passage = prose(draw, 150), prose(draw, 70)
    edited = base.split(" ")
    edited[40], edited[90] = "changed", "twice"
    rows = [
        (1, base), (2, base), (2, base), (3, " ".join(edited)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "One"),
        (9, "two words"), (10, prose(draw, 60) + " " + passage), (11, passage + " " + prose(draw, 60)), (None, base),
        (None, None), (12, prose(draw, 6000)), (13, "x" * 3000), (14, "é" * 200 + "ß" * 120 + "é" * 200), (15, "\x00 a\x00b " * 30),
        (16, "Erst, " * 200), (17, prose(draw, 80).upper()), (18, prose(draw, 30) + "\n" + prose(draw, 30) + "\n" + "same line\n" * 3),
    ]
    return rows


@pytest.fixture(scope="session")
def nasty(spark):
    """The rows with columns whose names clash with what operators use."""
    schema = "doc_id bigint, text string, row int, id string, key string, kept boolean, n_words int, n int, lang string, html string"
    rows = [(i, t, 1, "x", "k", None, None, 3, "en" if n % 2 else None, "<p>") for n, (i, t) in enumerate(nasty_rows())]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(nasty):
    return nasty.where("false")
