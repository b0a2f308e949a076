"""Pages with an article: the array finds the host's template, everything else stays."""

from __future__ import annotations

import random

import numpy as np
import pytest

from helioframe.llm import host_suffix_array
from helioframe.llm.host_suffix_array import RUN

PITCH = "please subscribe to our weekly letter and never miss a story again"
SCHEMA = "page_id bigint, url string, html string"


def _page(blocks: list[str]) -> str:
    return "<nav>menu</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article><footer>end</footer>"


@pytest.mark.parametrize("small", [True, False])
def test_template_inside_articles(spark, monkeypatch, small):
    if not small:  # as for tables that are too large to broadcast
        monkeypatch.setattr(host_suffix_array, "broadcast_if_small", lambda df: df.hint("shuffle_merge"))
    own = [" ".join(f"own{n}x{i}" for i in range(20)) for n in range(14)]
    pages = {}  # (host, number): blocks, and those that stay
    for n in range(12):
        pages["most", n] = [own[n], PITCH] if n < 7 else [own[n]]
        pages["half", n] = [own[n], PITCH] if n < 6 else [own[n]]
        # Twice on each of five pages is not on ten pages.
        pages["twice", n] = [PITCH, own[n], PITCH] if n < 5 else [own[n]]
        pages["inside", n] = [f"{PITCH} {own[n]}"]
        # Many copies of one page are one page.
        pages["copies", n] = [own[0]]
        pages["copies", n + 20] = [own[n], own[13]] if n < 4 else [own[n]]
    for n in range(9):
        pages["small", n] = [own[n], PITCH]
    # Near copies of a third of the host share most of their text.
    for n in range(12):
        pages["near", n] = [f"{own[0]} edit{n} {own[1]}"] if n < 4 else [own[n]]
    rows = [(i, f"http://{host}.x/{n}", _page(b)) for i, ((host, n), b) in enumerate(pages.items())]
    got = {r.row.page_id: r.text for r in host_suffix_array.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, ((host, n), blocks) in enumerate(pages.items()):
        stays = [b for b in blocks if host != "most" or b != PITCH]
        assert got[i] == "\n\n".join(stays), (host, n)


def test_articles_equal_a_plain_search(spark):
    draw = random.Random(8)
    lines = [" ".join(draw.choice("abcdef") * 3 for _ in range(draw.randint(6, 14))) for _ in range(6)]
    rows, blocks = [], {}
    for i in range(120):
        blocks[i] = [draw.choice(lines) if draw.random() < 0.8 else f"{draw.choice(lines)} {draw.choice(lines)} x{i}" for _ in range(5)]
        rows.append((i, f"http://h{i % 3}.x/{i}", _page(blocks[i])))
    expected = {}
    for host in range(3):
        bodies = {tuple(b) for i, b in blocks.items() if i % 3 == host}
        pages: dict[tuple, set] = {}
        for body in bodies:
            for words in (b.split() for b in body):
                for s in range(len(words) - RUN + 1):
                    pages.setdefault(tuple(words[s : s + RUN]), set()).add(body)
        for i in range(host, 120, 3):
            stays = []
            for block in blocks[i]:
                words = block.split()
                cover = np.zeros(len(words), bool)
                for s in range(len(words) - RUN + 1):
                    if 2 * len(pages[tuple(words[s : s + RUN])]) > len(bodies):
                        cover[s : s + RUN] = True
                if not cover.all():
                    stays.append(block)
            expected[i] = "\n\n".join(stays)
    assert any(e != "\n\n".join(blocks[i]) for i, e in expected.items())
    got = {r.row.page_id: r.text for r in host_suffix_array.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == expected


def test_pages_without_id_or_url(spark):
    own = [" ".join(f"own{n}x{i}" for i in range(20)) for n in range(12)]
    rows = [(None, None, _page([own[n], PITCH])) for n in range(12)]
    got = host_suffix_array.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in got) == sorted(own)
