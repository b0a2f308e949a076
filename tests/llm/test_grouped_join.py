"""The grouped prefix join against all pairs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from small_tables import SF_DIR, empty, nasty, prose  # noqa: F401

from helioframe.llm import grouped_join


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def check(df, shingle=5, percent=80, **kw):
    rows = rows_of(df)
    expected = brute.components(rows, shingle, percent)
    got = grouped_join.similar_documents(df, shingle=shingle, percent=percent, **kw).collect()
    sizes = sorted((i is None, i or 0, len(brute.shingles(t, shingle))) for i, t in rows)
    assert sorted((r.id is None, r.id or 0, r.n_shingles) for r in got) == sizes
    assert {r.id: r.component_id for r in got} == expected | ({None: None} if any(i is None for i, _ in rows) else {})
    return expected


def test_odd_rows(nasty, empty):
    check(nasty)
    assert grouped_join.similar_documents(empty).count() == 0


def test_documents(spark):
    found = check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert any(i != c for i, c in found.items())


def family(draw: random.Random, base: list[str], n: int) -> list[str]:
    """Copies of one text with edits, from hardly any to below the similarity."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
        if draw.random() < 0.3:
            at = draw.randrange(len(words))
            words[at:at] = prose(draw, draw.randint(1, 12)).split(" ")
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("buckets", [grouped_join.BUCKETS, 64])
def test_families_chains_and_common_passages(spark, buckets):
    draw = random.Random(21)
    texts = family(draw, prose(draw, 90).split(" "), 60) + family(draw, prose(draw, 160).split(" "), 40)
    passage = prose(draw, 60)
    texts += [f"{prose(draw, draw.randint(2, 60))} {passage}" for _ in range(60)]
    step = prose(draw, 100).split(" ")
    for n in range(25):  # a chain: each text is similar to its neighbours only
        step = [*step[4:], *prose(draw, 4).split(" ")]
        texts.append(" ".join(step))
    lines = [prose(draw, 12) for _ in range(8)]
    texts += ["\n".join(draw.sample(lines, 6)) for _ in range(60)]
    draw.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    found = check(df, buckets=buckets)
    assert len(set(found.values())) < len(found)


def test_equal_prefixes_of_different_texts(spark):
    """Few words: sets of one size whose prefixes are equal though the rest differs."""
    draw = random.Random(2)
    texts = [" ".join(["a b c d e f"] + [draw.choice("gh") for _ in range(draw.randint(0, 6))]) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(df, shingle=2)
    check(df, shingle=3, percent=50)


def test_prefix_holds_a_shared_element():
    for percent in (50, 80, 95):
        for n in range(1, 60):
            p = int(grouped_join.prefix_size(np.array([n]), percent)[0])
            assert 1 <= p <= n and n - p < -(-percent * n // 100) <= n - p + 1


def test_texts_of_one_id_and_one_size(spark):
    """Each text of an id finds its own partners, also where both are of one size."""
    draw = random.Random(5)
    bases = [[f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(4)]
    rows = [(7, " ".join(b)) for b in bases[:3]] + [(20 + i, " ".join([*b[:-1], f"end{i}"])) for i, b in enumerate(bases)]
    rows += [(30 + i, " ".join([f"start{i}", *b[1:]])) for i, b in enumerate(bases)]
    found = check(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found[22] == found[30] == 7 and found[33] == 23


def test_elements_are_counted_before_they_are_shuffled(spark, monkeypatch):
    """The shuffle of the count and that of the elements are never on disk together."""
    plans = {}

    def staged(df, label="stage", keep=grouped_join.stage):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, label)

    monkeypatch.setattr(grouped_join, "stage", staged)
    df = spark.createDataFrame([(i, f"a b c d e f g h i j {i // 2}") for i in range(8)], "doc_id bigint, text string")
    assert grouped_join.similar_documents(df).count() == 8
    assert "Aggregate [token" in plans["several"] and "Aggregate [token" not in plans["nodes"]
