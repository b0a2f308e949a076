from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from math import log10

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from small_tables import SF_DIR, empty, nasty  # noqa: F401

from helioframe.llm import collinear_chains, decontaminate, host_suffix_array, piece_langid, pu_quality, quality_rules
from helioframe.llm import run_length_index, suffix_tree_lm, tensor_minhash, vector_packing
from helioframe.llm.batches import Words, texts_of
from helioframe.llm.components import components

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# --- 1 packing


def check_packing(pieces, docs, limits=vector_packing.Limits()):
    encode = vector_packing.encoder(BPE)
    expected = Counter()
    for i, t in docs:
        expected[(i, tuple([*encode([t or ""])[0], 0]))] += 1
    parts, sequences = {}, {}
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length > 0
        parts.setdefault((p.id, p.doc_tokens), []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(s) <= limits.segments and sum(p.loss_tokens for p in s) <= limits.loss
    tokens = sum(len(k[1]) * n for k, n in expected.items())
    assert sum(p.length for p in pieces) == tokens
    if len({i for i, _ in docs}) == len(docs):
        got = Counter()
        for (i, n), ps in parts.items():
            ps.sort(key=lambda p: p.start)
            assert [p.start for p in ps] == [0, *np.cumsum([p.length for p in ps])[:-1]]
            got[(i, tuple(x for p in ps for x in p.ids))] += 1
        assert got == expected
    return tokens, len(sequences)


def test_packing_round_trip(spark, nasty, empty):
    check_packing(vector_packing.pack(nasty, BPE).collect(), rows_of(nasty))
    assert vector_packing.pack(empty, BPE).count() == 0
    docs = documents(spark)
    tokens, sequences = check_packing(vector_packing.pack(docs, BPE).collect(), rows_of(docs))
    assert tokens > 0.97 * 1024 * sequences


def test_packing_limits(spark):
    limits = vector_packing.Limits(64, 3, 20)
    df = spark.createDataFrame([(i, "answer text " * (i % 30), "question words " * (i % 7)) for i in range(80)], "doc_id bigint, text string, prompt string")
    pieces = vector_packing.pack(df, BPE, prompt="prompt", limits=limits).collect()
    seen = {}
    for p in pieces:
        seen.setdefault(p.sequence_id, []).append(p)
    for s in seen.values():
        assert sum(p.length for p in s) <= 64 and len(s) <= 3 and sum(p.loss_tokens for p in s) <= 20
    encode = vector_packing.encoder(BPE)
    for r in df.collect():
        mine = sorted((p for p in pieces if p.id == r.doc_id), key=lambda p: p.start)
        assert [x for p in mine for x in p.ids] == [*encode([r.prompt])[0], *encode([r.text])[0], 0]
        assert sum(p.loss_tokens for p in mine) == len(encode([r.text])[0]) + 1


def test_fast_encoder_gives_the_same_ids():
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(BPE), vector_packing.encoder(BPE)
    for t in ["", "a" * 5000, " " * 5000, "<|endoftext|> x", "é🎉\x00\n\n  b", "don't 12a"]:
        assert fast([t])[0] == slow.encode(t, add_special_tokens=False).ids


# --- 2 suffix tree


def small_tree(text: bytes, depth=3):
    symbols = np.frombuffer(text + b"\n", np.uint8)
    places = np.array([0, len(symbols)])
    keys, counts = np.unique(suffix_tree_lm.grams(symbols, places, depth), return_counts=True)
    levels = []
    for length in range(depth, -1, -1):
        short, at = np.unique(keys & np.uint64((1 << 8 * (length + 1)) - 1), return_inverse=True)
        n = np.bincount(at, counts).astype(np.int64)
        ok = short >= np.uint64(1 << 8 * length) if length else np.ones(len(short), bool)
        levels.append((short[ok], n[ok]))
    return suffix_tree_lm.SuffixTree(levels[::-1], len(symbols), depth, 0.0, 0.1), symbols, places


def test_tree_is_a_distribution_and_steps_to_longest_suffixes():
    draw = random.Random(3)
    tree, symbols, places = small_tree(" ".join(draw.choice(["aba", "abb", "cab", "bcc"]) for _ in range(300)).encode())
    assert tree.states > 10
    others = 255 - (tree.width - 1)
    probability = 10 ** tree.log.astype(float)
    assert np.allclose(probability[:, :-1].sum(1) + others * probability[:, -1], 1, atol=1e-4)
    # One step at a time from the start gives the same score as the side-by-side rows.
    state, total = tree.next[0, tree.columns[10]], 0.0
    for c in symbols:
        total += tree.log[state, tree.columns[c]]
        state = tree.next[state, tree.columns[c]]
    assert tree.score(symbols, places)[0] == pytest.approx(total, rel=1e-5)


def brute_base(rows):
    token = {n: [*brute.words(t), None] for n, (_, t) in enumerate(rows)}
    held = {n: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for n, (i, _) in enumerate(rows)}
    c = Counter(w for n, ws in token.items() if not held[n] for w in ws)
    total, kinds = sum(c.values()), len(c)
    return sorted(
        (rows[n][0] or -1, held[n], len(ws), sum(c[w] > 0 for w in ws), total, round(sum(log10((c[w] + 1) / (total + kinds + 1)) for w in ws), 6))
        for n, ws in token.items()
    )


@pytest.mark.parametrize("common", [5, 500_000])
def test_lm_base_scores(spark, nasty, common):
    got = suffix_tree_lm.score_texts(nasty, common=common).collect()
    assert sorted((r.id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute_base(
        [(i, (t or "").replace("\x00", "\x00")) for i, t in rows_of(nasty)]
    )
    assert all(r.score < 0 for r in got)


def test_lm_on_empty_and_real_tables(spark, empty):
    assert suffix_tree_lm.score_texts(empty).count() == 0
    got = suffix_tree_lm.score_texts(documents(spark)).where("NOT held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 1.3 * got[1]  # log probabilities: not far below word counts on their own texts


# --- 3 quality classifier


def test_pu_risk_separates_and_finds_the_prior():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(0, 1, (3000, 4)), draw.normal(4, 1, (1000, 4))
    net, prior = pu_quality.fit(good[:1000], np.concatenate([good[1000:], bad]))
    assert abs(prior - 2 / 3) < 0.08
    assert (pu_quality.sigmoid(net.logit(good)) >= 0.3).mean() > 0.97 and (pu_quality.sigmoid(net.logit(bad)) < 0.3).mean() > 0.97


def test_pu_on_tables(spark, nasty, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (3, 1), (10, 1), (11, 1), (12, 1), (16, 0), (99, 1)], "doc_id bigint, quality int")
    got = pu_quality.classify(nasty, labels).collect()
    assert len(got) == nasty.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert pu_quality.classify(empty, labels).count() == 0
    assert {r.score for r in pu_quality.classify(nasty, labels.where("false")).collect()} == {0.5}


def test_pu_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    got = pu_quality.classify(docs, labels).where("held_out").join(labels, F.col("id") == F.col("doc_id")).collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


# --- 4 language


def test_forward_sums_all_segmentations():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    keys, ids, first_byte, _, bare = piece_langid.vocabulary(PIECES)
    size = model.vocab_size() + 1
    p = np.random.default_rng(0).random((size, 2))
    p /= p.sum(0)
    piece = {model.id_to_piece(i).encode(): i for i in set(ids.tolist())}
    mark = "▁".encode()

    def forward(word):
        a = [p[bare].copy()] + [np.zeros(2) for _ in word]
        for b in range(1, len(word) + 1):
            for s in range(b):
                if word[s:b] in piece:
                    a[b] += a[s] * p[piece[word[s:b]]]
            if mark + word[:b] in piece:
                a[b] += p[piece[mark + word[:b]]]
            a[b] += a[b - 1] * p[first_byte + word[b - 1]]
        return a[-1]

    words = [w.encode() for w in "the theory élan straße x qzqzq".split()]
    end = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    lattice = piece_langid.Lattice(data, end - [len(w) for w in words], end, np.ones(len(words), bool), PIECES)
    assert np.allclose(np.exp(lattice.scores(p)), [forward(w) for w in words], rtol=1e-9)
    # Expected counts of all pieces times their bytes cover every byte of every word.
    counts = lattice.expected(p, np.ones((len(words), 2)))
    width = np.ones(size)
    width[bare] = 0
    for name, i in piece.items():
        width[i] = len(name.removeprefix(mark))
    assert np.allclose((counts * width[:, None]).sum(0), len(data))


def test_language_of_tables(spark, nasty, empty):
    got = piece_langid.identify(documents(spark), PIECES)
    known = documents(spark).select("doc_id", "lang")
    rows = got.where("held_out").join(known, F.col("id") == F.col("doc_id")).collect()
    assert rows and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    rows = piece_langid.identify(nasty, PIECES).collect()
    assert len(rows) == nasty.count()
    assert all((r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.id in (4, 5, 6)} == {"und"}
    assert piece_langid.identify(empty, PIECES).count() == 0
    no_labels = nasty.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in piece_langid.identify(no_labels, PIECES).collect()} == {"und"}


# --- 5 quality rules

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_rule_counts(spark, nasty, empty):
    for df in (nasty, documents(spark)):
        got = quality_rules.base_counts(df, keep=["doc_id", "text"]).collect()
        for r in got:
            assert tuple(r[c] for c in COUNTS) == brute.counts(r.row.text), r.row.doc_id
    assert quality_rules.assess(empty).count() == 0
    judged = quality_rules.assess(nasty).collect()
    assert len(judged) == nasty.count() and {r.row.n for r in judged} == {3}
    assert all(not r.kept for r in judged if r.base_failed)


def test_rules_agree_with_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.assess(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), keep=["doc_id"])
    rows = judged.where("NOT base_failed").select("row.doc_id", "kept").join(labels, "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.98
    assert all(r.kept for r in rows if r.quality == 1)


def test_em_equals_a_plain_version(spark):
    """The same rounds over patterns in numpy."""
    draw = np.random.default_rng(1)
    names = ["a", "b", "c"]
    votes = draw.choice([-1, 0, 1], (60, 3), p=[0.2, 0.3, 0.5])
    kinds, times = np.unique(votes, axis=0, return_counts=True)
    df = spark.createDataFrame([(*map(int, k), int(n)) for k, n in zip(kinds, times)], "a int, b int, c int, count bigint")
    model = quality_rules.fit(df, names, 4)
    bad = (kinds == -1).sum(1)
    q = np.full((len(kinds), 4), 0.05 / 3)
    q[:, 0] = np.where(bad > 0, 0.05, 0.95)
    q[bad > 0, 1:] = 0.95 * (kinds[bad > 0] == -1) / bad[bad > 0][:, None]
    for _ in range(4):
        w = q * times[:, None]
        prior = (w.sum(0) + 1) / (w.sum() + 4)
        rate = {(j, v): (w[kinds[:, j] == v].sum(0) + 1) / (w.sum(0) + 3) for j in range(3) for v in (-1, 0, 1)}
        q = np.array([prior * np.prod([rate[j, v] for j, v in enumerate(k)], axis=0) for k in kinds])
        q /= q.sum(1, keepdims=True)
    assert np.allclose(model.priors, prior)
    got = quality_rules.with_shares(df, names, model).collect()
    assert {(r.a, r.b, r.c): round(r.q0, 9) for r in got} == {tuple(map(int, k)): round(x[0], 9) for k, x in zip(kinds, q)}


# --- 6 fuzzy passages


def test_chains_take_the_best_path():
    assert collinear_chains.chains([0, 10, 20, 5], [100, 110, 120, 3])[0] == [0, 1, 2]
    assert collinear_chains.edit_matches(np.array([1, 2, 3]), np.array([1, 3])) == (2, 3)


def test_passages(spark, nasty, empty):
    got = collinear_chains.fuzzy_passages(nasty).collect()
    found = {(r.id, r.source) for r in got}
    assert {(2, 1), (3, 1), (11, 10)} <= found and all(i not in {r.id for r in got} for i in (1, 10, 12, 13, 4))
    text = dict(rows_of(nasty))
    for r in got:
        a, b = brute.words(text[r.id])[r.start : r.end], brute.words(text[r.source])[r.source_start : r.source_end]
        assert len(a) == r.end - r.start >= 50 and r.equal >= 0.8 * r.columns and (r.equal < r.columns or a == b)
    assert collinear_chains.fuzzy_passages(empty).count() == 0
    docs = documents(spark)
    seen, need = {}, set()
    for i, t in sorted(rows_of(docs)):
        w = brute.words(t)
        for s in range(len(w) - 49):
            if seen.setdefault(tuple(w[s : s + 50]), i) != i:
                need.add(i)
    assert need and need <= {r.id for r in collinear_chains.fuzzy_passages(docs).collect()}


def test_passages_made_of_earlier_fragments(spark):
    """A passage whose halves come first elsewhere, or as an excerpt in the same source."""
    draw = random.Random(11)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    pieces = [new(60) for _ in range(8)]
    rows = []
    for n, p in enumerate(pieces):
        rows += [(100 * n + 1, new(30) + p[:30] + new(30)), (100 * n + 2, new(30) + p[30:] + new(30))]
        rows += [(100 * n + i, new(40) + p + new(40)) for i in (5, 9)]
        q = new(60)
        rows += [(100 * n + 11, q[:30] + new(50) + q[30:] + new(50) + q), (100 * n + 12, new(40) + q + new(40))]
    got = collinear_chains.fuzzy_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    text = dict(rows)
    expected = set()
    for i, a in text.items():
        for j, b in text.items():
            runs = {tuple(b[s : s + 50]) for s in range(len(b) - 49)}
            if j < i and any(tuple(a[s : s + 50]) in runs for s in range(len(a) - 49)):
                expected.add((i, j))
    assert len(expected) == 16 and {(r.id, r.source) for r in got} == expected


def test_edited_passages_are_found_at_every_similarity(spark):
    draw = random.Random(12)
    new = lambda n: [f"w{draw.randrange(10**7)}" for _ in range(n)]
    rows, share = [], {}
    for n in range(160):
        percent, size = (95, 90, 87, 84)[n % 4], (55, 80)[n // 4 % 2]
        p = new(size)
        q = list(p)
        for i in draw.sample(range(size), size * (100 - percent) // 100):
            q[i] = new(1)[0]
        rows += [(2 * n, new(60) + p + new(60)), (2 * n + 1, new(60) + q + new(60))]
        share[2 * n + 1] = percent
    got = collinear_chains.fuzzy_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    text = dict(rows)
    for r in got:
        a, b = text[r.id][r.start : r.end], text[r.source][r.source_start : r.source_end]
        assert r.source == r.id - 1 and len(a) >= 50 and r.equal >= 0.8 * r.columns
        assert collinear_chains.edit_matches(np.array(a), np.array(b))[0] >= r.equal
    found = Counter(share[i] for i in {r.id for r in got})
    assert all(found[p] >= 39 for p in (95, 90, 87, 84)), found


def test_longest_part_equals_a_plain_search():
    draw = np.random.default_rng(4)
    for _ in range(200):
        widths = draw.integers(0, 5, draw.integers(1, 12))
        hits = np.minimum(draw.integers(0, 5, len(widths)), widths)
        ok = [e - s for s in range(len(hits)) for e in range(s + 1, len(hits) + 1) if 100 * hits[s:e].sum() >= 80 * widths[s:e].sum()]
        s, e = collinear_chains.longest_part(hits, widths, 80)
        assert e - s == max(ok, default=0) and 100 * hits[s:e].sum() >= 80 * widths[s:e].sum()


# --- 7 near-duplicates


def check_components(df, k):
    rows = rows_of(df)
    expected = brute.components(rows, k, 80)
    got = tensor_minhash.near_duplicates(df, shingle=k).collect()
    assert len(got) == len(rows)
    assert {r.id: r.component_id for r in got if r.id is not None} == expected
    size = {t: len(brute.shingles(t, k)) for _, t in rows}
    assert sorted((r.id or -1, r.n_shingles) for r in got) == sorted((i or -1, size[t]) for i, t in rows)


def test_passages_drop_single_seeds_before_places(spark, monkeypatch):
    """Only places of seeds that occur twice go on, and nothing but paths is left of them."""
    seen = {}

    def staged(df, label="stage", keep=collinear_chains.stage):
        out = keep(df, label)
        seen[label] = {r.seed: r["count"] for r in out.groupBy("seed").count().collect()} if "seed" in out.columns else None
        return out

    monkeypatch.setattr(collinear_chains, "stage", staged)
    draw = random.Random(4)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join([*(f"w{draw.randrange(10**9)}" for _ in range(200)), *passage])) for i in range(3)]
    got = collinear_chains.fuzzy_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.id, r.source) for r in got} == {(1, 0), (2, 0), (2, 1)}
    assert set(seen["places"]) == set(seen["repeated"]) and set(seen["places"].values()) == {3} and len(seen["places"]) < 70


def test_an_id_with_two_texts_links_both(spark):
    draw = random.Random(9)
    x, y, z = ([f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(3))
    near = [*y[:-1], "other"]
    rows = [(3, x), (5, x), (5, y), (7, near), (8, z), (9, z), (9, y), (10, z)]
    check_components(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string"), 4)


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, nasty, empty, k):
    check_components(nasty, k)
    check_components(documents(spark), k)
    assert tensor_minhash.near_duplicates(empty).count() == 0


def test_family_of_edited_copies(spark):
    """Copies around the threshold, some linked only through another copy."""
    draw = random.Random(2)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(draw.randint(0, 6)):
            copy[draw.randrange(len(copy))] = f"w{draw.randrange(40)}"
        rows.append((draw.randrange(10_000) * 100 + i, " ".join(copy)))
    check_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (7, 7)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.v: r.c for r in got} == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# --- 8 decontamination


@pytest.mark.parametrize("block", [400_000, 60])
def test_decontamination(spark, nasty, empty, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rows = rows_of(nasty)
    by_id = dict(rows)
    items = [(3, by_id[10]), (20, "one"), (3, None), (None, by_id[11].upper()), (5, ""), (6, by_id[1][30:400])]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, row int")
    got = decontaminate.decontaminate(nasty, bench).collect()
    named = [("null" if i is None else i, t) for i, t in items]
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == brute.hits(r.row.text, named)
        for s in r.spans:
            assert r.row.text[s.first : s.past].strip() == r.row.text[s.first : s.past]
    assert len(got) == len(rows)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(nasty, bench.where("false")).collect()} == {0}


# --- 9 pages


def test_pages(spark):
    menu = " ".join(f"menu{i}" for i in range(10))
    rows = [(i, f"http://h.x/{i}", f"<body><div>{menu}</div><p>own text of page {i} with words a{i} b{i} &amp; more</p></body>") for i in range(5)]
    rows += [(9, None, None), (None, "x", ""), (11, "http://h.x/q", "<article><h1>T &lt;</h1><p>a<b>b</b>\n c<br>d<p>e</article><footer>f</footer>")]
    rows += [(12, "http://h.x/r", "<main><div class='post'>x<div class=comments>no</div></div><script>if(a<b){}</script><p>y<!-- z -->w"), (12, "http://h.x/r", "<p>lone &am")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, page int")
    got = host_suffix_array.main_text(df).collect()
    text = {(r.row.page_id, r.row.html): r.text for r in got}
    assert len(got) == len(rows)
    for i in range(5):
        assert text[rows[i][0], rows[i][2]] == f"own text of page {i} with words a{i} b{i} & more"
    assert [text[r[0], r[2]] for r in rows[5:]] == ["", "", "T <\n\nab c d\n\ne", "x\n\nyw", "lone &am"]
    assert host_suffix_array.main_text(df.where("false")).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    menu = " ".join(f"menu{i}" for i in range(10))
    own = [" ".join(f"own{n}x{i}" for i in range(30)) for n in range(3)]
    rows = [(i, "http://h.x/a", f"<div>{menu}</div><p>{own[min(i, 2)]}</p>") for i in range(6)]
    got = host_suffix_array.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.row.page_id: r.text for r in got} == {i: own[min(i, 2)] for i in range(6)}


def test_repeated_runs_equal_a_plain_search():
    draw = random.Random(5)
    contexts = [np.array([draw.randrange(3) for _ in range(draw.randint(8, 15))]) for _ in range(300)]
    page = np.array([draw.randrange(200) for _ in contexts])
    pages = {}
    for c, p in zip(contexts, page):
        for s in range(len(c) - 7):
            pages.setdefault(tuple(c[s : s + 8]), set()).add(p)
    got = host_suffix_array.repeated_runs(contexts, page, page)
    assert [list(g) for g in got] == [[len(pages[tuple(c[s : s + 8])]) > 1 for s in range(len(c) - 7)] for c in contexts]


# --- 10 repeated substrings


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_substrings(spark, nasty, empty, monkeypatch, hot):
    monkeypatch.setattr(run_length_index, "HOT", hot)
    for df in (nasty, documents(spark)):
        rows = [(i if i is not None else 2**63 - 1, t) for i, t in rows_of(df)]
        expected = sorted(
            (i, len(raw), sum(f), hashlib.sha256(bytes(b for b, x in zip(raw, f) if not x)).hexdigest()) for i, raw, f in brute.removed(rows)
        )
        got = run_length_index.remove_repeats(df).select("row", "n_bytes", "spans", "kept", "clean").collect()
        assert sorted(
            (r.row.doc_id if r.row.doc_id is not None else 2**63 - 1, r.n_bytes, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in got
        ) == expected
        for r in got:
            assert len(r.clean.encode()) >= len(r.kept) and (r.spans or r.clean == (r.row.text or ""))
    assert run_length_index.remove_repeats(empty).count() == 0


def test_windows_of_hot_anchors_have_two_unrelated_hashes(monkeypatch):
    """With one of the two hashes useless, the other still tells different windows apart."""
    import pyarrow as pa

    monkeypatch.setattr(run_length_index, "span_hash", lambda sums, starts, ends: np.zeros(len(starts), np.uint64))
    draw = random.Random(3)
    text = "".join(draw.choice("abcdef") for _ in range(1000))
    data, places = texts_of(pa.array([text]))
    hashes = np.unique(run_length_index.anchors(data, places)[0])
    hot = pa.array([hashes.view(np.int64).tolist()], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([[]], pa.list_(pa.int64())), hot], names=["id", "text", "cold", "hot"])
    rows = pa.Table.from_batches(list(run_length_index._context_rows(iter([batch])))).to_pylist()
    assert len(rows) == len({(r["key"], r["c"]) for r in rows}) == 901 and all(r["p"] == 0 for r in rows)


def test_index_equals_a_plain_search():
    draw = random.Random(1)
    base = [bytes(draw.choice(b"ab") for _ in range(draw.randint(100, 176))) for _ in range(4)]
    contexts = []
    for _ in range(60):
        c = bytearray(draw.choice(base))
        for _ in range(draw.randint(0, 2)):
            c[draw.randrange(len(c))] = draw.choice(b"abc")
        contexts.append(bytes(c))
    contexts = list(dict.fromkeys(contexts))
    ids = np.array([draw.randrange(10) for _ in contexts])
    starts = np.array([draw.randrange(300) for _ in contexts])
    first = {}
    for c, i, s in zip(contexts, ids, starts):
        for j in range(len(c) - 99):
            first[c[j : j + 100]] = min(first.get(c[j : j + 100], (i, s + j)), (i, s + j))
    expected = {(n, j) for n, (c, i, s) in enumerate(zip(contexts, ids, starts)) for j in range(len(c) - 99) if first[c[j : j + 100]] < (i, s + j)}
    assert set(map(tuple, run_length_index.repeated_windows(contexts, ids, starts))) == expected


# --- words


def test_words_equal_the_pattern():
    import pyarrow as pa

    texts = ["", None, "a", " a  b\t", "A\x00b é x", "\n", "x" * 50, "last one"]
    words = Words(*texts_of(pa.array(texts)))
    got = [[words.data[s:e].tobytes().decode() for s, e in zip(words.start[a:b], words.end[a:b])] for a, b in zip(words.first, words.first[1:])]
    assert got == [brute.words(t) for t in texts]
