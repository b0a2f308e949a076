"""Words of any length: sums over all their segmentations, against a plain recursion."""

import numpy as np
import pytest

from helioframe.llm import piece_langid
from tests.llm.test_operators import PIECES

WORDS = [
    "Donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft",
    "supercalifragilisticexpialidocious" * 6,
    "日本語の文章には空白がないので一つの語がとても長くなることがあります" * 5,
    "x" * 700,
]


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    _, ids, first_byte, _, bare = piece_langid.vocabulary(PIECES)
    p = np.random.default_rng(1).random((pieces.vocab_size() + 1, 3))
    return p / p.sum(0), {pieces.id_to_piece(i).encode(): i for i in set(ids.tolist())}, first_byte, bare


def plain(word: bytes, model) -> np.ndarray:
    """log probability of a word by the recursion over its prefixes, in logs."""
    p, piece, first_byte, bare = model
    logs, mark = np.log(p), "▁".encode()
    sums = [logs[bare]]
    for b in range(1, len(word) + 1):
        ways = [sums[b - 1] + logs[first_byte + word[b - 1]]]
        ways += [sums[a] + logs[piece[word[a:b]]] for a in range(b) if word[a:b] in piece]
        if mark + word[:b] in piece:
            ways.append(logs[piece[mark + word[:b]]])
        sums.append(np.logaddexp.reduce(np.array(ways), axis=0))
    return sums[-1]


def laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    end = np.cumsum([len(w) for w in words])
    return np.frombuffer(b"".join(words), np.uint8), end - [len(w) for w in words], end


@pytest.mark.parametrize("block", [piece_langid.BLOCK, 7, 64])
def test_scores_of_long_words(model, monkeypatch, block):
    monkeypatch.setattr(piece_langid, "BLOCK", block)
    words = [w.encode() for w in ["short", *WORDS]] + [WORDS[1].encode()[:n] for n in (32, 33, 64, 65)]
    got = piece_langid.word_scores(*laid_out(words), model[0], PIECES)
    assert np.allclose(got, [plain(w, model) for w in words], rtol=1e-9)


@pytest.mark.parametrize("block", [piece_langid.BLOCK, 7, 64])
def test_expected_pieces_of_long_words(model, monkeypatch, block):
    monkeypatch.setattr(piece_langid, "BLOCK", block)
    p, piece, _, bare = model
    width = np.ones(len(p))
    width[bare] = 0
    for name, i in piece.items():
        width[i] = len(name.removeprefix("▁".encode()))
    for word in (w.encode() for w in WORDS):
        found = piece_langid.LongWord(np.frombuffer(word, np.uint8), PIECES).expected(np.log(p), np.array([1.0, 2.0, 0.0]))
        assert np.allclose((found * width[:, None]).sum(0), [len(word), 2 * len(word), 0])
    # Where a lattice holds the whole word, both ways agree piece by piece.
    for word in (b"the", WORDS[0].encode()[:30], "größe".encode()):
        data, start, end = laid_out([word])
        whole = piece_langid.Lattice(data, start, end, np.ones(1, bool), PIECES).expected(p, np.ones((1, 3)))
        assert np.allclose(piece_langid.LongWord(data, PIECES).expected(np.log(p), np.ones(3)), whole, atol=1e-12)


def test_products_below_the_range_of_a_double(model):
    p, piece, first_byte, bare = model
    tiny = np.full_like(p, 1e-14)
    words = ["語" * 10, "ab"]
    got = piece_langid.word_scores(*laid_out([w.encode() for w in words]), tiny, PIECES)
    assert np.allclose(got, [plain(w.encode(), (tiny, piece, first_byte, bare)) for w in words])
