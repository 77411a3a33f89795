import random

import pytest
from pyspark.sql import functions as F

from odd_rows import ODD
from panelkit.llm import pieces
from panelkit.llm.common import table


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.read()


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return pieces.Encoder(vocabulary)


def best_score(encoder, chunk):
    """Plain dynamic programme over all substrings."""
    known = {p: encoder.pieces.score[i] for i, p in enumerate(encoder.pieces.piece) if p}
    longest = max(map(len, known))
    best = [0.0] + [float("-inf")] * len(chunk)
    for end in range(1, len(chunk) + 1):
        for begin in range(max(0, end - longest), end):
            own = known.get(chunk[begin:end], encoder.fallback if end - begin == 1 else None)
            if own is not None:
                best[end] = max(best[end], best[begin] + own)
    return best[-1]


def score(encoder, ids, chunk):
    missing = sum(c not in encoder.single for c in chunk)
    return sum(encoder.pieces.score[i] for i in ids if encoder.pieces.piece[i]) + missing * encoder.fallback


def test_best_segmentation(encoder):
    rng = random.Random(4)
    for _ in range(400):
        chunk = "▁" + "".join(rng.choice("aeinorstäé漢xq.,-▁") for _ in range(rng.randrange(25)))
        assert score(encoder, encoder.best(chunk), chunk) == pytest.approx(best_score(encoder, chunk))


def test_chunks_do_not_change_the_best_path(encoder):
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("the and onion  \n.é") for _ in range(rng.randrange(1, 60)))
        whole = encoder.best("▁" + text.replace(" ", "▁"))
        assert score(encoder, whole, "") == pytest.approx(score(encoder, encoder.encode(text).tolist(), ""))


def test_round_trip(vocabulary, encoder):
    decoder = pieces.Decoder(vocabulary)
    rng = random.Random(6)
    alphabet = "ab  \n\t\r▁é漢😀  \0.9 "
    for _ in range(500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert decoder.decode(encoder.encode(text)) == text
    for _, text in ODD:
        assert text is None or decoder.decode(encoder.encode(text)) == text


def test_long_words_of_unpaired_characters(vocabulary, encoder):
    decoder = pieces.Decoder(vocabulary)
    rng = random.Random(7)
    ideographs = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(5000))
    digits = "".join(rng.choice("0123456789") for _ in range(5000))
    for word in (ideographs, digits):
        for text in (word, "so " + word + "\n" + word):
            ids = encoder.encode(text).tolist()
            assert decoder.decode(ids) == text
            whole = encoder.best("▁" + text.replace(" ", "▁"))
            assert score(encoder, ids, "") == pytest.approx(score(encoder, whole, ""))
    assert len(encoder.encode(digits)) >= 5000


def test_general_vocabulary_without_bytes_or_chunks():
    v = pieces.Pieces([None, "▁", "a", "b", "a▁b", "ab"], [0.0, -1.0, -2.0, -2.0, -1.0, -3.5], [])
    e = pieces.Encoder(v)
    assert not e.local
    assert e.encode("a b").tolist() == [1, 4]
    assert e.encode("ab").tolist() == [1, 5]
    assert e.encode("az").tolist() == [1, 2, 0]


def test_documents(spark, make_docs):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = docs.union(make_docs(ODD).select("doc_id", "text"))
    got = pieces.encode_documents(rows)
    assert got.count() == rows.count() and got.filter(~F.col("round_trip")).count() == 0
    null = got.filter("doc_id = 10100").first()
    assert (null["ids"], null["n_pieces"], null["decoded_sha256"]) == (None, 0, None)
    assert got.filter("doc_id = 10101").first()["ids"] == []
    assert pieces.encode_documents(make_docs([])).count() == 0
