"""Encoding and decoding against the library."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm.pieces import Model, encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = Model.read(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)

ODD = ["", " ", "  ", "▁", " ▁ ", "a", "\n", "\n\n", " \n ", "</s>", "<s>x", "<0x41>", "<unk>", "\x00", "a\x00b",
       "é", "é", "ﬁ", "　x", "​", "�", "😀 👩‍👩", "ゼ梦ゼ", "aaaaaaaaaaaaaaaaaaaa" * 9,
       " " * 37 + "x", "x" + " " * 100, "ab" * 300, "\t\tfoo\r\nbar", "internationalization antidisestablish",
       "1234567890" * 5, "http://a.b/c?d=e&f", "Ünïcödé ß ẞ İ ı", "\U0010ffff"]


def same(text):
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text) == ids, repr(text)
    assert MODEL.decode(ids + [2]) == LIBRARY.decode(ids + [2]), repr(text)


def test_odd_texts():
    for text in ODD:
        same(text)
        same("x " + text + " y")


@settings(max_examples=600, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aeinrst 1▁\n.,'", max_size=120))
def test_texts_of_few_letters(text):
    same(text)


def test_whole_documents_and_joined_pieces(spark):
    own = random.Random(3)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        same(row.text or "")
    pieces = [t for t in MODEL.ids]
    for _ in range(3000):
        same("".join(own.choices(pieces, k=own.randrange(1, 7))).replace("▁", " "))


def test_laying_pieces_equals_merging_them():
    """On cuts that the library sees as a whole, without the library."""
    own = random.Random(5)
    letters = "▁▁abcdeinrstz'-"
    for _ in range(2000):
        text = "".join(own.choices(letters, k=own.randrange(1, 30)))
        assert [MODEL.texts[i] for i in MODEL.cut_ids(text)] == MODEL.merged(text)


def test_broken_bytes_are_decoded_one_by_one():
    own = random.Random(7)
    for _ in range(4000):
        ids = [own.choice([3 + own.randrange(256), 3 + 0xE2, 3 + 0x96, 3 + 0x81, own.randrange(3, 32000), 2])
               for _ in range(own.randrange(1, 9))]
        assert MODEL.decode(ids) == LIBRARY.decode(ids), ids


def test_long_text_without_cuts():
    text = "".join(random.Random(9).choices("abcdefg", k=1_200_000))
    assert MODEL.encode(text[:30_000]) == LIBRARY.encode(text[:30_000])
    assert MODEL.decode(MODEL.encode(text)) == text


def test_encode_decode(spark):
    texts = [None, *ODD, "word " * 250_000, "one two", "one two"]
    rows = [(i if i % 7 else None, t, [1], "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, decoded string").repartition(3)
    got = encode_decode(docs, PATH).collect()
    want = []
    for doc, text, _, _ in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        want.append((doc, ids, LIBRARY.decode(ids)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert encode_decode(docs.where("false"), PATH).collect() == []
    broken = docs.limit(1).selectExpr("1L AS doc_id", "cast(X'61FFE28120' AS string) AS text")
    assert encode_decode(broken, PATH).first().decoded == "a��� "


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "model"
    path.write_bytes(b"\x0a\x05\x0a\x01a\x18\x04")
    with pytest.raises(ValueError):
        Model.read(str(path))
