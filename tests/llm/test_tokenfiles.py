import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_fixtures import EDGE, documents, edge, nothing  # noqa: F401

from docpipe.llm import wordids
from docpipe.llm.tokenfiles import (
    SequenceReader, SequenceWriter, _encoded, encoder, read_tokens, tokenizer_path, write_tokens,
)

PATH = tokenizer_path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def encoded(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


HARD = [
    "don't 'stop it's --'s a'b'c", "İstanbul", "éa", "<|endoftext|>x <|startoftext|>",
    "\x1c a\x1db", "x²³1½23 ñÑß ς ΣΑΣ ΑΣ", "", "   ", "漢字 かな １２", "a b\xa0c​d",
    "’s it’s", "😀a😀😀 b", "it'S DON'T we'Ll", "'", " ' ", "''s", "̀x", "ǅ ﬁ Å Ⅷ",
]


@pytest.mark.parametrize("text", HARD)
def test_same_ids_as_the_library(text):
    assert next(_encoded(encoder(PATH), pa.array([text]), 1)).tolist() == [*encoded(text), 1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abAB09'-. \n<|>éßıİς漢́\xa0\x1f")), max_size=40), max_size=6))
def test_same_ids_on_any_text(texts):
    ids = [x.tolist() for x in _encoded(encoder(PATH), pa.array(texts, pa.string()), 1)]
    assert ids == [[*encoded(t), 1] for t in texts]


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(wordids, "PIECES_KEPT", 50)
    own = wordids.WordIds(PLAIN)
    text = " ".join(f"w{i}x" for i in range(500))
    parts = list(wordids.slices(text, 100))
    assert "".join(parts) == text and len(parts) > 10
    ids, counts = own.encode(parts)
    assert ids.tolist() == encoded(text) and counts.sum() == len(ids)


def test_files_read_in_place(tmp_path):
    ids = [np.arange(n) % 50_000 for n in (3, 0, 5000, 1, 300_000, 7)]
    path = str(tmp_path / "x.arrow")
    with pa.OSFile(path, "wb") as f:
        out = SequenceWriter(f, 64, pa.uint16())
        for x in ids:
            out.append(x)
        out.close()
    flat, reader = np.concatenate(ids), SequenceReader(path)
    assert reader.sequence(10).tolist() == flat[640:704].tolist()
    assert reader.mask(10).all()
    last = len(flat) // 64
    assert reader.mask(last).sum() == len(flat) % 64
    start = 0
    for x in ids:
        assert reader.ids(start, len(x)).tolist() == x.tolist()
        start += len(x)


def expected(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*encoded(text or ""), 1], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = read_tokens(spark, write_tokens(documents, PATH))
    assert sorted(map(tuple, found.collect())) == expected(rows)
    assert found.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"),
                            ("ids_crc32", "bigint")]


def test_edges(spark, edge, nothing):
    found = read_tokens(spark, write_tokens(edge, PATH)).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=order) == expected([(i, t) for i, t, _ in EDGE])
    assert read_tokens(spark, write_tokens(nothing, PATH)).collect() == []


def test_every_code_point():
    """Once between letters and once alone, with the classes of the library's own tables."""
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids = wordids.WordIds(tokenizer)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for start in range(0, len(points), 20_000):
        texts = [f"ab{chr(p)}cd {chr(p)}" for p in points[start : start + 20_000]]
        own, counts = ids.encode(texts)
        theirs = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        assert counts.tolist() == [len(e.ids) for e in theirs]
        assert own.tolist() == [i for e in theirs for i in e.ids]


def test_known_pieces_are_not_encoded_again():
    """Ids are kept by the hash of a piece: its text is not even cut out a second time."""
    encode = encoder(PATH)
    encode._forget()
    texts = ["Known words, known WORDS 12", "and others", ""]
    ids, counts = encode.encode(texts)
    kept = len(encode.kept)

    def never(*_, **__):
        raise AssertionError("encoded again")

    hashes = encode.kept.to_numpy()[::-1]
    assert encode._known(hashes, never).tolist() == list(range(kept))[::-1]
    again = encode.encode(texts[::-1])
    assert len(encode.kept) == kept and again[1].tolist() == counts[::-1].tolist()
    assert sorted(again[0].tolist()) == sorted(ids.tolist())
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids
