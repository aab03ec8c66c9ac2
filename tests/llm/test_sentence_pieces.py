"""Pieces by shared prefixes, against the library and exact round trips."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from salesmill.llm.queries import op9_sentencepiece
from salesmill.llm.sentence_pieces import MARK, SharedPrefixEncoder, encode_pieces, encoder_of

from .conftest import SMALL, by_id, texts

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return SharedPrefixEncoder(FILE)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=FILE)


@settings(deadline=None, max_examples=150)
@given(text=st.text(st.sampled_from("abcdehinorst .,\n\t▁0é日🙂"), max_size=60))
def test_any_text_like_the_library(coder, library, text):
    ids = np.frombuffer(next(coder.encode([text])), "<u4")
    assert ids.tolist() == library.encode(text)
    assert coder.decode(ids) == text.replace(MARK, " ")


def test_states_of_a_prefix_are_reused(coder):
    words = ["▁then", "▁thenable", "▁there", "▁", "then", "▁thenablé"]
    together = coder.encode_words(words)
    assert together == {w: coder.encode_words([w])[w] for w in words}


def test_query_like_the_library(spark, small, library):
    got = {r.doc_id: r for r in op9_sentencepiece(spark, SMALL).collect()}
    for d in small("documents"):
        row = got.pop(d["doc_id"])
        assert row.ids == library.encode(d["text"] or "") and row.n_tokens == len(row.ids) and row.round_trip
    assert not got


def test_odd_documents(odd_docs, library):
    got = by_id(encode_pieces(odd_docs, FILE), "ids", "round_trip")
    want = {}
    for doc_id, text in texts():
        want.setdefault(doc_id, []).append((library.encode(text or ""), MARK not in (text or "")))
    assert got == {k: sorted(v, key=repr) for k, v in want.items()}


def test_no_documents(no_docs):
    assert encode_pieces(no_docs, FILE).count() == 0


def test_ends_of_a_prefix_are_all_pieces_that_end_there(coder):
    word, node = "▁thenable日", 0
    for end, character in enumerate(word, 1):
        node = coder._step(coder.steps, coder.falls, node, character)
        want = [word[at:end] for at in range(end) if word[at:end] in coder.reachable]
        assert [(len(p), coder.reachable[p]) for p in want] == list(coder.ends[node])


def test_tasks_of_a_worker_share_one_encoder(tmp_path):
    assert encoder_of(FILE) is encoder_of(FILE)
    other = tmp_path / "piece.model"
    other.write_bytes(open(FILE, "rb").read())
    assert encoder_of(str(other)) is not encoder_of(FILE)
