"""Token files against the tokenizer run on whole texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from smogline.llm import queries, tokens
from tests.llm.fixtures import AWKWARD, SF, docs_frame, got, rows_of


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def expected(rows, whole):
    out, at = [], 0
    for doc_id, text in sorted(rows):
        ids = whole(text)
        out.append({"doc_id": doc_id, "start": at, "n_tokens": len(ids),
                    "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())})
        at += len(ids)
    return out


def test_query_equals_brute_force(spark, whole):
    want = expected([(r["doc_id"], r["text"]) for r in rows_of("documents")], whole)
    assert got(queries.QUERIES["op2_token_orc"](spark, SF)) == want


def test_awkward_texts(spark, whole):
    path = tokens.write_tokens(docs_frame(spark, AWKWARD, extra=True))
    want = expected([(i, t or "") for i, t in enumerate(AWKWARD)], whole)
    assert got(tokens.token_digest(tokens.read_tokens(spark, path))) == want


def test_round_trip_and_lookup(spark, whole):
    path = tokens.write_tokens(docs_frame(spark, ["alpha beta", "gamma", None]))
    assert [r["ids"] for r in got(tokens.read_tokens(spark, path))] == [whole("alpha beta"), whole("gamma"), [0]]
    one = tokens.lookup(spark, path, 1)
    assert [r["ids"] for r in one.collect()] == [whole("gamma")]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1)]" in one._jdf.queryExecution().toString()


def test_empty_table(spark):
    path = tokens.write_tokens(docs_frame(spark, ["x"]).limit(0))
    assert tokens.token_digest(tokens.read_tokens(spark, path)).collect() == []


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\ny", "<|endoftext", "a<|endoftext|>", " <|endoftext|> "]


def test_strings_of_special_tokens_are_encoded_as_the_library_does(spark, whole):
    assert len(whole("a <|endoftext|> b")) == 5  # with the end id
    e = tokens.PieceEncoder(tokens.default_tokenizer())
    texts = ["plain words", *MARKED, "plain words again"]
    ids, counts = e.encode(pa.array(texts))
    want = [whole(t)[:-1] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    path = tokens.write_tokens(docs_frame(spark, texts))
    assert got(tokens.token_digest(tokens.read_tokens(spark, path))) == expected(list(enumerate(texts)), whole)


def test_table_of_pieces_over_many_batches(whole):
    rng = np.random.default_rng(8)
    words = ["w" * int(n) + str(i) for i, n in enumerate(rng.integers(0, 40, 300))]  # also longer than KEY_BYTES
    for limit in (10 ** 6, 100):
        e = tokens.PieceEncoder(tokens.default_tokenizer(), cache_pieces=limit)
        for _ in range(12):
            texts = [" ".join(rng.choice(words, 30)) + rng.choice([".", "!", "", "\n"]) for _ in range(8)]
            ids, counts = e.encode(pa.array(texts))
            want = [whole(t)[:-1] for t in texts]
            assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert (np.diff(e.known.astype(object)) > 0).all()


def test_cache_limit_keeps_ids(whole):
    e = tokens.PieceEncoder(tokens.default_tokenizer(), cache_pieces=1)
    for text in AWKWARD:
        assert e.encode(pa.array([text or ""]))[0].tolist() == whole(text)[:-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab \n\t.,'Zé中\u00a0\u201c1")) | st.characters(codec="utf-8"), max_size=60), max_size=6))
def test_any_texts(texts):
    e = tokens.encoder(tokens.default_tokenizer())
    ids, counts = e.encode(pa.array(texts, pa.string()))
    want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
