import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from docloom.llm import bpe
from docloom.llm.suite import QUERIES
from docloom.llm.texts import chunks
from tests.llm.conftest import ODD, thue_morse


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(public_tokenizers.path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def other(own):
    return tiktoken.Encoding(
        "own", pat_str=bpe.PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={}
    )


def digests(text, other):
    ids = other.encode_ordinary(text or "")
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_matches_the_library(spark, data, texts, other):
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_prefix_bpe"](spark, data).collect()}
    assert found == {i: digests(t, other) for i, t in texts}


def test_odd_rows(spark, clashing, none, other):
    found = [tuple(r) for r in bpe.encoded(clashing).drop("ids").collect()]
    assert sorted(map(repr, found)) == sorted(repr((r[0], *digests(r[1], other))) for r in ODD)
    assert bpe.encoded(none).collect() == []


def test_random_strings(own, other):
    rng = random.Random(11)
    letters = "abcdefghij éèñß's'tlvred  \n\t 　漢字テストпривет😀12½²$%#_- \x1c\x85"
    rows = ["", None, "a" * 500 + " " * 99 + "=" * 500 + "'s", "''s's 'll don't we'VE 'r"]
    rows += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    found = []
    for chunk in chunks(pa.array(rows)):
        ids, ends = own.chunk(chunk)
        found += [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
    assert found == [other.encode_ordinary(x or "") for x in rows]


@pytest.mark.parametrize("size", [512, 1024, 2048, 4096])
def test_pieces_of_much_structure(own, other, size):
    texts = [*thue_morse(size), " ".join(thue_morse(size))]
    for rows in (texts, texts[::-1]):
        (chunk,) = chunks(pa.array(rows))
        ids, ends = own.chunk(chunk)
        found = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
        assert found == [other.encode_ordinary(x) for x in rows]


def test_pieces_of_one_hash_are_told_apart(own, other, monkeypatch):
    """Within a chunk and against the memory, pieces count as equal only if their bytes are."""
    monkeypatch.setattr(bpe, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64) % 3)
    own.forget()
    rng = random.Random(12)
    for _ in range(4):
        rows = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 90))) for _ in range(30)) for _ in range(4)]
        (chunk,) = chunks(pa.array(rows))
        ids, ends = own.chunk(chunk)
        assert [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)] == [other.encode_ordinary(x) for x in rows]
    own.forget()


def test_memory_is_renewed(own, other, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    own.forget()
    rng = random.Random(2)
    for _ in range(5):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
        (chunk,) = chunks(pa.array([text]))
        assert own.chunk(chunk)[0].tolist() == other.encode_ordinary(text)
    own.forget()


def test_appends_and_edits_of_a_piece(own):
    rng = random.Random(4)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdefghijklmn ther") for _ in range(rng.randint(1, 80)))
        table = bpe.PrefixTable(own.vocabulary)
        for at in range(0, len(piece), 7):
            table.append(piece[at : at + 7])
        assert table.last == bpe.PrefixTable(own.vocabulary, piece).last
        start = rng.randint(0, len(piece))
        end = rng.randint(start, min(len(piece), start + 5))
        new = bytes(rng.choice(b"abcxyz") for _ in range(rng.randint(0, 4)))
        table.replace(start, end, new)
        fresh = bpe.PrefixTable(own.vocabulary, piece[:start] + new + piece[end:])
        assert (table.piece, table.last) == (fresh.piece, fresh.last)


def test_an_edit_stops_early(own):
    table = bpe.PrefixTable(own.vocabulary, b"the" * 2000)
    assert table.replace(10, 11, b"x") < 500


def test_appends_of_a_text(own, other):
    text = "It's we'll 'l" + "l 're  x\n\n y don't 12 '" + "re!"
    for step in (1, 2, 5):
        edited = bpe.EditableText(own)
        for at in range(0, len(text), step):
            edited.append(text[at : at + step])
            so_far = text[: at + step]
            assert np.frombuffer(edited.ids(), "<u4").tolist() == other.encode_ordinary(so_far)


def test_tokens_that_merging_cannot_make():
    """A token out of reach is used for a piece equal to it, and never inside another."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259}
    own = bpe.Encoder(bpe.Vocabulary(ranks))
    other = tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("xyz", "xyzabc", "abc", "abcbc", "aabcxyz xyz"):
        (chunk,) = chunks(pa.array([text]))
        assert own.chunk(chunk)[0].tolist() == other.encode_ordinary(text)
