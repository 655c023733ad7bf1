import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from pagemart.llm import bpe, pretokens

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    signs = "ab ceélst'rvmd.,!?0 12\n\t  　'́日本\U0001f600\x1c\x85Ⅷ²"
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return [*made, "", "x" * 400, "don't 'tis 'sfoo ''s 's x's's  \n\n a  ", "<|endoftext|>"]


def test_ids_are_those_of_the_library(plain):
    some = texts()
    codec = bpe.codec(PATH)
    got = [ids.tolist() for ids in codec.encode_each(some)]
    assert got == [plain.encode_ordinary(t) for t in some]
    assert all(codec.decode(ids) == t.encode() for ids, t in zip(got, some, strict=True))


def thue_morse(steps, a="a", b="b"):
    """A word and its opposite: a polynomial hash modulo 2 ** 64 does not tell them apart from 1,024 letters on."""
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("steps", [10, 12])
@pytest.mark.parametrize("together", [True, False])
def test_words_with_equal_keys(plain, steps, together):
    one, other = thue_morse(steps)
    assert pretokens.key_of(one) == pretokens.key_of(other) and one != other
    codec = bpe.codec(PATH)
    codec.memory = pretokens.PieceMemory(longest=1 << 14)
    for some in ([[one, other, one, f"{other} {one}"]] if together else [[one], [other], [one], [other]]):
        got = [ids.tolist() for ids in codec.encode_each(some)]
        assert got == [plain.encode_ordinary(t) for t in some]


def test_memory_is_cleared_when_full(plain):
    codec = bpe.codec(PATH)
    codec.memory = pretokens.PieceMemory(slots=64, ids=100, longest=8)
    for _ in range(3):
        some = texts()[:500]
        assert [ids.tolist() for ids in codec.encode_each(some)] == [plain.encode_ordinary(t) for t in some]


def test_long_texts_are_cut_where_the_split_allows(plain):
    text = " ".join(texts()[:300])
    parts = list(pretokens.cut_long(text, 400))
    assert len(parts) > 5 and "".join(parts) == text
    assert [i for p in parts for i in plain.encode_ordinary(p)] == plain.encode_ordinary(text)


def test_memory_is_forgotten_when_full(plain):
    codec = bpe.Codec(PATH)
    codec.memory = pretokens.PieceMemory(slots=8, ids=50)
    some = texts()[:500]
    for k in range(0, 500, 50):
        assert [i.tolist() for i in codec.encode_each(some[k : k + 50])] == [plain.encode_ordinary(t) for t in some[k : k + 50]]


def test_query_rows(spark, plain):
    rows = [(1, "a b"), (2, None), (3, ""), (1, "a b"), (None, "dé")]
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, n_tokens int, ids string")
    got = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr)
    want = []
    for d, t in rows:
        ids = plain.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows)
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
