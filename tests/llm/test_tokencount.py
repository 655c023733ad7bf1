import random

import public_tokenizers
import pytest
from tokenizers.models import WordPiece

from pagemart.llm import tokencount

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain(word, pieces):
    at, n = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return tokencount.UNKNOWN + 1
        at, n = end, n + 1
    return n


@pytest.mark.parametrize("seed", range(30))
def test_automaton_is_greedy_longest_match(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))}
    made = tokencount.Automaton(sorted(pieces))
    for _ in range(300):
        word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 14)))
        assert made.length(word) == plain(word, pieces)


def test_the_given_vocabulary_as_the_library_matches_it():
    pieces = tokencount.model_pieces(PATH)
    model = WordPiece({p: i for i, p in enumerate(pieces)} | {"<none>": len(pieces)}, unk_token="<none>", continuing_subword_prefix="", max_input_chars_per_word=10**6)
    made = tokencount.Automaton(pieces)
    rng = random.Random(4)
    words = ["the", "naïve", "x" * 500, "日本語", "a▁b", "\U0001f600", "don't", "12345", "…"]
    words += ["".join(rng.choice("etaoinshrdluéöñß.,!0 ").strip() or "q" for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    for word in words:
        tokens = model.tokenize(tokencount.WORD_MARK + word)
        found = made.length(tokencount.WORD_MARK + word)
        if [t.value for t in tokens] == ["<none>"]:
            assert found == tokencount.UNKNOWN + 1
        else:
            assert found == len(tokens)


def test_rows(spark):
    rows = [(1, "the cat  sat\n"), (1, "the cat  sat\n"), (2, None), (3, ""), (None, "a"), (4, "\U000f0000 the"), (5, "q" * 200_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n_words string, n_tokens int")
    pieces = set(tokencount.model_pieces(PATH))
    got = {(r.doc_id, r.n_words): (r.n_tokens, r.n_unknown) for r in tokencount.token_counts(docs, PATH).collect()}
    expected = {}
    for doc, text in rows[:-1]:
        found = [plain(tokencount.WORD_MARK + w, pieces) for w in (text or "").split()]
        expected[doc, len(found)] = (sum(f % tokencount.UNKNOWN for f in found), sum(f >= tokencount.UNKNOWN for f in found))
    assert got.items() >= expected.items() and (5, 1) in got
    assert tokencount.token_counts(docs, PATH).count() == len(rows)
    assert tokencount.token_counts(docs.limit(0), PATH).count() == 0


def test_memory_is_forgotten_when_full():
    made = tokencount.Lengths(tokencount.Automaton(["a", "ab"]), "", most=2)
    assert [made[w] for w in ("a", "ab", "aab", "a", "ab")] == [1, 1, 2, 1, 1] and len(made) <= 2


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    pieces = set(tokencount.model_pieces(PATH))
    memo = {}
    got = {r.doc_id: r for r in tokencount.op10_token_counts(spark, "/root/testdata/sf0.001").collect()}
    for r in docs:
        found = [memo.setdefault(w, plain(tokencount.WORD_MARK + w, pieces)) for w in r.text.split()]
        assert got[r.doc_id].n_tokens == sum(f % tokencount.UNKNOWN for f in found)
