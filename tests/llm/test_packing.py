import os
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from pagemart.llm import packing, pretokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (1, "a"), (2, None), (3, ""), (4, "don't we'll 'sfoo ''s \n\n  x  "), (5, "word " * 6000), (5, "word " * 6000), (None, "no id"),
    (7, "Ünïcode 日本 \U0001f600 ²³ <|endoftext|>  after<|endoftext|>"), (8, "\t\n \x85\xa0"), (9, "x" * 5000), (9, "other text"),
]


def brute_first_fit(lengths, room):
    left, bins = [], []
    for n in lengths:
        at = next((i for i, r in enumerate(left) if r >= n), len(left))
        if at == len(left):
            left.append(room)
        left[at] -= n
        bins.append(at)
    return bins


def test_first_fit_is_the_plain_one():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 300):
        lengths = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
        assert packing.first_fit(lengths, 50) == brute_first_fit(lengths, 50)
    rng_lengths = [rng.randint(1, 50) for _ in range(200)]
    assert packing.first_fit(rng_lengths, 50) == brute_first_fit(rng_lengths, 50)


def check(rows, texts, window):
    plain = Tokenizer.from_file(PATH)
    wanted = {}
    for doc, text in texts:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        wanted.setdefault(doc, []).append(ids)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    expected = {}
    for doc, all_ids in wanted.items():
        for ids in all_ids:
            for s in range(0, len(ids), window):
                part = np.array(ids[s : s + window], "<u4")
                expected.setdefault(doc, []).append((s, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in expected.items()}
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return bins


@pytest.mark.parametrize("group", [3, 8192])
def test_pieces_and_places(spark, group):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in TEXTS], "doc_id long, text string, start string, group_no int, salt long")
    rows = packing.pack_documents(docs, PATH, group=group).collect()
    check(rows, TEXTS, 2048)


def test_ids_can_be_carried(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, window=64, with_ids=True).collect()
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.op1_pack_ffd(spark, "/root/testdata/sf0.001").collect()
    bins = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    used = sum(r.length for r in rows)
    assert used / (2048 * len(bins)) > 0.97


def test_words_with_equal_keys_and_a_very_long_text(spark):
    """Words that a 64-bit polynomial hash does not tell apart, and a text above the bound of one part."""
    one, other = "a", "b"
    for _ in range(10):
        one, other = one + other, other + one
    texts = [(1, one), (2, other), (3, f"{other} {one} {other}"), (4, "some words, one's own.\n" * 30_000)]
    rows = packing.pack_documents(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), PATH).collect()
    check(rows, texts, 2048)


def test_a_task_encodes_on_its_own_core(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    packing.Vocabulary(PATH)
    assert os.environ.pop("TOKENIZERS_PARALLELISM") == "false"


def test_classes_of_all_code_points():
    kinds = {"L": pretokens.LETTER, "N": pretokens.NUMBER}
    wanted = [kinds.get(unicodedata.category(chr(c))[0], pretokens.OTHER) for c in range(0x110000)]
    for c in pretokens.WHITE:
        wanted[c] = pretokens.SPACE
    assert pretokens.classes().tolist() == wanted


class Counted:
    """Stands for a tokenizer and counts the sequences given to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, sequences, **options):
        self.given += len(sequences)
        return self.tokenizer.encode_batch_fast(sequences, **options)


ODD = ["", "a", "one two  three\n\n", "it's 'they'll", "\0 \0", "Ġ Ü日本\U0001f600 ²³", " \xa0\x85\u2003x", "<|endoftext|> <| endoftext|>", "x" * 300]


def test_new_words_of_many_texts_go_to_the_tokenizer_in_one_call():
    """An encoding per word was most of the time: words met for the first time go together."""
    own, plain = packing.Vocabulary(PATH), Tokenizer.from_file(PATH)
    own.tokenizer = Counted(own.tokenizer)
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdeü", k=rng.randint(1, 12))) for _ in range(50)) for _ in range(40)]
    assert [i.tolist() for i in own.encode_each(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.tokenizer.given == 1


def test_odd_texts_one_by_one_and_together():
    own, plain = packing.Vocabulary(PATH), Tokenizer.from_file(PATH)
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [i.tolist() for t in ODD for i in own.encode_each([t])] == wanted
    assert [i.tolist() for i in packing.Vocabulary(PATH).encode_each(ODD)] == wanted


@pytest.mark.parametrize("options", [{}, {"unk_token": "<unk>"}, {"unk_token": "<unk>", "fuse_unk": True}, {"continuing_subword_prefix": "##"}])
@pytest.mark.parametrize("normalizer", [None, normalizers.Lowercase()])
def test_other_files(tmp_path, options, normalizer):
    """Bytes without an id, pieces that are longer than their bytes, and a normalizer."""
    prefix = options.get("continuing_subword_prefix", "")
    pieces = ["<unk>", *"abcdxyĠÃ", *(prefix + c for c in "abcdxyĠÃ" if prefix), f"a{prefix}b".replace("##", ""), f"{prefix}cd"]
    vocabulary = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
    file = Tokenizer(models.BPE(vocabulary, [("a", prefix + "b"), (prefix + "c", prefix + "d")], **options))
    file.normalizer, file.pre_tokenizer = normalizer, pre_tokenizers.ByteLevel(add_prefix_space=False)
    file.save(str(tmp_path / "file.json"))
    texts = ["ab abcd", "", "zzab Üqcd ABCD", "q", "ab" * 20 + " x"]
    own = packing.Vocabulary(str(tmp_path / "file.json"))
    assert [i.tolist() for i in own.encode_each(texts)] == [file.encode(t, add_special_tokens=False).ids for t in texts]
