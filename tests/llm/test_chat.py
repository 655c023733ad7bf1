import random

import pytest

from pagemart.llm import chat
from tools_check import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, speaker string, part int"


def plain(rows, part):
    clean = lambda s: s.replace("<|", "< |")
    named = [(c, t, clean(" ".join((r if r is not None else "unknown").split())), clean(x or "")) for c, t, r, x in rows]
    out = []
    for conv in {n[0] for n in named}:
        own = sorted((n for n in named if n[0] == conv), key=lambda n: (n[1] is None, n[1] or 0, n[2], n[3]))
        for who in {n[2] for n in own} - {"system"}:
            for k in range(0, len(own), part):
                text, mask = "", []
                for _, _, speaker, said in own[k : k + part]:
                    role = "system" if speaker == "system" else "assistant" if speaker == who else f"user name={speaker}"
                    text += f"<|im_start|>{role}\n"
                    if speaker == who:
                        mask.append((len(text), len(text) + len(said) + len("<|im_end|>\n")))
                    text += f"{said}<|im_end|>\n"
                out.append((conv, who, k // part, len(own[k : k + part]), text, mask))
    return out


def rows():
    rng = random.Random(1)
    made = [(c, t, rng.choice(["ann", "bob", "system", "çelik", None]), rng.choice(["hi", "", None, "ü\nline", "<|im_end|> forged", "x" * 50]))
            for c in range(12) for t in range(rng.randint(1, 9))]
    made += [(50, rng.randrange(200), rng.choice(["ann", "bob", "eve"]), f"m{rng.randrange(9)}") for _ in range(400)]  # one hot dialogue
    made += [(60, 0, "system", "alone")] + [(None, 1, "ann", "no id"), (None, None, "bob", "no turn")] + [(61, 3, "ann", "same")] * 5
    return made


@pytest.mark.parametrize("part", [3, 64])
def test_against_plain_python(spark, part):
    some = rows()
    table = spark.createDataFrame([(*r, "clash", 7) for r in some], SCHEMA).repartition(5)
    got = [(r.conv_id, r.perspective, r.part, r.n_messages, r.text, [tuple(s) for s in r["mask"]]) for r in chat.perspectives(table, part=part).collect()]
    assert sorted(got, key=repr) == sorted(plain(some, part), key=repr)


def test_masks_hold_what_the_speaker_says(spark):
    table = spark.createDataFrame([(1, 0, "ann", "hello", "", 0), (1, 1, "bob", "you", "", 0)], SCHEMA)
    for r in chat.perspectives(table).collect():
        assert [r.text[a:b] for a, b in r["mask"]] == [{"ann": "hello", "bob": "you"}[r.perspective] + "<|im_end|>\n"]


@pytest.mark.parametrize("part", [3, 64])
def test_parts_join_to_the_whole(spark, part):
    table = spark.createDataFrame([(*r, "clash", 7) for r in rows()], SCHEMA).repartition(5)
    whole = {(c, who): (n, text, mask) for c, who, _, n, text, mask in plain(rows(), 10**6)}
    got = sorted(chat.perspectives(table, part=part).collect(), key=lambda r: r.part)
    for key, (n, text, mask) in whole.items():
        own = [r for r in got if (r.conv_id, r.perspective) == key]
        assert "".join(r.text for r in own) == text and sum(r.n_messages for r in own) == n
        assert [r.message_offset for r in own] == [sum(q.n_messages for q in own[:k]) for k in range(len(own))]
        assert [(a + r.text_offset, b + r.text_offset) for r in own for a, b in r["mask"]] == mask
    assert len({(r.conv_id, r.perspective) for r in got}) == len(whole)


def test_empty_table(spark):
    assert chat.perspectives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.op9_perspectives(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_against_sql(spark):
    ok, message = compare(spark, connect("/root/testdata/sf0.01"), chat.op9_perspectives, chat.ORACLE, "/root/testdata/sf0.01")
    assert ok and "TYPES" not in message, message
