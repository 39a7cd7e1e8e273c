import hashlib
import random

import numpy as np
import pytest

from flowtables.llm import chat

pytest.importorskip("tokenizers")
NASTY = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s> [END]", "<<SYS>>\n x \n<</SYS>>", "[/ROLE] [END]", "\\", "<", "[", "<<", "é😀 [INST", "INST]", " lead and trail ", "\n", "", "[ROLE]user[/ROLE]"]


def test_render_is_reversible():
    rnd = random.Random(1)
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "system", "tool", "", "a[END]", "</s>"]), "".join(rnd.choice(NASTY) for _ in range(rnd.randrange(4)))) for _ in range(rnd.randrange(5))]
        text, spans = chat.render(turns)
        assert chat.read_back(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_loss_tokens():
    starts, ends = np.array([0, 3, 5, 5, 6]), np.array([3, 5, 6, 6, 9])
    mask, shared = chat.loss_tokens(starts, ends, [(1, 3), (4, 4), (4, 7), (8, 9)])
    assert mask.tolist() == [True] * 5 and shared == [1, 3, 4, 7, 8, 9]
    mask, shared = chat.loss_tokens(starts, ends, [(3, 5)])
    assert mask.tolist() == [False, True, False, False, False] and shared == [3, 5]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests(spark):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "critic"]), rnd.choice([*NASTY, "plain words here"])) for c in range(12) for t in range(rnd.randrange(1, 6))]
    rows += [(None, 1, "assistant", "no id"), (50, None, "user", "null turn"), (50, 0, None, None), (50, 0, "assistant", "twice"), (50, 0, "assistant", "twice")]
    rows += [(60, i, ("user", "assistant")[i % 2], f"turn {i} of a long one, <s>") for i in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, block int").repartition(6)
    whole = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.format_chats(df)).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        said = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
        own = [t for r, t in said if r == "assistant"]
        want[c] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), sum(map(len, own)), sha("".join(own)), len(chat.render(said)[0]))
    assert whole == want
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.format_chats(df, block_chars=300)).collect()} == want


def test_blocks_have_the_tokens_of_the_whole(spark):
    df = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"some text, {i} </s> é") for i in range(20)], "conv_id long, turn long, role string, text string")
    parts = sorted(chat.format_chats(df, block_chars=60).collect(), key=lambda r: r.block)
    one = chat.format_chats(df).first()
    assert len(parts) > 5 and one.formatted == "".join(p.formatted for p in parts)
    assert one.token_ids == [t for p in parts for t in p.token_ids] and one.loss_mask == [m for p in parts for m in p.loss_mask]
    assert sum(one.loss_mask) and not all(one.loss_mask)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(df)).collect() == []
