"""Chat formatting: exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest

from stratalake.llm import chat

PATHS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id long, turn long, role string, text string, ids string, part int"


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "#", "###", "</turn>", "<", "a", " ", "\n", "é"]) for _ in range(rng.randint(0, 12)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert "###" not in hidden and "</turn>" not in hidden.replace("\\\\", "").replace("\\</turn>", "")


def turns(spark):
    rng = random.Random(2)
    texts = ["", None, "hi", "\\### Assistant: </turn> ok", "字 é\n" * 30, "<|endoftext|> ### x", " " * 50]
    data = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(texts), "x", 9) for c in range(12) for t in range(rng.randint(1, 6))]
    data += [(77, t, "assistant" if t % 2 else "user", f"turn {t}", "x", 9) for t in range(400)]
    data += [(None, None, "user", "a", "x", 9), (5, 0, "user", "same", "x", 9), (5, 0, "user", "same", "x", 9)]
    return spark.createDataFrame(data, SCHEMA).repartition(5), data


def test_round_trip(spark):
    df, data = turns(spark)
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df, *PATHS), *PATHS).collect()}
    assert got.keys() == {d[0] for d in data}
    for conv, row in got.items():
        own = [d[1:4] for d in data if d[0] == conv]
        assert row.n_turns == len(own)
        if len({(t, r or "") for t, r, _ in own}) < len(own):
            continue  # the order of equal turns is by hash
        own = [(r or "", t or "") for _, r, t in sorted(own, key=lambda d: -1 if d[0] is None else d[0])]
        every = "".join(f"{r}\n{t}\n" for r, t in own)
        loss = "".join(t for r, t in own if r == "assistant")
        assert row.turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        written = "".join(f"### {chat.escape(r)}: {chat.escape(t)}</turn>\n" for r, t in own)
        assert row.formatted_chars == len(written)


def test_offsets_are_gapless_across_parts(spark):
    df, _ = turns(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = chat.format_turns(df, *PATHS).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for conv in {r.conv_id for r in rows}:
        at = 0
        for i, r in enumerate(sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.place)):
            assert (r.place, r.offset) == (i, at)
            at += len(r.ids)


def test_mask_by_prefix_sums():
    assert chat.loss_mask(5, 2, 4).tolist() == [False, False, True, True, False]
    assert not chat.loss_mask(3, 2, 2).any()


def test_no_rows(spark):
    assert chat.digests(chat.format_turns(spark.createDataFrame([], SCHEMA), *PATHS), *PATHS).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100, chat.PART_CHARS])
def test_parts_of_a_text_have_the_ids_of_the_whole(monkeypatch, size):
    monkeypatch.setattr(chat, "PART_CHARS", size)
    found, rng = chat.codec(*PATHS), random.Random(3)
    signs = ["word", " ", "  ", "\n", "\t", " \n ", "don't", "'ll", "é", "漢字", "1234", "!?", "\u00a0", "x y", "<|", "🙂"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["word " * 40_000, " " * 3000 + "a", "".join(rng.choice(signs) for _ in range(300_000))] if size > 99 else []
    for text in texts:
        assert chat.encode(found, text) == found.encode_ordinary(text)
        assert "".join(chat._parts(text, PATHS[1])) == text
